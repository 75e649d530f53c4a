"""Streaming jobs on the given tables; each runs until its input is used up, then reads its sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.functions import epoch_seconds, parse_timestamp
from chargetrail.operators.timeslice import DAY, with_date_parts
from chargetrail.plans.derived_logs import as_event_log, as_status_log, event_log, table
from chargetrail.plans.registry import query
from chargetrail.session import materialise, work_path
from chargetrail.sources import read_parquet, with_row_index
from chargetrail.streaming import (
    append_files,
    append_first,
    current_view,
    enrich,
    file_stream,
    rocksdb_state,
    run_to_end,
    split_late,
    status_events,
    upsert_log,
    windowed_status_counts,
)

BUCKET_SQL = "CAST(epoch(time_bucket(INTERVAL '5 minutes', ts)) AS BIGINT)"
COUNTS_SQL = f"""SELECT user_id AS charge_point_id, event_type AS status, {BUCKET_SQL} AS window_start, count(*) AS n
       FROM events GROUP BY 1, 2, 3"""
# In append mode a window comes out once the watermark, 10 minutes behind the newest row, is past it.
CLOSED_SQL = f"""SELECT * FROM ({COUNTS_SQL})
       WHERE window_start + 300 <= (SELECT epoch(max(ts)) FROM events) - 600"""


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # As a pattern the path may name a single file or a folder.
    return file_stream(spark, f"{sf_dir}/{name}[.]parquet", table(spark, sf_dir, name).schema)


#: Parts in which the log arrives; the stream ends after each and starts again.
ARRIVALS = 3


def _arriving(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], None]) -> None:
    """Deliver the events in the order of time, in parts of about the same time span, and `run` a stream of the inbox after
    each: state and offsets have to outlive every stop."""
    inbox, events = work_path(spark, "inbox"), table(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    part = F.least(F.floor((at - low) * ARRIVALS / F.lit((high or 0) - (low or 0) + 1)), F.lit(ARRIVALS - 1))
    for k in range(ARRIVALS):
        events.where(part == k).write.mode("append").parquet(inbox)
        run(file_stream(spark, inbox, events.schema))


def _events(stream: DataFrame) -> DataFrame:
    return stream.select(
        F.col("user_id").alias("charge_point_id"),
        F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _windows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("charge_point_id").cast("bigint").alias("charge_point_id"),
        "status",
        epoch_seconds("window.start").alias("window_start"),
        "n",
    )


def _append_arriving(spark: SparkSession, sf_dir: str, counts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    path, progress = work_path(spark, "stream"), work_path(spark, "progress")
    with rocksdb_state(spark):
        _arriving(spark, sf_dir, lambda events: run_to_end(append_files(counts(events), path, progress)))
    return read_parquet(spark, path)


def _append(spark: SparkSession, stream: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
    path = work_path(spark, "stream")
    with rocksdb_state(spark):
        run_to_end(append_files(stream, path, work_path(spark, "progress"), partition_by))
    return path


@query(CLOSED_SQL)
def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(
        _append_arriving(spark, sf_dir, lambda events: windowed_status_counts(_events(events), name="n"))
    )


@query(COUNTS_SQL)
def stream_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, progress, keys = work_path(spark, "live"), work_path(spark, "progress"), ["charge_point_id", "status", "window"]

    def run(events: DataFrame) -> None:
        counts = windowed_status_counts(_events(events), name="n")
        run_to_end(upsert_log(counts, path, progress, keys, compact_every=2))

    with rocksdb_state(spark):
        _arriving(spark, sf_dir, run)
    return _windows(current_view(spark, path, keys))


@query(CLOSED_SQL)
def stream_json_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(
        _append_arriving(
            spark, sf_dir, lambda events: windowed_status_counts(status_events(as_status_log(events)), name="n")
        )
    )


@query(CLOSED_SQL)
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log arrives twice. The second time all its closed windows are past the watermark,
    so every late copy has to be dropped and the counts must stay those of one log."""
    inbox, path, progress = (work_path(spark, name) for name in ("inbox", "stream", "progress"))
    events = table(spark, sf_dir, "events")
    for _ in range(2):
        events.write.mode("append").parquet(inbox)
        arrived = file_stream(spark, inbox, events.schema)
        counts = windowed_status_counts(_events(arrived), name="n")
        with rocksdb_state(spark):
            run_to_end(append_files(counts, path, progress))
    return _windows(read_parquet(spark, path))


@query(
    """WITH e AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS second,
                         CAST(epoch(time_bucket(INTERVAL '5 minutes', ts)) AS BIGINT) + 300
                             <= (SELECT epoch(max(ts)) FROM events) - 600 AS behind FROM events)
       SELECT event_id, second, 'on_time' AS kept, CASE WHEN behind THEN 1 ELSE 2 END AS times FROM e
       UNION ALL SELECT event_id, second, 'late', 1 FROM e WHERE behind"""
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log arrives twice. What comes the second time behind the watermark is kept apart, all else is on time."""
    inbox, path, progress = (work_path(spark, name) for name in ("inbox", "split", "progress"))
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        events.write.mode("append").parquet(inbox)
        run_to_end(split_late(file_stream(spark, inbox, events.schema), path, progress, "ts"))
    result = None
    for kept in ("late", "on_time"):
        rows = read_parquet(spark, f"{path}/{kept}").groupBy("event_id", epoch_seconds("ts").alias("second"))
        counted = rows.agg(F.count("*").cast("int").alias("times")).withColumn("kept", F.lit(kept))
        result = counted if result is None else result.unionByName(counted)
    return result


@query("SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS action, props AS body FROM events")
def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox = work_path(spark, "inbox")
    events = table(spark, sf_dir, "events")
    events.unionByName(events).repartition(4).write.parquet(inbox)  # four batches, in no order of time
    log = as_event_log(file_stream(spark, inbox, events.schema, files_per_batch=1))
    path = work_path(spark, "once")
    run_to_end(append_first(log, path, work_path(spark, "progress"), buckets=16, fan=2))
    return read_parquet(spark, path).select("message_id", "action", "body")


@query(
    """SELECT l_orderkey AS value, l_linenumber, l_quantity, message_id, action
       FROM lineitem LEFT JOIN (
           SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS action,
                  row_number() OVER (ORDER BY ts, CAST(event_id AS VARCHAR)) - 1 AS index FROM events)
       ON l_orderkey = index"""
)
def stream_static_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = with_row_index(event_log(spark, sf_dir), ["write_timestamp", "message_id"])
    numbers = _table_stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("value"), "l_linenumber", "l_quantity"
    )
    # As a written table its size is known, so Spark can tell whether it is small enough to broadcast.
    static = materialise(log.select("message_id", "action", "index"), "indexed-log")
    joined = enrich(numbers, static)
    return read_parquet(spark, _append(spark, joined))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(floor(epoch(ts)) AS BIGINT) AS write_timestamp_epoch,
              CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
              CAST(minute(ts) AS INTEGER) AS minute
       FROM events"""
)
def stream_partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = as_event_log(_table_stream(spark, sf_dir, "events"))
    written = parse_timestamp("write_timestamp")
    stamped = log.withColumns({"write_timestamp": written, "write_timestamp_epoch": epoch_seconds(written)})
    path = _append(spark, with_date_parts(stamped), DAY)
    return read_parquet(spark, path).select(
        "message_id", "write_timestamp_epoch", *DAY, "hour", "minute"
    )
