"""Batch operators and jobs on the given tables, each next to its SQL check."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.functions import (
    energy_delta,
    epoch_seconds,
    hours_between,
    parse_timestamp,
    rounded_double,
    table_name,
)
from chargetrail.operators.joins import (
    attach_parking,
    attach_starts,
    started_transactions,
    with_bounds,
)
from chargetrail.operators.messages import flatten_struct, import_power, meter_samples, of_class, power_samples, silver, unpack_json
from chargetrail.operators.ordered import (
    distinct_keys as sorted_keys,
    drop_repeated_messages,
    latest_per_key as latest_rows,
    ordered_columns,
    top_latest,
)
from chargetrail.operators.parking import idle_islands, parking_time as idle_hours, with_boundaries
from chargetrail.operators.stats import (
    distribution,
    event_count as count_events,
    histogram,
    status_counts,
)
from chargetrail.operators.timeslice import DAY, time_slice, with_date_parts
from chargetrail.plans import jobs
from chargetrail.plans.derived_logs import (
    as_event_log,
    charging_log,
    event_log,
    event_samples,
    table,
)
from chargetrail.plans.registry import query
from chargetrail.schemas import (
    METER_POWER,
    METER_VALUES,
    SILVER_CLASSES,
    START_REQUEST,
    START_RESPONSE,
    STOP_REQUEST,
)
from chargetrail.session import materialise, work_path
from chargetrail.sinks import create_database, create_external_table, write_parquet, write_partitioned, write_routed
from chargetrail.sources import (
    read_csv_log,
    read_json_records,
    read_last_minute,
    read_parquet,
    read_table,
)

#: Records of a compressed CSV file that is read again, some 50 MB of text.
CSV_RECORDS = 100_000

WIDE = tuple(message.wide_ids() for message in SILVER_CLASSES)
WIDE_START_REQUEST, WIDE_START_RESPONSE, WIDE_STOP_REQUEST, WIDE_METER_VALUES = WIDE

EVENT_LOG_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS message_id,
           CASE WHEN event_type = 'error' THEN 3 ELSE 2 END AS message_type,
           CAST(user_id AS VARCHAR) AS charge_point_id, event_type AS action,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS write_timestamp, props AS body
    FROM events"""


# Scans and sinks


@query(EVENT_LOG_SQL)
def csv_event_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "log-csv")
    event_log(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv_log(spark, path)


@query(
    """SELECT event_id AS message_id, user_id AS charge_point_id, event_type AS action,
              epoch_us(ts) AS written_us, props AS body FROM events"""
)
def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "log-csv-gz")
    event_log(spark, sf_dir).write.option("header", True).option("compression", "gzip").csv(path)
    return read_csv_log(spark, path, schema=None).select(
        F.col("message_id").cast("bigint"),
        F.col("charge_point_id").cast("bigint"),
        "action",
        F.unix_micros("write_timestamp").alias("written_us"),
        "body",
    )


@query("SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_parquet(spark, f"{sf_dir}/events.parquet")
    return events.select(
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        "user_id",
        "event_type",
        "value",
        "props",
    )


@query(
    f"""SELECT message_id, message_type, charge_point_id, action, write_timestamp, body,
               row_number() OVER (ORDER BY write_timestamp, message_id) - 1 AS index
        FROM ({EVENT_LOG_SQL})"""
)
def json_records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "log-json")
    event_log(spark, sf_dir).write.json(path)
    return read_json_records(
        spark, path, jobs.EVENT_LOG, index_by=["write_timestamp", "message_id"]
    )


@query(EVENT_LOG_SQL)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "log-parquet")
    write_parquet(event_log(spark, sf_dir), path)
    return read_parquet(spark, path)


def _daily_log(spark: SparkSession, sf_dir: str, leading: tuple[str, ...] = ()) -> str:
    """The event log as a table with a folder per day; hour and minute stay in the files."""
    path = work_path(spark, "log-daily")
    log = with_date_parts(event_log(spark, sf_dir), "write_timestamp")
    write_partitioned(log, path, [*leading, *DAY], sort_within=["hour", "minute", "charge_point_id"])
    return path


def _at_five_points(log: DataFrame) -> DataFrame:
    """All messages, dealt to five charge points with ids such as 0003: folders by charge point stay few."""
    number = F.col("charge_point_id").cast("long") % 5
    return log.withColumn("charge_point_id", F.lpad(number.cast("string"), 4, "0"))


PARTS_SQL = """CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(minute(ts) AS INTEGER) AS minute"""


@query(
    f"""SELECT CAST(event_id AS VARCHAR) AS message_id, lpad(CAST(user_id % 5 AS VARCHAR), 4, '0') AS charge_point_id,
               event_type AS action, props AS body, {PARTS_SQL} FROM events"""
)
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log by charge point and day, written again as a whole by a second run. Five charge points, whose ids begin with
    zeros, have all messages."""
    path = work_path(spark, "log-by-charge-point")
    log = with_date_parts(_at_five_points(event_log(spark, sf_dir)), "write_timestamp")
    for _ in range(2):
        write_partitioned(log, path, mode="replace")
    table = read_table(spark, path, schema=log.schema)
    return table.select("message_id", "charge_point_id", "action", "body", *DAY, "hour", "minute")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, props AS body, CAST(day(ts) AS INTEGER) AS day
       FROM events WHERE event_type = 'purchase'"""
)
def partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _daily_log(spark, sf_dir, ("action",))
    return read_table(spark, path).where("action = 'purchase'").select("message_id", "body", "day")


@query(
    """SELECT event_type || CASE WHEN event_type = 'error' THEN 'Response' ELSE 'Request' END AS "table",
              CAST(event_id AS VARCHAR) AS message_id, props AS body FROM events"""
)
def route_by_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "routed")
    write_routed(event_log(spark, sf_dir), path)
    return read_table(spark, path).select("table", "message_id", "body")


@query(f"SELECT message_id, action, body, {PARTS_SQL} FROM (SELECT *, CAST(event_id AS VARCHAR) AS message_id, event_type AS action, props AS body FROM events)")
def catalog_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _daily_log(spark, sf_dir)
    place = work_path(spark, "db")
    database = create_database(spark, "charging " + place[-32:], place, use=False)
    schema = read_table(spark, path).schema
    name = create_external_table(spark, database, "event_log", path, schema=schema, partition_by=DAY)
    return spark.sql(f"SELECT * FROM {name}").select(
        "message_id", "action", "body", *DAY, "hour", "minute"
    )


# Time slices


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, props AS body FROM events
       WHERE ts >= TIMESTAMP '2024-01-01 00:06:00' AND ts < TIMESTAMP '2024-01-01 00:07:00'"""
)
def time_slice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_table(spark, _daily_log(spark, sf_dir))
    return log.transform(time_slice, datetime(2024, 1, 1, 0, 6)).select("message_id", "body")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, props AS body FROM events
       WHERE ts >= TIMESTAMP '2024-01-01 00:08:00' AND ts < TIMESTAMP '2024-01-01 00:09:00'"""
)
def last_minute_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _daily_log(spark, sf_dir)
    return read_last_minute(spark, path, datetime(2024, 1, 1, 0, 9, 30)).select("message_id", "body")


@query(f"SELECT event_id, {PARTS_SQL} FROM events")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_date_parts(table(spark, sf_dir, "events"), "ts").select(
        "event_id", *DAY, "hour", "minute"
    )


# Projections and filters


@query(f"SELECT * FROM ({EVENT_LOG_SQL}) WHERE action = 'purchase' AND message_type = 2")
def message_class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(of_class, "purchase", 2)


@query("SELECT event_id, value FROM events WHERE event_type = 'view' AND (value > 30 OR value IS NULL)")
def null_phase_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    phase = F.when(F.col("value") <= 30, F.lit("L1"))
    measurand = F.when(F.col("event_type") == "view", F.lit("Power.Active.Import")).otherwise("Voltage")
    samples = table(spark, sf_dir, "events").withColumns({"phase": phase, "measurand": measurand})
    return samples.transform(import_power).select("event_id", "value")


@query("SELECT CAST(event_id AS VARCHAR) AS message_id, event_type AS status FROM events")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).drop("body", "write_timestamp", "no_such_column")
    return log.withColumnRenamed("action", "status").select("message_id", "status")


STOP_BODY_SQL = """
    SELECT 'stop-' || o_orderkey AS message_id,
           o_custkey + CAST(round(o_totalprice * 100) AS BIGINT) AS meter_stop,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS transaction_id,
           o_orderstatus AS reason, o_orderpriority AS id_tag,
           CAST(epoch(o_orderdate) AS BIGINT) + CAST(floor(o_totalprice) AS BIGINT) AS stopped_at
    FROM orders"""


@query(STOP_BODY_SQL)
def json_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = WIDE_STOP_REQUEST
    unpacked = (
        charging_log(spark, sf_dir)
        .transform(of_class, stop.action, stop.message_type)
        .transform(unpack_json, stop.body)
    )
    body = ("meter_stop", "transaction_id", "reason", "id_tag")
    return unpacked.select(
        "message_id",
        *[F.col(f"new_body.{name}").alias(name) for name in body],
        epoch_seconds(parse_timestamp("new_body.timestamp")).alias("stopped_at"),
    )


@query(
    """SELECT 'start-' || o_orderkey AS message_id, CAST(o_custkey AS VARCHAR) AS charge_point_id,
              o_orderkey AS transaction_id, o_orderstatus AS id_tag_info_status,
              o_orderpriority AS id_tag_info_parent_id_tag,
              CAST(NULL AS VARCHAR) AS id_tag_info_expiry_date FROM orders"""
)
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    response = WIDE_START_RESPONSE
    return (
        charging_log(spark, sf_dir)
        .transform(of_class, response.action, response.message_type)
        .transform(unpack_json, response.body)
        .transform(flatten_struct)
        .drop("message_type", "action", "write_timestamp")
    )


@query(
    """SELECT 'meter-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS message_id,
              l_linenumber AS connector_id, l_orderkey AS transaction_id, 2 AS readings,
              3 AS samples FROM lineitem"""
)
def json_unpack_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    meter = WIDE_METER_VALUES
    readings = F.col("new_body.meter_value")
    sampled = F.aggregate(readings, F.lit(0), lambda n, reading: n + F.size(reading["sampled_value"]))
    return (
        charging_log(spark, sf_dir)
        .transform(of_class, meter.action, meter.message_type)
        .transform(unpack_json, meter.body)
        .select(
            "message_id",
            "new_body.connector_id",
            "new_body.transaction_id",
            F.size(readings).alias("readings"),
            sampled.alias("samples"),
        )
    )


SAMPLES_SQL = """
    SELECT 'meter-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS message_id,
           l_orderkey AS transaction_id, l_linenumber AS connector_id,
           CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 97 + s.after AS sec,
           s.measurand, s.phase,
           CASE s.nth WHEN 1 THEN l_quantity - 25 WHEN 2 THEN l_extendedprice ELSE l_tax END AS value
    FROM lineitem, (VALUES (1, 0, 'Power.Active.Import', NULL), (2, 0, 'Voltage', 'L1-N'),
                           (3, 30, 'Power.Active.Import', 'L1')) AS s(nth, after, measurand, phase)"""


@query(SAMPLES_SQL)
def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(charging_log(spark, sf_dir), WIDE_METER_VALUES).select(
        "message_id",
        "transaction_id",
        "connector_id",
        epoch_seconds("timestamp").alias("sec"),
        "measurand",
        "phase",
        "value",
    )


# Scalar functions


@query(
    "SELECT event_id, epoch_us(ts) AS parsed_us, CAST(NULL AS BIGINT) AS bad_us FROM events",
    name="parse_timestamp",
)
def parsed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    return log.select(
        F.col("message_id").cast("bigint").alias("event_id"),
        F.unix_micros(parse_timestamp("write_timestamp")).alias("parsed_us"),
        F.unix_micros(parse_timestamp("body")).alias("bad_us"),
    )


@query(
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS write_timestamp_epoch FROM events",
    name="epoch_seconds",
)
def epoch_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_seconds("ts").alias("write_timestamp_epoch")
    )


HOURS_SQL = "CAST((CASE WHEN {0} >= 0 THEN ({0} + 18) // 36 ELSE -((18 - {0}) // 36) END) / 100.0 AS DOUBLE)"
KWH_SQL = "CAST((CASE WHEN {0} >= 0 THEN ({0} + 5) // 10 ELSE -((5 - {0}) // 10) END) / 100.0 AS DOUBLE)"


@query(
    f"""SELECT o_orderkey, {HOURS_SQL.format("d")} AS total_time
        FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) - o_custkey AS d FROM orders)"""
)
def duration_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate").cast("timestamp")
    seconds = F.floor("o_totalprice") - F.col("o_custkey")
    stop = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + seconds)
    return table(spark, sf_dir, "orders").select("o_orderkey", hours_between(start, stop).alias("total_time"))


@query(
    f"""SELECT o_orderkey, {KWH_SQL.format("w")} AS total_energy, CAST(w AS DOUBLE) AS total_energy_wh
        FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) - o_custkey AS w FROM orders)""",
    name="energy_delta",
)
def energy_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    meter_stop = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        energy_delta("o_custkey", meter_stop).alias("total_energy"),
        energy_delta("o_custkey", meter_stop, "wh").alias("total_energy_wh"),
    )


@query("SELECT event_id, CAST(round(value, 2) AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS no_number FROM events")
def rounded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        rounded_double(F.col("value").cast("string")).alias("value"),
        rounded_double("props").alias("no_number"),
    )


@query(
    """SELECT event_id, event_type || CASE WHEN event_type = 'error' THEN 'Response' ELSE 'Request' END
              AS "table" FROM events"""
)
def output_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(
        F.col("message_id").cast("bigint").alias("event_id"), table_name().alias("table")
    )


# Joins

SESSIONS_SQL = """
    started AS (
        SELECT CAST(o_custkey AS VARCHAR) AS charge_point_id, o_orderkey AS transaction_id,
               o_custkey AS meter_start, CAST(epoch(o_orderdate) AS BIGINT) AS start_timestamp
        FROM orders),
    stops AS (
        SELECT CASE WHEN o_orderstatus <> 'O' THEN o_orderkey END AS stop_key,
               o_custkey + CAST(round(o_totalprice * 100) AS BIGINT) AS meter_stop,
               CAST(epoch(o_orderdate) AS BIGINT) + CAST(floor(o_totalprice) AS BIGINT) AS stop_timestamp
        FROM orders),
    sessions AS (
        SELECT s.charge_point_id, s.transaction_id, s.meter_start, p.meter_stop, s.start_timestamp,
               p.stop_timestamp
        FROM stops p LEFT JOIN started s ON p.stop_key = s.transaction_id)"""

PARKING_SQL = """
    samples AS (
        SELECT l_orderkey AS tx, CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 97 AS sec,
               l_quantity - 25 AS power, CASE WHEN l_quantity - 25 > 0 THEN 1 ELSE 0 END AS charging
        FROM lineitem),
    bounded AS (
        SELECT *, abs(charging - lag(charging, 1, 0) OVER (PARTITION BY tx ORDER BY sec, power)) AS boundary
        FROM samples),
    numbered AS (
        SELECT *, sum(boundary) OVER (PARTITION BY tx ORDER BY sec, power ROWS UNBOUNDED PRECEDING) AS island
        FROM bounded),
    islands AS (
        SELECT tx, island, max(sec) - min(sec) AS s FROM numbered WHERE charging = 0 GROUP BY tx, island),
    parked AS (
        SELECT tx AS transaction_id, CAST(((CAST(sum(s) AS BIGINT) + 18) // 36) / 100.0 AS DOUBLE)
               AS total_parking_time
        FROM islands GROUP BY tx)"""


@query(f"WITH {SESSIONS_SQL} SELECT * FROM started")
def correlate_request_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = charging_log(spark, sf_dir)
    started = started_transactions(silver(log, WIDE_START_RESPONSE), silver(log, WIDE_START_REQUEST))
    return started.withColumn("start_timestamp", epoch_seconds("start_timestamp"))


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = charging_log(spark, sf_dir)
    started, stops = jobs.transaction_ends(log, WIDE_START_RESPONSE, WIDE_START_REQUEST, WIDE_STOP_REQUEST)
    return materialise(stops, "stops").transform(attach_starts, materialise(started, "started"))


def _epochs(df: DataFrame) -> DataFrame:
    return df.withColumns({c: epoch_seconds(c) for c in ("start_timestamp", "stop_timestamp")})


@query(f"WITH {SESSIONS_SQL} SELECT * FROM sessions")
def session_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(_sessions(spark, sf_dir))


@query(
    f"""WITH {SESSIONS_SQL}, {PARKING_SQL}
        SELECT s.*, total_parking_time FROM sessions s LEFT JOIN parked p USING (transaction_id)"""
)
def parking_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = materialise(power_samples(charging_log(spark, sf_dir), METER_POWER.wide_ids()), "power")
    sessions = materialise(_sessions(spark, sf_dir), "sessions")
    return _epochs(attach_parking(sessions, idle_hours(power)))


# Aggregations


@query("SELECT count(*) AS n FROM events")
def event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(count_events)


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS charge_point_id FROM events ORDER BY 1")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(sorted_keys)


@query(
    """SELECT user_id, event_type, CAST(epoch(time_bucket(INTERVAL '5 minutes', ts)) AS BIGINT) AS window_start,
              CAST(epoch(time_bucket(INTERVAL '5 minutes', ts)) AS BIGINT) + 300 AS window_end,
              count(event_type) AS "count(status)"
       FROM events GROUP BY 1, 2, 3, 4"""
)
def tumbling_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.transform(status_counts, "user_id", "event_type", "ts", name="count(status)").select(
        "user_id",
        "event_type",
        epoch_seconds("window.start").alias("window_start"),
        epoch_seconds("window.end").alias("window_end"),
        "count(status)",
    )


@query(
    """WITH q AS (
           SELECT event_type, count(value) AS n, avg(value) AS mean, min(value) AS min, max(value) AS max,
                  quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
       f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q),
       o AS (SELECT e.event_type,
                    CAST(sum(CASE WHEN value < lower_fence OR value > upper_fence THEN 1 ELSE 0 END) AS BIGINT)
                    AS outliers
             FROM events e JOIN f ON e.event_type = f.event_type GROUP BY e.event_type)
       SELECT event_type, n, round(mean, 6) AS mean, round(min, 6) AS min, round(q1, 6) AS q1,
              round(median, 6) AS median, round(q3, 6) AS q3, round(max, 6) AS max,
              round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence, outliers
       FROM f JOIN o USING (event_type)"""
)
def distribution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").transform(distribution, "value", ["event_type"], digits=6)


@query(
    """SELECT event_type, floor(value / 10) * 10 AS bin, count(*) AS n
       FROM events WHERE value IS NOT NULL GROUP BY 1, 2"""
)
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = table(spark, sf_dir, "events").transform(histogram, "value", 10.0, ["event_type"])
    return bins.withColumn("bin", F.col("bin").cast("double"))


@query(EVENT_LOG_SQL)
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    return drop_repeated_messages(log.unionByName(log))


# Windows


@query(
    f"""SELECT * FROM ({EVENT_LOG_SQL})
        QUALIFY row_number() OVER (PARTITION BY charge_point_id ORDER BY write_timestamp DESC, message_id DESC) = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(latest_rows)


@query(f"SELECT * FROM ({EVENT_LOG_SQL}) ORDER BY write_timestamp DESC, message_id LIMIT 10")
def top_n_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(top_latest, 10)


@query(
    """SELECT user_id AS transaction_id, event_id, charging,
              abs(charging - lag(charging, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS boundary
       FROM (SELECT *, CASE WHEN value > 30 THEN 1 ELSE 0 END AS charging FROM events)"""
)
def lag_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_boundaries(event_samples(spark, sf_dir), tie="event_id").select(
        "transaction_id", "event_id", "charging", "boundary"
    )


@query(
    """SELECT user_id AS transaction_id, event_id,
              CAST(sum(CASE WHEN value > 30 THEN 1 ELSE 0 END) OVER
                   (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far
       FROM events"""
)
def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = event_samples(spark, sf_dir).withColumn("charging", F.when(F.col("value") > 0, 1).otherwise(0))
    summed = ordered_columns(
        samples,
        ["transaction_id"],
        ["timestamp", "event_id"],
        sums={"so_far": F.col("charging")},
    )
    return summed.select("transaction_id", "event_id", "so_far")


@query(
    """SELECT user_id AS transaction_id, event_id,
              CAST(floor(epoch(min(ts) OVER (PARTITION BY user_id))) AS BIGINT) AS first,
              CAST(floor(epoch(max(ts) OVER (PARTITION BY user_id))) AS BIGINT) AS last FROM events"""
)
def partition_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = event_samples(spark, sf_dir)
    bounded = with_bounds(samples, ["transaction_id"], "timestamp")
    return bounded.select(
        "transaction_id", "event_id", epoch_seconds("first").alias("first"), epoch_seconds("last").alias("last")
    )


EVENT_ISLANDS_SQL = """
    flagged AS (SELECT user_id, event_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
                       CASE WHEN value > 30 THEN 1 ELSE 0 END AS charging FROM events),
    bounded AS (SELECT *, abs(charging - lag(charging, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id))
                       AS boundary FROM flagged),
    numbered AS (SELECT *, CAST(sum(boundary) OVER (PARTITION BY user_id ORDER BY ts, event_id
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM bounded),
    islands AS (SELECT user_id AS transaction_id, island, max(sec) - min(sec) AS duration
                FROM numbered WHERE charging = 0 GROUP BY user_id, island)"""


@query(f"WITH {EVENT_ISLANDS_SQL} SELECT * FROM islands")
def parking_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idle_islands(event_samples(spark, sf_dir), tie="event_id")


@query(
    f"""WITH {EVENT_ISLANDS_SQL}
        SELECT transaction_id, CAST(((CAST(sum(duration) AS BIGINT) + 18) // 36) / 100.0 AS DOUBLE)
               AS total_parking_time
        FROM islands GROUP BY transaction_id"""
)
def parking_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idle_hours(event_samples(spark, sf_dir), tie="event_id")


# Jobs


@query(
    """SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS VARCHAR) AS charge_point_id,
              event_type AS action, epoch_us(ts) AS written_us
       FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1"""
)
def last_connection_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).transform(jobs.last_connections).select(
        "message_id", "charge_point_id", "action", F.unix_micros("write_timestamp").alias("written_us")
    )


CDR_SQL = f"""
    WITH {SESSIONS_SQL}, {PARKING_SQL}
    SELECT charge_point_id, s.transaction_id, {{meters}} start_timestamp, stop_timestamp,
           CASE WHEN start_timestamp IS NOT NULL THEN {HOURS_SQL.format("(stop_timestamp - start_timestamp)")} END
           AS total_time,
           {{energy}} AS total_energy, total_parking_time
    FROM sessions s LEFT JOIN parked p ON s.transaction_id = p.transaction_id"""
KWH_USED_SQL = f"CASE WHEN meter_start IS NOT NULL THEN {KWH_SQL.format('(meter_stop - meter_start)')} END"


@query(CDR_SQL.format(meters="", energy="CAST(meter_stop - meter_start AS DOUBLE)"))
def charge_data_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(jobs.cdr_from_log(charging_log(spark, sf_dir), wide_ids=True))


@query(CDR_SQL.format(meters="meter_start, meter_stop, ", energy=KWH_USED_SQL))
def medallion_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = work_path(spark, "medallion-csv")
    # As text the log is some fifty times as large as its tables. A compressed file is one split, so it must be short.
    writer = charging_log(spark, sf_dir).write.option("maxRecordsPerFile", CSV_RECORDS)
    writer.option("header", True).option("compression", "gzip").csv(source)
    return _epochs(jobs.medallion(spark, source, work_path(spark, "medallion"), WIDE))


@query(
    f"""WITH cdr AS ({CDR_SQL.format(meters="", energy=KWH_USED_SQL)}),
        q AS (SELECT count(total_energy) AS n, avg(total_energy) AS mean, min(total_energy) AS min,
                     max(total_energy) AS max, quantile_cont(total_energy, 0.25) AS q1,
                     quantile_cont(total_energy, 0.5) AS median, quantile_cont(total_energy, 0.75) AS q3
              FROM cdr),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
        SELECT n, round(mean, 6) AS mean, round(min, 6) AS min, round(q1, 6) AS q1, round(median, 6) AS median,
               round(q3, 6) AS q3, round(max, 6) AS max, round(lower_fence, 6) AS lower_fence,
               round(upper_fence, 6) AS upper_fence,
               (SELECT count(*) FROM cdr WHERE total_energy < f.lower_fence OR total_energy > f.upper_fence)
               AS outliers
        FROM f"""
)
def cdr_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdr = jobs.cdr_from_log(charging_log(spark, sf_dir), unit="kwh", wide_ids=True)
    return cdr.transform(distribution, "total_energy", digits=6)


@query(
    f"""WITH cdr AS ({CDR_SQL.format(meters="", energy=KWH_USED_SQL)})
        SELECT floor(total_parking_time / 24) * 24 AS bin, count(*) AS n FROM cdr
        WHERE total_parking_time IS NOT NULL GROUP BY 1"""
)
def cdr_parking_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    cdr = jobs.cdr_from_log(charging_log(spark, sf_dir), wide_ids=True)
    return cdr.transform(histogram, "total_parking_time", 24.0).withColumn("bin", F.col("bin").cast("double"))


MINUTE_SQL = """
    starts AS (SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28 00:00:00'),
    stops AS (SELECT * FROM orders
              WHERE o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) >= TIMESTAMP '1997-05-28 00:00:00'
                AND o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) < TIMESTAMP '1997-05-28 00:01:00'),
    lines AS (SELECT *, 'meter-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id FROM lineitem
              WHERE l_shipdate = TIMESTAMP '1997-05-28 00:00:00')"""


@query(
    f"""WITH {MINUTE_SQL}
        SELECT 'EventLog' AS "table", 'start-' || o_orderkey AS message_id, CAST(2 AS DOUBLE) AS number FROM starts
        UNION ALL SELECT 'EventLog', 'start-' || o_orderkey, 3 FROM starts
        UNION ALL SELECT 'EventLog', 'stop-' || o_orderkey, 2 FROM stops
        UNION ALL SELECT 'EventLog', id, 2 FROM lines
        UNION ALL SELECT 'StartTransactionRequest', 'start-' || o_orderkey, o_custkey FROM starts
        UNION ALL SELECT 'StartTransactionResponse', 'start-' || o_orderkey, o_orderkey FROM starts
        UNION ALL SELECT 'StopTransactionRequest', 'stop-' || o_orderkey,
                         o_custkey + CAST(round(o_totalprice * 100) AS BIGINT) FROM stops
        UNION ALL SELECT 'MeterValuesRequest', id, l_quantity - 25 FROM lines
        UNION ALL SELECT 'MeterValuesRequest', id, l_extendedprice FROM lines
        UNION ALL SELECT 'MeterValuesRequest', id, l_tax FROM lines"""
)
def silver_minute_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute's messages by charge point and day; a second run replaces the minute's slice."""
    bronze, base = work_path(spark, "minute-bronze"), work_path(spark, "minute-silver")
    log = with_date_parts(_at_five_points(charging_log(spark, sf_dir)))
    # Seven years of few messages a day: days of their own would be thousands of tiny files. Within a month, files are
    # sorted, so that row groups of other days are skipped.
    write_partitioned(log, bronze, ["year", "month"], sort_within=["day", "hour", "minute"])
    database = "minute " + base[-32:]
    for _ in range(2):
        paths = jobs.silver_minute(
            spark,
            bronze,
            base,
            datetime(1997, 5, 28, 0, 1),
            database,
            WIDE,
            work_path(spark, "minute-db"),
            by_charge_point=True,
        )
    number = {
        "EventLog": "message_type",
        START_REQUEST.table: "meter_start",
        START_RESPONSE.table: "transaction_id",
        STOP_REQUEST.table: "meter_stop",
        METER_VALUES.table: "value",
    }
    result = None
    for name in paths:
        rows = spark.table(f"`{database.replace(' ', '')}`.`{name}`").where("slice = '199705280000'").select(
            F.lit(name).alias("table"), "message_id", F.col(number[name]).cast("double").alias("number")
        )
        result = rows if result is None else result.unionByName(rows)
    return result
