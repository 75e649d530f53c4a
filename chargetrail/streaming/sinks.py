"""Streaming sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from chargetrail.operators.ordered import drop_repeated_messages, pick_per_key
from chargetrail.storage import exists, names, publish, remove
from chargetrail.streaming.keyindex import BUCKET, KeyIndex


def _refuse_foreign(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A new checkpoint numbers its batches from 0, which would overwrite those of another stream."""
    if not exists(spark, checkpoint) and names(spark, path):
        raise ValueError(f"{path} has data, and {checkpoint} knows nothing of it")


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] | list[str] = (),
    fmt: str = "parquet",
) -> DataStreamWriter:
    """Append finished rows to a lake table; the checkpoint makes each row appear once."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_first(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "message_id",
    ts: str = "write_timestamp",
    buckets: int = 64,
    fan: int = 8,
) -> DataStreamWriter:
    """Append the first arrival of every `key`, however late it is; `ts` decides within a batch. Rows with a NULL key
    are not known to be copies and all stay.

    Each batch goes below `path/batch=<id>`, without the keys of earlier batches. These are looked up in a `KeyIndex` below
    `path/_keys`, of which a batch opens only the `buckets` that its own keys fall into: choose so many that a bucket is a
    file of some 100 MB. No watermark drops a row, the result has the same keys for every batch size, and a batch that is
    repeated after a failure overwrites its own folders. A path that holds data is refused without its checkpoint.
    """
    _refuse_foreign(stream.sparkSession, path, checkpoint)
    index = KeyIndex(f"{path}/_keys", key, dict(stream.dtypes)[key], buckets, fan)

    def write_batch(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        index.clean(spark, batch)
        fresh = drop_repeated_messages(rows, key, ts)
        if batch:
            own = rows.where(F.col(key).isNotNull()).select(index.bucket()).distinct()
            seen = index.seen(spark, batch, [row[BUCKET] for row in own.collect()])  # at most `buckets` numbers
            seen = seen.withColumnRenamed(key, "_seen")
            fresh = fresh.join(seen, fresh[key] == seen["_seen"], "left_anti")
        folder = f"{path}/batch={batch}"
        fresh.write.mode("overwrite").parquet(folder)
        written = spark.read.schema(rows.schema).parquet(folder)
        index.add(written.where(F.col(key).isNotNull()), batch)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)


def upsert_log(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, compact_every: int = 16
) -> DataStreamWriter:
    """Write every batch's changed rows below `path/batch=<id>`; for streams in update mode.

    A batch that is repeated after a failure overwrites its own folder, so nothing doubles. With `keys`, every
    `compact_every` batches the newest row of each key is written to a base, and the folders it replaces go one
    compaction later. `current_view` reads the current state. A path that holds data is refused without its checkpoint.
    """
    _refuse_foreign(stream.sparkSession, path, checkpoint)

    def write_batch(changes: DataFrame, batch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        if keys and (batch + 1) % compact_every == 0:
            compact(changes.sparkSession, path, keys, batch)

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )


def latest_view(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last written row of every key, from rows with the number of their `batch`."""
    return pick_per_key(changes, keys, [F.col("batch").desc()]).drop("batch")


def _bases(spark: SparkSession, path: str) -> list[int]:
    """The last batch of every published base, in ascending order."""
    return sorted(int(name) for name in names(spark, f"{path}/_manifest") if name.isdigit())


def _rows(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The newest base and the changes after it, with the number of their `batch`."""
    bases = [last for last in _bases(spark, path) if upto is None or last < upto]
    base = bases[-1] if bases else -1
    found = (int(name.removeprefix("batch=")) for name in names(spark, path) if name.startswith("batch="))
    newer = sorted(batch for batch in found if batch > base and (upto is None or batch <= upto))
    folders = [f"{path}/batch={batch}" for batch in newer]
    changes = None
    if folders:
        changes = spark.read.option("basePath", path).parquet(*folders).withColumn("batch", F.col("batch").cast("long"))
    if base < 0:
        if changes is None:
            raise FileNotFoundError(f"nothing has been written to {path}")
        return changes
    compacted = spark.read.parquet(f"{path}/_base/upto={base}")
    return compacted if changes is None else compacted.unionByName(changes)


def compact(spark: SparkSession, path: str, keys: list[str], batch: int) -> None:
    """Write the newest row of every key, up to `batch`, as the base of a table of `upsert_log`.

    The base counts once its marker is in the manifest, which appears as a whole, so a reader sees the old base or the new
    one. What the base before the last replaced is removed: readers that began with the last base still find all its files.
    """
    before = _bases(spark, path)
    if batch not in before:
        newest = pick_per_key(_rows(spark, path, batch), keys, [F.col("batch").desc()])
        newest.write.mode("overwrite").parquet(f"{path}/_base/upto={batch}")
        publish(spark, f"{path}/_manifest/{batch}")
    last = max((base for base in before if base < batch), default=None)
    if last is None:
        return
    for base in before:
        if base < last:
            remove(spark, f"{path}/_manifest/{base}")
            remove(spark, f"{path}/_base/upto={base}")
    for name in names(spark, path):
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= last:
            remove(spark, f"{path}/{name}")


def current_view(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row of every key of a table of `upsert_log`: the newest base and the changes since."""
    return latest_view(_rows(spark, path), keys)


def split_late(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "timestamp",
    lateness: str = "10 minutes",
    width: str = "5 minutes",
) -> DataStreamWriter:
    """Keep late rows apart: rows whose window of `width` had ended `lateness` before the newest row of the earlier
    batches go below `path/late`, all others (and rows without a time) below `path/on_time`, each in `batch=<id>`.

    Windowed counts of the rows on time lose none. The newest time of all batches so far is written with each batch, a
    row each, so a restart goes on with it; a repeated batch reads what the one before it has written and overwrites its own
    folders. A path that holds data is refused without its checkpoint.
    """
    _refuse_foreign(stream.sparkSession, path, checkpoint)

    def newest_before(spark: SparkSession, batch: int) -> int | None:
        if not batch:
            return None
        return spark.read.schema("newest long").parquet(f"{path}/_newest/batch={batch - 1}").first()["newest"]

    def write_batch(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = F.lit(newest_before(spark, batch)).cast("long")
        late = is_late(ts, before, lateness, width)
        for name, part in (("late", rows.where(late)), ("on_time", rows.where(~late))):
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch}")
        newest = rows.agg(F.greatest(F.max(F.unix_millis(ts)), before).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{path}/_newest/batch={batch}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)


def is_late(ts: str, newest: Column, lateness: str = "10 minutes", width: str = "5 minutes") -> Column:
    """Whether the window of `ts` had ended `lateness` before `newest` (milliseconds since 1970); not so if either is NULL."""

    def millis(interval: str) -> Column:
        return F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))

    at = F.unix_millis(ts)
    end = at - F.pmod(at, millis(width)) + millis(width)
    return F.coalesce(end <= newest - millis(lateness), F.lit(False))


def rows_dropped(query) -> int:
    """Rows that a stream's stateful operators have dropped as late, by its recent progress."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)
