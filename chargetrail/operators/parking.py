"""Time a session spends connected without drawing power."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargetrail.functions import epoch_seconds, positive_flag
from chargetrail.operators.ordered import CHUNK, ordered_columns, with_ranges


def with_boundaries(
    df: DataFrame,
    key: str = "transaction_id",
    ts: str = "timestamp",
    value: str = "value",
    tie: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add `charging` (1 or 0) and `boundary`, 1 where charging differs from the sample before.

    Before the first sample counts as not charging.
    """
    flagged = df.withColumn("charging", positive_flag(value))
    previous = ordered_columns(
        flagged, [key], [ts, tie or value], lags={"_previous": (F.col("charging"), 0)}, ranges=ranges
    )
    return previous.withColumn("boundary", F.abs(F.col("charging") - F.col("_previous"))).drop("_previous")


def idle_islands(
    df: DataFrame,
    key: str = "transaction_id",
    ts: str = "timestamp",
    value: str = "value",
    tie: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per run of idle samples: key, island number, seconds from first to last sample.

    The island's number is how often charging has changed up to it. Changes are counted within each range first and
    reduced to runs there; what came before a range is added to its runs, and a run that goes on in the next ranges is put
    together in the end. `parking_time` gets the totals with fewer shuffles.
    """
    samples = with_ranges(df.withColumn("_charging", positive_flag(value)), [key], [ts, tie or value], ranges)
    within = Window.partitionBy(key, CHUNK).orderBy(ts, tie or value, "_place")
    before = F.lag("_charging").over(within)
    changes = samples.select(
        key,
        CHUNK,
        epoch_seconds(ts).alias("_seconds"),
        "_charging",
        F.abs(F.col("_charging") - before).alias("_change"),
        F.row_number().over(within).alias("_nth"),
    )
    so_far = Window.partitionBy(key, CHUNK).orderBy("_nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = changes.withColumn("_run", F.coalesce(F.sum("_change").over(so_far), F.lit(0)))
    runs = numbered.groupBy(key, CHUNK, "_run", "_charging").agg(
        F.min("_seconds").alias("_from"), F.max("_seconds").alias("_to")
    )
    # One row per key and range: its first and last state, and the changes inside.
    ends = runs.groupBy(key, CHUNK).agg(
        F.min_by("_charging", "_run").alias("_first"), F.max_by("_charging", "_run").alias("_last"), F.max("_run").alias("_inside")
    )
    across = Window.partitionBy(key).orderBy(CHUNK)
    entered = F.abs(F.col("_first") - F.lag("_last", 1, 0).over(across))
    upto = F.sum(F.col("_entered") + F.col("_inside")).over(across)
    earlier = ends.select(key, CHUNK, "_inside", entered.alias("_entered")).select(
        F.col(key).alias("_key"), F.col(CHUNK).alias("_range"), (upto - F.col("_inside")).alias("_before")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(CHUNK) == F.col("_range"))
    joined = runs.where("_charging = 0").join(earlier, same)
    island = (F.col("_run") + F.col("_before")).alias("island")
    return joined.groupBy(key, island).agg((F.max("_to") - F.min("_from")).alias("duration"))


def parking_time(
    df: DataFrame,
    key: str = "transaction_id",
    ts: str = "timestamp",
    value: str = "value",
    tie: str | None = None,
    name: str = "total_parking_time",
    ranges: int | None = None,
) -> DataFrame:
    """Hours of idle runs per key, two decimals; keys without an idle sample have no row.

    A run lasts from its first to its last idle sample, so it is the sum of the gaps between
    neighbouring samples that are both idle. Gaps add up, so no island has to be numbered and no
    task holds a whole key: each (key, range) is reduced to its inner gaps and its two ends,
    and the few ranges of a key are joined at the end. `df` is read twice (`with_ranges`): pass a scan or a
    written table.
    """
    idle = 1 - positive_flag(value)
    samples = with_ranges(df, [key], [ts, tie or value], ranges).select(
        key,
        F.col(ts).alias("_ts"),
        F.col(tie or value).alias("_tie"),
        "_place",
        idle.cast("byte").alias("_idle"),
        CHUNK,
    )
    samples = samples.withColumn("_seconds", epoch_seconds("_ts"))

    def gap(seconds: Column, idle: Column, seconds_before: Column, idle_before: Column) -> Column:
        return F.when((idle == 1) & (idle_before == 1), seconds - seconds_before).otherwise(0)

    within = Window.partitionBy(key, CHUNK).orderBy("_ts", "_tie", "_place")
    idle_before, idle_after = F.lag("_idle").over(within), F.lead("_idle").over(within)
    inner = gap(F.col("_seconds"), F.col("_idle"), F.lag("_seconds").over(within), idle_before)
    # Plain numbers only, so that the chunks are aggregated by hash.
    chunks = (
        samples.select(
            key,
            CHUNK,
            "_seconds",
            F.col("_idle").alias("_any_idle"),
            inner.alias("_gap"),
            F.when(idle_before.isNull(), F.col("_idle")).alias("_first_idle"),
            F.when(idle_after.isNull(), F.col("_idle")).alias("_last_idle"),
        )
        .groupBy(key, CHUNK)
        .agg(
            F.sum("_gap").alias("_inner"),
            F.max("_any_idle").alias("_any_idle"),
            F.min("_seconds").alias("_from"),
            F.max("_seconds").alias("_to"),
            F.max("_first_idle").alias("_first_idle"),
            F.max("_last_idle").alias("_last_idle"),
        )
    )
    across = Window.partitionBy(key).orderBy(CHUNK)
    bridge = gap(
        F.col("_from"), F.col("_first_idle"), F.lag("_to").over(across), F.lag("_last_idle").over(across)
    )
    return (
        chunks.select(key, "_inner", "_any_idle", bridge.alias("_bridge"))
        .groupBy(key)
        .agg(
            F.round((F.sum("_inner") + F.sum("_bridge")) / 3600, 2).alias(name),
            F.max("_any_idle").alias("_any_idle"),
        )
        .where("_any_idle = 1")
        .drop("_any_idle")
    )
