"""Dense row index over an explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargetrail.operators.ordered import in_ranges


def with_row_index(df: DataFrame, order: list[str] | tuple[str, ...] = (), name: str = "index") -> DataFrame:
    """Add `name`: 0..n-1 in the ascending order of `order`; equal rows keep their input order.

    The rows are sorted by ranges, one range per task, and written once. The index is then the
    task's offset plus the position in the task; only one count per task meets in one place. `df`
    should be a scan or a written table.
    """
    ranged = in_ranges(df, list(order), "_part", position="_position")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per task of the sort: at most spark.sql.shuffle.partitions rows.
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .drop("_part", "_offset", "_position", "_place")
    )
