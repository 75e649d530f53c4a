"""Counts and distribution summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargetrail.operators.joins import attach_per_group
from chargetrail.operators.ordered import prefix_scan
from chargetrail.session import materialise


def event_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def status_counts(
    df: DataFrame,
    key: str = "charge_point_id",
    status: str = "status",
    ts: str = "timestamp",
    width: str = "5 minutes",
    name: str | None = None,
) -> DataFrame:
    """Rows per key, status and tumbling window, on a batch or a stream.

    NULL statuses form a group of their own with count 0.
    """
    counted = F.count(status).alias(name or f"count({status})")
    return df.groupBy(key, status, F.window(ts, width).alias("window")).agg(counted)


def histogram(df: DataFrame, value: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Rows per bin of `width`; `bin` is the bin's lower edge."""
    edge = F.floor(F.col(value) / width) * width
    return df.where(F.col(value).isNotNull()).groupBy(*(by or []), edge.alias("bin")).agg(
        F.count("*").alias("n")
    )


def _ranked_value(p: float) -> Column:
    """Exact quantile with linear interpolation, from values with their cumulated counts."""
    at = (F.col("_total") - 1) * F.lit(p)

    def value_at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col("_value")))

    low, high = value_at(F.floor(at)), value_at(F.ceil(at))
    part = F.first(at - F.floor(at))
    return low + (high - low) * part


def distribution(df: DataFrame, value: str, by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Per group: n, mean, min, quartiles, max, box-plot fences and how many values lie outside.

    Exact, and no group has to fit into one task: equal values are counted first, then the
    (value, count) pairs are sorted by ranges and written, and ranks are found by running sums
    within ranges.
    """
    by = list(by or [])
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    ranged = materialise(
        counted.repartitionByRange(*by, "_value").withColumn("_range", F.spark_partition_id()),
        "distribution",
    )
    ranked = prefix_scan(
        ranged,
        by,
        ["_value"],
        sums={"_upto": F.col("_n")},
        wholes={"_total": (F.sum, F.col("_n"))},
        chunk="_range",
    )
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    summary = ranked.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col("_value") * F.col("_n")) / F.sum("_n")).alias("mean"),
        F.min("_value").alias("min"),
        F.max("_value").alias("max"),
        *[_ranked_value(p).alias(name) for name, p in quartiles.items()],
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    summary = materialise(
        summary.withColumns({"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach}),
        "distribution-summary",
    )
    outside = (F.col("_value") < F.col("lower_fence")) | (F.col("_value") > F.col("upper_fence"))
    outliers = (
        attach_per_group(ranged, summary.select(*by, "lower_fence", "upper_fence"), by)
        .groupBy(*by)
        .agg(F.coalesce(F.sum(F.when(outside, F.col("_n"))), F.lit(0)).alias("outliers"))
    )
    rounded = ["mean", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence"]
    return attach_per_group(summary, outliers, by).select(
        *by, "n", *[F.round(name, digits).alias(name) for name in rounded], "outliers"
    )
