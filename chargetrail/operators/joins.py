"""Joins that relate messages to each other and to derived tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargetrail.functions import energy_delta, hours_between
from chargetrail.schemas import CDR_WIDE_COLUMNS

SLICE_ROWS = 1_000_000
#: Counters that a task keeps to find frequent keys, and the most keys of a side that are cut.
COUNTERS, MOST_HOT = 8_192, 2_000
#: Tasks' counters are merged in so many places before they meet in one.
_MERGERS = 64


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "left",
    right_unique: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`left.join(right, on, how)`, left or inner, in which no frequent key of either side meets in one task.

    A key is hot when a side has more than `slice_rows` rows of it. Its rows are cut into as many slices on either side
    as their number asks for, and every left slice meets every right slice in a task of its own: left rows are repeated
    once per right slice, right rows once per left slice. So there are at most 1 / `slice_rows` copies per joined row,
    and one per row. Left rows without a key match nothing; a left join passes them by without a shuffle.

    Hot keys are found when the join is built (`hot_hashes`), in one pass over the key columns without a shuffle of them,
    and are sent to all tasks as a list of at most 2 * `MOST_HOT` rows; without any this is Spark's own join. Slices
    follow a row's place in its task, so pass scans or written tables. `right_unique` says that `right` has one row per key;
    then it may be any plan and is not read for its keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"no salted {how} join")
    keyed = left.where(F.col(on).isNotNull())
    # Equal numbers of different types have different hashes.
    kind = left.select(on).union(right.select(on)).schema[on].dataType
    hashed = F.xxhash64(F.col(on).cast(kind))
    sides = {"left": keyed.select(hashed.alias("_hash"))}
    if not right_unique:
        sides["right"] = right.where(F.col(on).isNotNull()).select(hashed.alias("_hash"))
    found = hot_hashes(sides, slice_rows)
    if found:
        hot = left.sparkSession.createDataFrame(found, "_hash long, _lefts int, _rights int")

        def sliced(df: DataFrame, own: str, other: str) -> DataFrame:
            counted = df.join(F.broadcast(hot), hashed == F.col("_hash"), "left").drop("_hash")
            slices = F.sequence(F.lit(0), F.col(f"{other}s") - 1)
            place = F.pmod(F.monotonically_increasing_id(), F.col(f"{own}s")).cast("int")
            return counted.withColumn(own, F.when(F.col(f"{own}s") > 1, place).otherwise(0)).withColumn(
                other, F.explode(F.when(F.col(f"{other}s") > 1, slices).otherwise(F.array(F.lit(0))))
            )

        here = sliced(keyed, "_left", "_right").drop("_lefts")
        there = sliced(right, "_right", "_left").drop("_lefts", "_rights").withColumn("_found", F.lit(True))
        joined = here.join(there, [on, "_left", "_right"], how)
        # A key with several right slices has matches, though perhaps not in each of them.
        joined = joined.where("coalesce(_rights, 1) = 1 OR _found").drop("_left", "_right", "_rights", "_found")
    else:
        joined = keyed.join(right, on, how)
    if how == "inner":
        return joined
    return joined.unionByName(left.where(F.col(on).isNull()), allowMissingColumns=True)


def salted_left_join(
    left: DataFrame, right: DataFrame, on: str, right_unique: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """`salted_join` that keeps all rows of `left`."""
    return salted_join(left, right, on, "left", right_unique, slice_rows)


def hot_hashes(sides: dict[str, DataFrame], slice_rows: int = SLICE_ROWS) -> list[tuple[int, int, int]]:
    """(hash, left slices, right slices) of the hashes of keys, `_hash`, with more than `slice_rows` rows on a side.

    Each task keeps at most `COUNTERS` counters of its hashes (a frequent-items sketch) and drops the least when
    they are used up; sketches are merged, so of the keys nothing is shuffled. A count is too high by at most 1 /
    2,000 of the side's rows; a key with fewer rows than that is never hot, whatever `slice_rows`, as a task's even share is
    about as much. Two keys with one hash are cut alike, which changes no result.
    """
    both = None
    for name, df in sides.items():
        rows = df.select(F.lit(name).alias("_side"), "_hash")
        both = rows if both is None else both.unionByName(rows)
    sketch = F.expr(f"approx_top_k_accumulate(_hash, {COUNTERS})").alias("_sketch")
    merged = both.groupBy("_side", F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("_merger")).agg(
        F.count("*").alias("_rows"), sketch
    )
    estimate = F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {COUNTERS}), {MOST_HOT})").alias("_top")
    sketched = merged.groupBy("_side").agg(F.sum("_rows").alias("_rows"), estimate).collect()  # a row per side
    slices: dict[int, dict[str, int]] = {}
    least = max([slice_rows, *(row["_rows"] / MOST_HOT for row in sketched)])
    for row in sketched:
        for top in row["_top"]:
            if top["count"] > least:
                slices.setdefault(top["item"], {})[row["_side"]] = math.ceil(top["count"] / least)
    return [(key, cut.get("left", 1), cut.get("right", 1)) for key, cut in slices.items()]


def attach_per_group(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Add the columns of `right`, which has one row per group of `by`; NULL groups match too.

    Frequent groups of `left` are cut as in `salted_left_join`. Without `by`, `right` is one row.
    """
    added = [name for name in right.columns if name not in by]
    if not by:
        return left.withColumns({name: right.select(name).scalar() for name in added})
    group = F.struct(*by)
    return salted_left_join(
        left.withColumn("_group", group), right.select(group.alias("_group"), *added), "_group", True
    ).drop("_group")


def with_bounds(
    df: DataFrame, keys: list[str], column: str, first: str = "first", last: str = "last"
) -> DataFrame:
    """Add the smallest and largest `column` of the row's key to every row."""
    bounds = df.groupBy(*keys).agg(F.min(column).alias(first), F.max(column).alias(last))
    return attach_per_group(df, bounds, keys)


def correlate(
    responses: DataFrame,
    requests: DataFrame,
    on: str,
    from_response: dict[str, str],
    from_request: dict[str, str],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join of responses with their requests; the maps give new column -> source column.

    Ids that a retry or a fault has repeated very often are cut on both sides (`salted_join`).
    """

    def side(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        return df.select(F.col(on).alias("_on"), *[F.col(source).alias(name) for name, source in columns.items()])

    joined = salted_join(side(responses, from_response), side(requests, from_request), "_on", "inner", slice_rows=slice_rows)
    return joined.select(*from_response, *from_request)


def started_transactions(responses: DataFrame, requests: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Start responses (which know the transaction) with their requests (which know the meter)."""
    return correlate(
        responses,
        requests,
        "message_id",
        {"charge_point_id": "charge_point_id", "transaction_id": "transaction_id"},
        {"meter_start": "meter_start", "start_timestamp": "timestamp"},
        slice_rows,
    )


def attach_starts(
    stops: DataFrame, started: DataFrame, keep_left_key: bool = False, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Every stop with the start of its transaction, if there is one.

    Charge point and transaction come from the start, so both are NULL without one;
    `keep_left_key` takes the transaction from the stop. Further columns of `started` are passed on.
    """
    extra = [c for c in started.columns if c not in ("charge_point_id", "transaction_id", "meter_start", "start_timestamp")]
    joined = salted_left_join(
        stops.select(
            F.col("transaction_id").alias("_key"),
            "meter_stop",
            F.col("timestamp").alias("stop_timestamp"),
        ),
        started.withColumn("_key", F.col("transaction_id")),
        "_key",
        slice_rows=slice_rows,
    )
    key = F.col("_key" if keep_left_key else "transaction_id").alias("transaction_id")
    return joined.select(
        "charge_point_id", key, "meter_start", "meter_stop", "start_timestamp", "stop_timestamp", *extra
    )


def with_totals(df: DataFrame, unit: str = "kwh") -> DataFrame:
    """Add `total_time` in hours and `total_energy`."""
    return df.withColumns(
        {
            "total_time": hours_between("start_timestamp", "stop_timestamp"),
            "total_energy": energy_delta("meter_start", "meter_stop", unit),
        }
    )


def attach_parking(cdr: DataFrame, parking: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add each transaction's parking time, of which there is one; NULL where it has none."""
    joined = salted_left_join(cdr, parking, "transaction_id", True, slice_rows)
    return joined.select(*[c for c in CDR_WIDE_COLUMNS if c in joined.columns])
