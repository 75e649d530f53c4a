"""Ordered computations per key that do not put a whole key into one task.

A plain window sends every row of a key to one task. Here all rows are cut into even ranges of (key, order), and are shuffled
by (key, range). What a range needs to know of the key's earlier ranges comes as one extra "carry" row at its head.
Carry rows are made from one summary row per (key, range). There are few of these, as most keys lie in one range.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chargetrail.functions import instant
from chargetrail.session import materialise

CHUNK = "_chunk"
_IS_ROW = "_is_row"
#: Rows sampled per range: more make the ranges more even.
_SAMPLES = 16


def with_ranges(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None, name: str = CHUNK) -> DataFrame:
    """Add `_place`, the row's place in the input, and `name`, the number of its range in the order of (keys, order,
    `_place`). Ranges are about even, `ranges` in all (twice `spark.sql.shuffle.partitions` by default).

    The borders come from a sample, the rows whose hashes are smallest. It is part of the plan and the same however often
    it is drawn, so building the plan starts no job, and a plan that reads the result twice gets one numbering.
    `_place` lets copies lie in several ranges. Places are those of Spark's scan: pass a scan or a written table.
    """
    if ranges is None:
        ranges = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    at = F.struct(*keys, *order, "_place")
    sample = (
        placed.select(at.alias("_at"))
        .orderBy(F.xxhash64("_at"), "_at")
        .limit(_SAMPLES * ranges)
        .agg(F.sort_array(F.collect_list("_at")).alias("_all"))
    )
    every = F.filter("_all", lambda _, i: i % _SAMPLES == _SAMPLES - 1)
    borders = sample.select(every).scalar()
    # A binary search, unrolled so that it is compiled with its surroundings: `name` is how many borders are surely not
    # above the row. Beyond the last border there is NULL, which is not below it.
    numbered = placed.withColumns({"_at": at, name: F.lit(0)})
    for bit in reversed(range(ranges.bit_length())):
        low, probe = F.col(name), F.col(name) + (1 << bit)
        numbered = numbered.withColumn(name, F.when(F.get(borders, probe - 1) <= F.col("_at"), probe).otherwise(low))
    return numbered.drop("_at")


def in_ranges(df: DataFrame, order: list[str], chunk: str, position: str | None = None) -> DataFrame:
    """Sort `df` by ranges, one per task, and write it; `chunk` numbers the ranges.

    `position` adds the row's number within its range. The column `_place` holds the row's place in
    the input and is the last sort column: it keeps equal rows in their order and lets a large
    group of copies be cut into several ranges. Pass a scan or a written table, where places are
    stable.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    ranged = (
        placed.repartitionByRange(*order, "_place")
        .sortWithinPartitions(*order, "_place")
        .withColumn(chunk, F.spark_partition_id())
    )
    if position:
        # The id holds the row's number within its task in the low 33 bits.
        number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ranged = ranged.withColumn(position, number)
    return materialise(ranged, "ranges")


def ordered_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lags: dict[str, tuple[Column, object]] | None = None,
    sums: dict[str, Column] | None = None,
    wholes: dict[str, tuple[Callable[[str], Column], Column]] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add previous values, running sums and whole-key aggregates, in ascending `order` (NULLs first); rows that are equal
    in it keep the order of the input.

    `lags` maps a new column to (value, default for a key's first row), `sums` a new column to the
    summed value, `wholes` a new column to (`F.min`, `F.max` or `F.sum`, value) over all rows of the
    key. `df` is read three times (`with_ranges`, summaries, rows): pass a scan or a written table, not a costly plan.
    """
    numbered = with_ranges(df, keys, order, ranges)
    return prefix_scan(numbered, keys, [*order, "_place"], lags, sums, wholes).select(
        *df.columns, *(lags or {}), *(sums or {}), *(wholes or {})
    )


def prefix_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lags: dict[str, tuple[Column, object]] | None = None,
    sums: dict[str, Column] | None = None,
    wholes: dict[str, tuple[Callable[[str], Column], Column]] | None = None,
    chunk: str = CHUNK,
) -> DataFrame:
    """`ordered_columns` on a table whose column `chunk` numbers ranges: it never falls along a key's `order`."""
    lags, sums, wholes = lags or {}, sums or {}, wholes or {}
    rows = df.select(
        "*",
        *[value.alias(f"_lag_{name}") for name, (value, _) in lags.items()],
        *[value.alias(f"_sum_{name}") for name, value in sums.items()],
        *[value.alias(f"_whole_{name}") for name, (_, value) in wholes.items()],
    )

    across = Window.partitionBy(*keys).orderBy(chunk)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    summary, carry = [], []
    if lags:
        values = F.struct(*[f"_lag_{name}" for name in lags])
        summary.append(F.max_by(values, F.struct(*order)).alias("_last"))
        is_first = F.row_number().over(across) == 1
        for name, (_, default) in lags.items():
            previous = F.lag(f"_last._lag_{name}").over(across)
            carry.append(F.when(is_first, F.lit(default)).otherwise(previous).alias(f"_lag_{name}"))
    for name in sums:
        summary.append(F.sum(f"_sum_{name}").alias(f"_sum_{name}"))
        carry.append(F.sum(f"_sum_{name}").over(before).alias(f"_sum_{name}"))
    for name, (aggregate, _) in wholes.items():
        summary.append(aggregate(f"_whole_{name}").alias(f"_whole_{name}"))
        carry.append(aggregate(f"_whole_{name}").over(whole).alias(f"_whole_{name}"))
    carried = rows.groupBy(*keys, chunk).agg(*summary).select(*keys, chunk, *carry)

    within = Window.partitionBy(*keys, chunk).orderBy(_IS_ROW, *order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn(_IS_ROW, F.lit(1))
        .unionByName(carried.withColumn(_IS_ROW, F.lit(0)), allowMissingColumns=True)
        .select(
            *df.columns,
            _IS_ROW,
            *[F.lag(f"_lag_{name}").over(within).alias(name) for name in lags],
            *[F.sum(f"_sum_{name}").over(so_far).alias(name) for name in sums],
            *[F.first(f"_whole_{name}").over(so_far).alias(name) for name in wholes],
        )
        .where(F.col(_IS_ROW) == 1)
        .drop(_IS_ROW)
    )


def pick_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in `order`.

    Spark limits each task to one row per key before the shuffle (WindowGroupLimit).
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_per_key(
    df: DataFrame, key: str = "charge_point_id", ts: str = "write_timestamp", tie: str = "message_id"
) -> DataFrame:
    """Each key's most recent row by instant, whatever the offsets of time texts; at equal times the one with the larger
    `tie`. Times that do not parse are older than all others."""
    return pick_per_key(df, [key], [instant(ts).desc(), F.col(tie).desc()])


def top_latest(df: DataFrame, n: int, ts: str = "write_timestamp", tie: str = "message_id") -> DataFrame:
    """The `n` most recent rows by instant; times that do not parse come last."""
    return df.orderBy(instant(ts).desc(), F.col(tie)).limit(n)


def distinct_keys(df: DataFrame, key: str = "charge_point_id") -> DataFrame:
    """The different keys, sorted."""
    return df.select(key).distinct().sort(key)


def drop_repeated_messages(
    df: DataFrame,
    key: str | tuple[str, ...] = "message_id",
    ts: str = "write_timestamp",
    ties: tuple[str, ...] = (),
    known: tuple[str, ...] = (),
) -> DataFrame:
    """One row per message id (or several key columns), the earliest written by instant; times that do not parse count
    as latest. Rows with a NULL in a column of `known` (all key columns by default) are not known to be copies and all
    stay."""
    keys = [key] if isinstance(key, str) else list(key)
    # Rows without a key have a group each, so they are neither dropped nor gathered in one task.
    unknown = reduce(Column.__or__, [F.col(column).isNull() for column in known or keys])
    own = df.withColumn("_own", F.when(unknown, F.monotonically_increasing_id()))
    order = [instant(ts).asc_nulls_last(), *[F.col(tie) for tie in ties]]
    return pick_per_key(own, [*keys, "_own"], order).drop("_own")
