import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chargetrail.operators.ordered import (
    distinct_keys,
    drop_repeated_messages,
    latest_per_key,
    ordered_columns,
    top_latest,
    with_ranges,
)
from chargetrail.operators.joins import with_bounds
from chargetrail.operators.parking import idle_islands, parking_time, with_boundaries
from chargetrail.sources import with_row_index
from conftest import plan_text, rows

START = datetime(2022, 1, 1, tzinfo=timezone.utc)


def skewed_samples(seed, n=600):
    """(key, seconds, id, value): one key holds a third of the rows, some keys and values are NULL,
    and there are equal times."""
    draw = random.Random(seed)
    data = []
    for i in range(n):
        key = 1 if draw.random() < 0.34 else draw.choice([None, 2, 3, 4, 5, 6, 7])
        data.append((key, draw.randrange(0, 40000), i, draw.choice([None, -1.0, 0.0, 2.0, 3.0])))
    return data


def frame(spark, data):
    return spark.createDataFrame(
        [(k, START + timedelta(seconds=s), i, v) for k, s, i, v in data],
        "k int, ts timestamp, id int, v double",
    ).repartition(4)


def by_key(data):
    groups = {}
    for row in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.fixture
def no_jobs(spark):
    """A function that says how many jobs Spark has run since the last call."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    seen = set(tracker.getJobIdsForGroup("plans"))

    def started():
        new = set(tracker.getJobIdsForGroup("plans")) - seen
        seen.update(new)
        return len(new)

    yield started
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("ranges", [1, 3, 16, None])
def test_lag_sum_and_wholes_match_brute_force(spark, ranges):
    data = skewed_samples(ranges or 2)
    df = ordered_columns(
        frame(spark, data),
        ["k"],
        ["ts", "id"],
        lags={"before": (F.col("v"), -9.0)},
        sums={"so_far": F.col("v"), "nth": F.lit(1)},
        wholes={"top": (F.max, F.col("id"))},
        ranges=ranges,
    )
    want = {}
    for group in by_key(data).values():
        total, before = None, -9.0
        for nth, (_, _, i, v) in enumerate(group, 1):
            total = total if v is None else (total or 0.0) + v
            want[i] = (before, total, nth, max(r[2] for r in group))
            before = v
    got = {r.id: (r.before, r.so_far, r.nth, r.top) for r in df.collect()}
    assert got == want


def test_ordered_columns_shuffle_rows_once(spark, folder):
    frame(spark, skewed_samples(1)).write.parquet(folder + "/s")
    df = spark.read.parquet(folder + "/s")
    summed = ordered_columns(df, ["k"], ["ts", "id"], sums={"s": F.col("v")})
    plan = plan_text(summed)
    # one for the rows with the carries, two for the summaries; the sample is a bounded sort in a subquery
    assert plan.count("Exchange hashpartitioning") == 3 and "Exchange rangepartitioning" not in plan
    assert "Join" not in plan


def test_building_an_ordered_plan_starts_no_job(spark, folder, no_jobs):
    frame(spark, skewed_samples(1)).write.parquet(folder + "/s")
    df = spark.read.schema("k int, ts timestamp, id int, v double").parquet(folder + "/s")
    no_jobs()
    plans = [
        ordered_columns(df, ["k"], ["ts", "id"], sums={"s": F.col("v")}),
        with_boundaries(df, "k", "ts", "v", "id"),
        idle_islands(df, "k", "ts", "v", "id"),
        parking_time(df, "k", "ts", "v", "id"),
    ]
    assert no_jobs() == 0
    assert all(plan.count() for plan in plans) and no_jobs() > 0


def test_ranges_are_even_and_cut_copies(spark, folder):
    """A third of all rows are copies of one row, and another third has one key."""
    copies = [(1, 50, -1, 2.0)] * 4000
    data = [(k, s, i, v) for k, s, i, v in skewed_samples(9, 8000)] + copies
    frame(spark, data).write.parquet(folder + "/s")
    df = spark.read.parquet(folder + "/s")
    ranged = with_ranges(df, ["k"], ["ts", "id"], 12)
    sizes = [r["count"] for r in ranged.groupBy("_chunk").count().collect()]
    assert len(sizes) == 13 and max(sizes) < 2.5 * len(data) / 13
    assert ranged.where("id = -1").select("_chunk").distinct().count() > 3
    # ranges follow the order
    ends = ranged.groupBy("_chunk").agg(F.min(F.struct("k", "ts", "id", "_place")).alias("a"), F.max(F.struct("k", "ts", "id", "_place")).alias("b"))
    ends = [(r.a, r.b) for r in ends.orderBy("_chunk").collect()]
    assert all(tuple((x is not None, x) for x in b) < tuple((x is not None, x) for x in a) for (_, b), (a, _) in zip(ends, ends[1:]))
    nth = ordered_columns(df, ["k"], ["ts", "id"], sums={"nth": F.lit(1)}, ranges=12)
    per_key = nth.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("nth").alias("d"), F.max("nth").alias("m"))
    assert all(r.n == r.d == r.m for r in per_key.collect())


def test_no_rows(spark):
    df = frame(spark, skewed_samples(1)).where("k > 100")
    assert ordered_columns(df, ["k"], ["ts"], sums={"s": F.col("v")}).isEmpty()
    assert parking_time(df, "k", "ts", "v").isEmpty() and idle_islands(df, "k", "ts", "v").isEmpty()


def test_bounds(spark):
    data = skewed_samples(5)
    df = with_bounds(frame(spark, data), ["k"], "id")
    groups = by_key(data)
    found = df.collect()
    assert len(found) == len(data)
    for row in found:
        ids = [r[2] for r in groups[row.k]]
        assert (row.first, row.last) == (min(ids), max(ids))


def brute_parking(data):
    result = {}
    for key, group in by_key(data).items():
        idle = [not (v is not None and v > 0) for *_, v in group]
        if any(idle):
            seconds = 0
            for a, b in zip(range(len(group)), range(1, len(group))):
                if idle[a] and idle[b]:
                    seconds += group[b][1] - group[a][1]
            result[key] = seconds
    return result


@pytest.mark.parametrize("ranges", [1, 5, 40])
@pytest.mark.parametrize("seed", [3, 4])
def test_parking_time_matches_brute_force(spark, ranges, seed):
    data = skewed_samples(seed)
    df = frame(spark, data)
    got = {r.k: r.total_parking_time for r in parking_time(df, "k", "ts", "v", "id", ranges=ranges).collect()}
    want = brute_parking(data)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k] / 3600) <= 0.0051 for k in want)
    islands = idle_islands(df, "k", "ts", "v", "id", ranges=ranges)
    assert Counter((r.k, r.island, r.duration) for r in islands.collect()) == brute_islands(data)


def brute_islands(data):
    found = {}
    for key, group in by_key(data).items():
        island, before = 0, 0
        for _, seconds, _, v in group:
            charging = int(v is not None and v > 0)
            island += charging != before
            before = charging
            if not charging:
                first, last = found.get((key, island), (seconds, seconds))
                found[key, island] = (min(first, seconds), max(last, seconds))
    return Counter((*at, last - first) for at, (first, last) in found.items())


def test_parking_time_by_hand(spark):
    samples = {
        1: [(10, 5.0), (20, 0.0), (30, 0.0), (40, 7.0), (50, 0.0), (80, 0.0)],
        2: [(10, 0.0)],
        3: [(10, 4.0)],
        4: [(10, 0.0), (20, None), (50, 3.0)],
    }
    data = [(k, START + timedelta(minutes=m), v) for k, values in samples.items() for m, v in values]
    df = spark.createDataFrame(data, "transaction_id int, timestamp timestamp, value double")
    assert rows(parking_time(df)) == [(1, 0.67), (2, 0.0), (4, 0.17)]
    got = rows(with_boundaries(df).where("transaction_id = 1").select("timestamp", "charging", "boundary"))
    assert [(c, b) for _, c, b in got] == [(1, 1), (0, 1), (0, 0), (1, 1), (0, 1), (0, 0)]


def messages(spark):
    data = [("a", 1, "m1"), ("a", 3, "m2"), ("a", 3, "m3"), ("b", 2, "m4"), (None, 1, "m5"), ("b", 2, "m4")]
    return spark.createDataFrame(data, "charge_point_id string, write_timestamp int, message_id string")


def test_latest_per_key(spark):
    df = latest_per_key(messages(spark))
    assert rows(df.select("charge_point_id", "message_id")) == [("a", "m3"), ("b", "m4"), (None, "m5")]
    # every task keeps one row per key before the shuffle
    assert plan_text(df).count("WindowGroupLimit") == 2


def test_top_and_distinct(spark):
    df = top_latest(messages(spark), 2)
    assert [r.message_id for r in df.collect()] == ["m2", "m3"]
    assert "TakeOrderedAndProject" in plan_text(df)
    assert [r[0] for r in distinct_keys(messages(spark)).collect()] == [None, "a", "b"]


def test_drop_repeated_messages(spark):
    df = messages(spark)
    later = df.withColumn("write_timestamp", F.col("write_timestamp") + 10)
    assert rows(drop_repeated_messages(later.unionByName(df))) == rows(df.distinct())


def test_parking_time_with_default_tie_and_copies(spark):
    data = [(k, s // 900 * 900, i, v) for k, s, i, v in skewed_samples(11)] * 3
    df = frame(spark, data)
    got = {r.k: r.total_parking_time for r in parking_time(df, "k", "ts", "v").collect()}
    ranged = parking_time(df, "k", "ts", "v", ranges=60)
    assert {r.k: r.total_parking_time for r in ranged.collect()} == got
    by_value = [(k, s, -10.0 if v is None else v, v) for k, s, _, v in data]
    want = brute_parking(by_value)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k] / 3600) <= 0.0051 for k in want)


def test_row_index_keeps_the_order_of_copies(spark):
    df = spark.createDataFrame([(1, i) for i in range(300)], "k int, i int").coalesce(1)
    assert all(r["index"] == r.i for r in with_row_index(df, ["k"]).collect())
    assert all(r["index"] == r.i for r in with_row_index(df).collect())


def test_row_index_is_dense_and_ordered(spark):
    keys = list(range(1000))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k * 3,) for k in keys], "k int").repartition(7)
    got = sorted((r["index"], r.k) for r in with_row_index(df, ["k"]).collect())
    assert got == [(i, i * 3) for i in range(1000)]


def test_order_is_by_instant_not_by_text(spark):
    df = spark.createDataFrame(
        [("cp", "m1", "2022-01-01T09:30:00+02:00"), ("cp", "m2", "2022-01-01T08:00:00+00:00"), ("cp", "m0", "xx")],
        "charge_point_id string, message_id string, write_timestamp string",
    )
    assert [r.message_id for r in latest_per_key(df).collect()] == ["m2"]
    assert [r.message_id for r in top_latest(df, 3).collect()] == ["m2", "m1", "m0"]
    first = drop_repeated_messages(df, "charge_point_id")
    assert [r.message_id for r in first.collect()] == ["m1"]


def test_messages_without_an_id_are_no_copies(spark):
    df = spark.createDataFrame(
        [("cp", None, 2, "x", 1), ("cp", None, 2, "x", 2), ("cp", None, 2, "x", 2), ("cp", "m", 2, None, 4), ("cp", "m", 2, None, 3)],
        "charge_point_id string, message_id string, message_type int, action string, write_timestamp long",
    ).withColumn("write_timestamp", F.timestamp_seconds("write_timestamp").cast("string"))
    keys = ("charge_point_id", "message_id", "message_type", "action")
    for got in (drop_repeated_messages(df), drop_repeated_messages(df, keys, known=("message_id",))):
        assert got.columns == df.columns
        assert sorted((r.message_id or "", r.write_timestamp[-1]) for r in got.collect()) == [("", "1"), ("", "2"), ("", "2"), ("m", "3")]
