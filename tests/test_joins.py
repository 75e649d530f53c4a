from datetime import datetime, timezone

from pyspark.sql import functions as F

from chargetrail.operators.joins import (
    attach_parking,
    attach_starts,
    correlate,
    hot_hashes,
    salted_join,
    salted_left_join,
    started_transactions,
    with_totals,
)
from conftest import plan_text, rows


def at(hour, minute=0):
    return datetime(2022, 1, 1, hour, minute, tzinfo=timezone.utc)


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000, numPartitions=6).select(
        "id", F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END").alias("k")
    )
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    right = right.unionByName(spark.sql("SELECT 7L k, 71L x UNION ALL SELECT 7L, 72L UNION ALL SELECT NULL, 0L"))
    salted = salted_left_join(left, right, "k", slice_rows=100).select("id", "k", "x")
    assert rows(salted) == rows(left.join(right, "k", "left").select("id", "k", "x"))


def test_hot_keys_are_spread(spark):
    left = spark.range(4000, numPartitions=4).select("id", F.lit(5).alias("k"))
    right = spark.sql("SELECT 5 k, 1 x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = salted_left_join(left, right, "k", slice_rows=50)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 4000 and len(sizes) == 4 and max(r["count"] for r in sizes) < 2000
        assert "SortMergeJoin" in plan_text(joined)
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{key}")


def test_hot_keys_of_both_sides_are_cut(spark):
    left = spark.range(400, numPartitions=4).select("id", F.when(F.col("id") < 300, 5).otherwise(F.col("id")).alias("k"))
    right = spark.range(500, numPartitions=3).select(
        F.when(F.col("id") < 250, 5).when(F.col("id") < 320, 350).when(F.col("id") < 400, -1).alias("k"), F.col("id").alias("x")
    )
    wanted = rows(left.join(right, "k", "left").select("id", "k", "x"))
    for width in (7, 60, 280, 10_000):
        joined = salted_left_join(left, right, "k", slice_rows=width)
        assert joined.columns == ["k", "id", "x"]
        assert rows(joined.select("id", "k", "x")) == wanted
    names = ("autoBroadcastJoinThreshold", "adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        one = spark.createDataFrame([(1, 5)], "id int, k int")
        joined = salted_left_join(one, right.where("k = 5"), "k", slice_rows=10)
        assert joined.groupBy(F.spark_partition_id()).count().count() > 1 and joined.count() == 250
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.{name}")


def test_hot_keys_need_no_shuffle_of_the_keys(spark, folder):
    rows_ = spark.range(60_000, numPartitions=6)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
    rows_.select("id", key.alias("k")).write.parquet(folder + "/left")
    rows_.limit(100).select(F.lit(9).cast("long").alias("k")).write.parquet(folder + "/right")
    left, right = spark.read.parquet(folder + "/left"), spark.read.parquet(folder + "/right")
    sides = {name: df.where("k IS NOT NULL").select(F.xxhash64("k").alias("_hash")) for name, df in (("left", left), ("right", right))}
    found = hot_hashes(sides, 50)
    hashes = {r[0]: r[1] for r in spark.createDataFrame([(7,), (9,)], "k long").select(F.xxhash64("k"), "k").collect()}
    cuts = {hashes[key]: slices for key, *slices in found}
    assert cuts.keys() == {7, 9} and cuts[7][0] in (400, 401) and cuts[7][1] == 1 and cuts[9] == [1, 2]
    assert hot_hashes(sides, 10**6) == []
    assert hot_hashes({name: df.limit(0) for name, df in sides.items()}, 1) == []
    # Of a side only its sketches meet: 6 tasks, 2 sides, whatever the number of keys.
    plain = salted_join(left, right, "k", slice_rows=10**6)
    assert plan_text(plain).count("Exchange hashpartitioning") <= 2


def test_one_id_in_a_third_of_both_sides(spark):
    """Requests and responses with one message id in a third of the rows, without adaptive execution."""
    requests = spark.range(600, numPartitions=3).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).when(F.col("id") % 7 == 1, None).otherwise(F.col("id").cast("string")).alias("m"),
        F.col("id").alias("x"),
    )
    responses = requests.select("m", (F.col("x") * 2).alias("x"))
    names = ("autoBroadcastJoinThreshold", "adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plain = responses.selectExpr("m AS k", "x AS a").join(requests.selectExpr("m AS k", "x AS b"), "k").select("a", "b")
        joined = correlate(responses, requests, "m", {"a": "x"}, {"b": "x"}, slice_rows=40)
        assert joined.columns == ["a", "b"]
        assert rows(joined) == rows(plain)
        hot = joined.where("b % 3 = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) == 4 and max(r["count"] for r in hot) < 0.6 * 200 * 200
    finally:
        for name in names:
            spark.conf.unset(f"spark.sql.{name}")


def started(spark):
    responses = spark.createDataFrame(
        [("m1", "cp1", 1), ("m2", "cp2", 2), ("m9", "cp9", 9)], "message_id string, charge_point_id string, transaction_id int"
    )
    requests = spark.createDataFrame(
        [("m1", 0, at(8)), ("m2", 50, at(9)), ("m8", 0, at(9))], "message_id string, meter_start int, timestamp timestamp"
    )
    return started_transactions(responses, requests)


def stops(spark):
    return spark.createDataFrame(
        [(1, 2780, at(8, 20)), (77, 5, at(9)), (None, 6, at(9))], "transaction_id int, meter_stop int, timestamp timestamp"
    )


def test_started_transactions_is_inner(spark):
    assert rows(started(spark).select("charge_point_id", "transaction_id", "meter_start")) == [("cp1", 1, 0), ("cp2", 2, 50)]


def test_unmatched_stops_lose_their_id(spark):
    sessions = with_totals(attach_starts(stops(spark), started(spark)))
    got = rows(sessions.select("charge_point_id", "transaction_id", "meter_stop", "total_time", "total_energy"))
    assert got == [("cp1", 1, 2780, 0.33, 2.78), (None, None, 5, None, None), (None, None, 6, None, None)]
    kept = attach_starts(stops(spark), started(spark), keep_left_key=True)
    assert rows(kept.select("transaction_id", "meter_stop")) == [(1, 2780), (77, 5), (None, 6)]


def test_parking_is_null_without_a_match(spark):
    sessions = with_totals(attach_starts(stops(spark), started(spark)))
    parking = spark.createDataFrame([(2, 1.5), (3, 1.0)], "transaction_id int, total_parking_time double")
    assert {r.total_parking_time for r in attach_parking(sessions, parking).collect()} == {None}
    parking = spark.createDataFrame([(1, 1.5)], "transaction_id int, total_parking_time double")
    got = rows(attach_parking(sessions, parking).select("transaction_id", "total_parking_time"))
    assert got == [(1, 1.5), (None, None), (None, None)]
