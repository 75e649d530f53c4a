"""The physical plans that the operators are meant to get."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from chargetrail.operators.joins import started_transactions
from chargetrail.operators.ordered import latest_per_key
from chargetrail.operators.parking import parking_time
from chargetrail.plans.derived_logs import charging_log
from chargetrail.operators.messages import silver
from chargetrail.schemas import METER_VALUES, STOP_REQUEST
from chargetrail.sinks import write_partitioned
from chargetrail.sources import read_parquet
from conftest import plan_text

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_hot_message_is_split_by_the_join(spark, folder):
    """A third of the responses answer one request; adaptive execution cuts their partition up."""
    responses = spark.range(60000, numPartitions=12).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'm' || id END").alias("message_id"),
        F.lit("cp").alias("charge_point_id"),
        F.col("id").cast("int").alias("transaction_id"),
    )
    requests = spark.range(60000, numPartitions=12).select(
        F.expr("CASE WHEN id = 0 THEN 'hot' ELSE 'm' || id END").alias("message_id"),
        F.lit(0).alias("meter_start"),
        F.current_timestamp().alias("timestamp"),
    )
    with settings(
        spark,
        autoBroadcastJoinThreshold=-1,
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__advisoryPartitionSizeInBytes="10KB",
    ):
        joined = started_transactions(responses, requests)
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan_text(joined)


def test_hot_partition_is_split_by_the_write(spark, folder):
    rows = spark.range(60000, numPartitions=8).selectExpr("id", "uuid() AS text", "if(id % 3 = 0, 1, id % 7) AS p")
    with settings(spark, adaptive__advisoryPartitionSizeInBytes="100KB"):
        write_partitioned(rows, folder + "/t", ["p"])
    files = [f for f in spark.read.parquet(folder + "/t").inputFiles() if "p=1/" in f]
    assert len(files) > 1
    assert spark.read.parquet(folder + "/t").count() == 60000


def test_only_needed_columns_are_read(spark, folder):
    log = charging_log(spark, SF_DIR)
    log.write.parquet(folder + "/log")
    stops = silver(read_parquet(spark, folder + "/log"), STOP_REQUEST).select("transaction_id", "meter_stop")
    plan = plan_text(stops)
    assert "ReadSchema: struct<message_type:int,action:string,body:string>" in plan
    assert "EqualTo(action,StopTransaction)" in plan


def test_union_branches_of_other_classes_are_pruned(spark):
    plan = plan_text(silver(charging_log(spark, SF_DIR), METER_VALUES))
    assert "lineitem" in plan and "orders" not in plan


def test_parking_time_aggregates_by_hash(spark, folder):
    spark.range(10).selectExpr(
        "id % 3 AS transaction_id", "timestamp_seconds(id) AS timestamp", "cast(id AS double) AS value", "id AS tie"
    ).write.parquet(folder + "/p")
    for tie in (None, "tie"):
        plan = plan_text(parking_time(spark.read.parquet(folder + "/p"), tie=tie))
        assert "SortAggregate" not in plan and "Python" not in plan
        assert plan.count("Exchange") == 2


def test_latest_is_limited_before_the_shuffle(spark, folder):
    messages = spark.range(9).selectExpr(
        "id % 2 AS charge_point_id", "id AS write_timestamp", "id AS message_id"
    )
    messages.write.parquet(folder + "/l")
    plan = plan_text(latest_per_key(spark.read.parquet(folder + "/l")))
    partial, shuffle = plan.rindex("WindowGroupLimit"), plan.index("Exchange")
    assert partial > shuffle  # below the shuffle in the printed tree
