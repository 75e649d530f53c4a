import json

from pyspark.sql import functions as F

from chargetrail.operators.messages import (
    flatten_struct,
    import_power,
    meter_samples,
    of_class,
    silver,
    unpack_json,
)
from chargetrail.schemas import EVENT_LOG, METER_VALUES, START_RESPONSE, STATUS, STOP_REQUEST
from chargetrail.streaming import status_events
from conftest import plan_text, rows


def log(spark, *messages):
    return spark.createDataFrame(
        [(str(i), t, "cp", a, "2024-03-17T05:41:10+00:00", json.dumps(b)) for i, (a, t, b) in enumerate(messages)],
        EVENT_LOG,
    )


def test_of_class(spark):
    df = log(spark, ("Heartbeat", 3, {}), ("Heartbeat", 2, {}), ("Reset", 2, {}), ("Heartbeat", 2, {}), ("heartbeat", 2, {}))
    assert [r.message_id for r in df.transform(of_class, "Heartbeat", 2).collect()] == ["1", "3"]


def test_of_class_reaches_the_scan(spark, folder):
    log(spark, ("a", 2, {})).write.parquet(folder + "/log")
    plan = plan_text(spark.read.parquet(folder + "/log").transform(of_class, "a", 2))
    assert "EqualTo(action,a)" in plan and "EqualTo(message_type,2)" in plan


def test_unpack_edge_cases(spark):
    df = spark.createDataFrame([("nope",), ('{"a":"x","b":"k"}',), ('{"a":2.0}',), ('{"a":1,"b":"z","c":5}',)], "body string")
    parsed = unpack_json(df, "a int, b string").select("new_body.*")
    assert [tuple(r) for r in parsed.collect()] == [(None, None), (None, "k"), (None, None), (1, "z")]


def test_unpack_keeps_corrupt_text(spark):
    df = spark.createDataFrame([("nope",), ('{"a":1}',)], "body string")
    parsed = unpack_json(df, "a int", keep_corrupt=True).select("new_body.*")
    assert [tuple(r) for r in parsed.collect()] == [(None, "nope"), (1, None)]


def test_flatten_start_response(spark):
    body = {"transaction_id": 7, "id_tag_info": {"status": "Accepted", "parent_id_tag": "p", "expiry_date": None}}
    flat = silver(log(spark, ("StartTransaction", 3, body)), START_RESPONSE)
    assert flat.columns[5:] == [
        "transaction_id",
        "id_tag_info_status",
        "id_tag_info_parent_id_tag",
        "id_tag_info_expiry_date",
    ]
    assert tuple(flat.first())[5:] == (7, "Accepted", "p", None)


def test_flatten_keeps_other_columns(spark):
    df = spark.sql("SELECT 1 x, named_struct('a', 2, 'b', named_struct('c', 3)) s, 'gone' body")
    flat = flatten_struct(df, "s")
    assert flat.columns == ["x", "a", "b_c"] and tuple(flat.first()) == (1, 2, 3)


def test_silver_stop_types(spark):
    body = {"meter_stop": 5, "timestamp": "2024-03-17T06:59:01+00:00", "transaction_id": 1, "transaction_data": ["q"]}
    flat = silver(log(spark, ("StopTransaction", 2, body)), STOP_REQUEST)
    types = dict(flat.dtypes)
    assert types["timestamp"] == "timestamp" and types["transaction_data"] == "array<string>"
    assert types["write_timestamp"] == "string" and types["meter_stop"] == "int"
    assert flat.count() == 1


def test_wide_ids(spark):
    body = {"meter_stop": 5_000_000_000, "transaction_id": 6_000_000_000}
    df = log(spark, ("StopTransaction", 2, body))
    assert silver(df, STOP_REQUEST).first().transaction_id is None
    wide = silver(df, STOP_REQUEST.wide_ids()).first()
    assert (wide.transaction_id, wide.meter_stop) == (6_000_000_000, 5_000_000_000)


def reading(*samples, at="2024-03-17T05:43:37+00:00"):
    return {"timestamp": at, "sampled_value": [{"value": v, "measurand": m, "phase": p} for v, m, p in samples]}


def test_meter_samples_drop_empty_arrays(spark):
    power = "Power.Active.Import"
    messages = [
        {"transaction_id": 1, "connector_id": 2, "meter_value": [reading(("1.005", power, None), ("x", "Voltage", "L1"))]},
        {"transaction_id": 2, "meter_value": []},
        {"transaction_id": 3},
        {"transaction_id": 4, "meter_value": [{"timestamp": None, "sampled_value": None}, reading(("7", power, "L1"))]},
    ]
    df = log(spark, *[("MeterValues", 2, m) for m in messages])
    flat = silver(df, METER_VALUES)
    assert flat.columns[5:] == ["transaction_id", "connector_id", "timestamp", "measurand", "phase", "value"]
    got = rows(flat.select("transaction_id", "measurand", "phase", "value"))
    assert got == [(1, power, None, 1.01), (1, "Voltage", "L1", None), (4, power, "L1", 7.0)]
    direct = meter_samples(unpack_json(df, METER_VALUES.body), only_power=True)
    assert direct.columns == ["transaction_id", "timestamp", "measurand", "phase", "value"]
    assert rows(direct) == rows(import_power(flat).select(*direct.columns))


def test_json_of_meter_values_is_parsed_once(spark, folder):
    log(spark, ("MeterValues", 2, {"meter_value": [reading(("1", "Voltage", None))]})).write.parquet(folder + "/log")
    unpacked = unpack_json(spark.read.parquet(folder + "/log"), METER_VALUES.body)
    assert plan_text(meter_samples(unpacked, only_power=True)).count("from_json") == 1


def test_status_in_both_spellings(spark):
    df = log(
        spark,
        ("StatusNotification", 2, {"connector_id": 1, "status": "Charging", "timestamp": "2024-03-17T07:15:44+00:00", "info": "text"}),
        ("StatusNotification", 2, {"connectorId": 2, "errorCode": "NoError", "status": "Available", "timestamp": "2024-03-18T20:31:09.118"}),
    )
    body = unpack_json(df, STATUS.body, other_names=STATUS.other_names).select("new_body.*")
    got = rows(body.select("connector_id", "error_code", "status", "info"))
    assert got == [(1, None, "Charging", "text"), (2, "NoError", "Available", None)]
    assert status_events(df).columns == ["charge_point_id", "status", "timestamp"]
    assert status_events(df).where(F.col("timestamp").isNull()).count() == 0
