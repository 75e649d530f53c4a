import gzip
import json
import os
from datetime import datetime

import pytest

from chargetrail import session
from chargetrail.operators.timeslice import time_slice, with_date_parts
from chargetrail.schemas import EVENT_LOG
from chargetrail.session import clear_work, materialise, work_path
from chargetrail.sinks import (
    create_database,
    create_external_table,
    sanitised_name,
    write_parquet,
    write_partitioned,
    write_routed,
    write_slice,
)
from chargetrail.sources.json_arrays import json_array_records
from chargetrail.sources import (
    has_delta,
    read_csv_log,
    read_json_records,
    read_last_minute,
    read_parquet,
    read_table,
    read_time_slice,
    spread,
)
from conftest import plan_text, rows

HEADER = "message_id,message_type,charge_point_id,action,write_timestamp,body\n"
BODY = '{"a": "b, c"}'


@pytest.mark.parametrize("escape,quoted", [("\\", BODY.replace('"', '\\"')), ('"', BODY.replace('"', '""'))])
def test_csv_escapes_and_gzip(spark, folder, escape, quoted):
    text = HEADER + f'm1,2,cp,Stop,2022-01-01T08:00:00+00:00,"{quoted}"\n'
    with gzip.open(folder + "/log.csv.gz", "wt") as file:
        file.write(text)
    df = read_csv_log(spark, folder + "/log.csv.gz", escape=escape)
    assert dict(df.dtypes)["message_type"] == "int"
    assert rows(df) == [("m1", 2, "cp", "Stop", "2022-01-01T08:00:00+00:00", BODY)]


def test_csv_inferred_and_delimiter(spark, folder):
    with open(folder + "/log.csv", "w") as file:
        file.write("a;b\n1;2.5\n")
    df = read_csv_log(spark, folder + "/log.csv", schema=None, delimiter=";")
    assert df.dtypes == [("a", "int"), ("b", "double")]


def test_json_array_file_with_index(spark, folder):
    records = [{"message_id": f"m{i}", "message_type": 2} for i in range(5)]
    with gzip.open(folder + "/log.json.gz", "wt") as file:
        json.dump(records, file)
    df = read_json_records(spark, folder + "/log.json.gz", layout="array", index_by=["message_id"])
    assert dict(df.dtypes)["message_type"] == "bigint"
    assert rows(df.select("index", "message_id")) == [(i, f"m{i}") for i in range(5)]


def test_json_lines(spark, folder):
    with open(folder + "/log.json", "w") as file:
        file.write('{"message_id":"a"}\n{"message_id":"b"}\n')
    assert rows(read_json_records(spark, folder + "/log.json", "message_id string")) == [("a",), ("b",)]


def log(spark, n=6):
    data = [
        (f"m{i}", 2 + i % 2, f"cp{i % 3}", "Start" if i < 4 else "Stop", f"2022-01-0{1 + i % 2}T08:0{i}:30+00:00", "{}")
        for i in range(n)
    ]
    return spark.createDataFrame(data, EVENT_LOG)


def test_parquet_overwrites(spark, folder):
    for n in (6, 4):
        write_parquet(log(spark, n), folder + "/t")
    assert rows(read_parquet(spark, folder + "/t")) == rows(log(spark, 4))


def test_partitioned_append_by_charge_point(spark, folder):
    parted = with_date_parts(log(spark), parts=("year", "month", "day"))
    for _ in range(2):
        write_partitioned(parted, folder + "/t")
    table = read_table(spark, folder + "/t")
    assert table.count() == 12
    plan = plan_text(table.where("charge_point_id = 'cp1'"))
    assert "PartitionFilters: [isnotnull(charge_point_id" in plan


def test_partitioned_replace_is_idempotent(spark, folder):
    parted = with_date_parts(log(spark))
    for part in (parted, parted.where("day = 1"), parted.where("day = 2")):
        write_partitioned(part, folder + "/t", ["year", "month", "day"], mode="replace")
    table = read_table(spark, folder + "/t")
    assert table.count() == 6


def test_one_file_per_small_partition(spark, folder):
    wide = spark.range(1000, numPartitions=8).selectExpr("id", "id % 3 AS p")
    write_partitioned(wide, folder + "/t", ["p"])
    assert len(read_table(spark, folder + "/t").inputFiles()) == 3


def test_routed(spark, folder):
    write_routed(log(spark), folder + "/t")
    got = read_table(spark, folder + "/t").groupBy("table").count()
    assert rows(got) == [("StartRequest", 2), ("StartResponse", 2), ("StopRequest", 1), ("StopResponse", 1)]


def test_time_slices_prune_folders(spark, folder):
    write_partitioned(with_date_parts(log(spark)), folder + "/t", ["year", "month", "day"])
    when = datetime(2022, 1, 1, 8, 2)
    assert [r.message_id for r in read_time_slice(spark, folder + "/t", when).collect()] == ["m2"]
    assert [r.message_id for r in read_last_minute(spark, folder + "/t", datetime(2022, 1, 1, 8, 3, 59)).collect()] == ["m2"]
    plan = plan_text(read_table(spark, folder + "/t").transform(time_slice, when))
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert all(f"{p}#" in filters for p in ("year", "month", "day"))


def test_time_slice_without_part_columns(spark, folder):
    when = datetime(2022, 1, 1, 8, 2, 59)
    assert [r.message_id for r in log(spark).transform(time_slice, when).collect()] == ["m2"]
    log(spark).selectExpr("message_id", "timestamp(write_timestamp) AS write_timestamp").write.parquet(folder + "/t")
    stamped = read_parquet(spark, folder + "/t").transform(time_slice, when)
    assert [r.message_id for r in stamped.collect()] == ["m2"]
    assert "GreaterThanOrEqual(write_timestamp" in plan_text(stamped)


def test_catalog(spark, folder):
    assert sanitised_name("a-b_c 1!") == "abc1"
    before = spark.catalog.currentDatabase()
    name = create_database(spark, "my-db", folder + "/db")
    assert name == "mydb" == spark.catalog.currentDatabase()
    spark.sql(f"USE {before}")
    parts = ["year", "month", "day"]
    write_partitioned(with_date_parts(log(spark)), folder + "/t", parts)
    schema = read_table(spark, folder + "/t").schema
    table = create_external_table(spark, name, "log", folder + "/t", schema=schema, partition_by=parts)
    assert spark.sql(f"SELECT * FROM {table}").count() == 6
    write_parquet(log(spark), folder + "/flat")
    flat = create_external_table(spark, name, "flat", folder + "/flat")
    assert rows(spark.table(flat)) == rows(log(spark))


def test_work_folder(spark):
    path = work_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir", "/")) and path != work_path(spark, "x")
    assert rows(materialise(spark.range(3), "x")) == [(0,), (1,), (2,)]


def test_spread(spark):
    assert spread(spark.range(8, numPartitions=1)).rdd.getNumPartitions() == 4
    assert "Exchange" not in plan_text(spread(spark.range(8, numPartitions=9)))


def test_delta_is_optional(spark):
    assert not has_delta(spark)


def test_a_day_is_a_day_whatever_columns_there_are(spark):
    from chargetrail.operators.timeslice import DAY, with_date_parts

    times = ["2022-01-01T08:00:00+00:00", "2022-01-01T23:59:59+00:00", "2022-01-02T00:00:00+00:00", "xx"]
    df = spark.createDataFrame([(t,) for t in times], "write_timestamp string")
    when = datetime(2022, 1, 1, 8, 0)
    for table in (df, df.transform(with_date_parts, "write_timestamp", DAY), df.transform(with_date_parts, "write_timestamp", ("year",))):
        assert table.transform(time_slice, when, DAY).count() == 2
        assert table.transform(time_slice, when).count() == 1
    assert df.transform(with_date_parts).where("year IS NULL").count() == 1


def slice_rows(spark, path):
    schema = "m string, v int, charge_point_id string, year int, month int, day int, slice string"
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).select("m", "charge_point_id", "day", "slice").collect())


def test_slices_share_folders_and_are_replaced_as_one(spark, folder):
    """Minutes of one day in the layout by charge point and day, with ids that begin with zeros."""
    path = folder + "/log"

    def write(stamp, *messages):
        data = [(m, 1, cp, 2022, 1, 3) for m, cp in messages]
        df = spark.createDataFrame(data, "m string, v int, charge_point_id string, year int, month int, day int")
        return {r.charge_point_id for r in write_slice(df, path, stamp).collect()}

    assert write("0101", ("a", "0012"), ("b", "7/x y=1"), ("c", None)) == {"0012", "7/x y=1", None}
    write("0102", ("d", "0012"), ("e", "12"))
    both = [("a", "0012", 3, "0101"), ("b", "7/x y=1", 3, "0101"), ("c", None, 3, "0101"), ("d", "0012", 3, "0102"), ("e", "12", 3, "0102")]
    assert slice_rows(spark, path) == both
    assert write("0101", ("a", "0012"), ("b", "7/x y=1"), ("c", None)) == {"0012", "7/x y=1", None}
    assert slice_rows(spark, path) == both
    # a charge point that the minute has no more loses its folder, the other minute none
    assert write("0101", ("a2", "0012")) == {"0012"}
    assert slice_rows(spark, path) == [("a2", "0012", 3, "0101"), *both[3:]]
    assert write("0102") == set()
    assert slice_rows(spark, path) == [("a2", "0012", 3, "0101")]


ARRAY_OBJECTS = [
    {"id": 1, "text": 'braces } { and "quotes" \\ in, strings [ ]', "more": {"a": [1, {"b": "}"}]}},
    {"id": 2, "text": "", "more": None},
    {"id": 3, "text": 'ends with a backslash \\', "more": {"a": []}},
    {"id": 4, "text": '\\" }, {"id": 9, "text": "no"}', "more": {}},
    *[{"id": i, "text": "}{" * (i % 5) + '"' * (i % 3), "more": {"a": [{"b": "{" * (i % 4)}] * (i % 3)}} for i in range(5, 400)],
]
ARRAY_SCHEMA = "id long, text string, more struct<a: array<struct<b: string>>>"


@pytest.mark.parametrize("indent", [None, 2])
def test_array_file_is_read_by_several_tasks(spark, folder, indent):
    objects = [o for o in ARRAY_OBJECTS if o["id"] != 1]
    with open(folder + "/a.json", "w", encoding="utf-8") as file:
        json.dump(objects, file, indent=indent)
    whole = spark.read.schema(ARRAY_SCHEMA).option("multiLine", True).json(folder + "/a.json")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = spark.read.option("lineSep", "}").text(folder + "/a.json")
        assert scan.rdd.getNumPartitions() > 5
        got = read_json_records(spark, folder + "/a.json", ARRAY_SCHEMA, "array")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())) and got.count() == len(objects)
        numbered = json_array_records(spark, folder + "/a.json").orderBy("number").collect()
        assert [json.loads(r.record) for r in numbered] == objects and [r.number for r in numbered] == list(range(len(objects)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_array_files_without_a_schema(spark, folder):
    for name, data in (("a", ARRAY_OBJECTS[:3]), ("b", []), ("c", ARRAY_OBJECTS[3:5])):
        with open(f"{folder}/{name}.json", "w", encoding="utf-8") as file:
            json.dump(data, file)
    open(folder + "/d.json", "w").close()
    got = read_json_records(spark, folder, layout="array", index_by=["id"])
    assert [(r["id"], r["text"], r["index"]) for r in got.orderBy("id").collect()] == [
        (o["id"], o["text"], k) for k, o in enumerate(ARRAY_OBJECTS[:5])
    ]


def test_work_folders_can_be_cleared(spark):
    kept = materialise(spark.range(3), "three")
    own = os.path.dirname(work_path(spark, "x").removeprefix("file:"))
    assert kept.count() == 3 and own.endswith(spark.sparkContext.applicationId) and os.listdir(own)
    clear_work(spark)
    assert not os.path.exists(own)
    clear_work(spark)


class Unset:
    """A session of which only the setting is asked, which it does not have."""

    def __init__(self, spark, master):
        self.sparkContext = type("Context", (), {"applicationId": "app-1", "master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_only_a_local_master_needs_no_shared_folder(spark):
    first, second = (work_path(Unset(spark, "local[2]"), "x") for _ in range(2))
    assert os.path.dirname(first) == os.path.dirname(second) and first != second
    session._LOCAL.pop("app-1")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_path(Unset(spark, "spark://master:7077"), "x")
