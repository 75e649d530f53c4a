from datetime import datetime

from pyspark.sql import functions as F

from chargetrail.functions import (
    date_part_columns,
    energy_delta,
    epoch_seconds,
    hours_between,
    parse_timestamp,
    positive_flag,
    rounded_double,
    table_name,
)
from conftest import rows


def test_parse_timestamp(spark):
    texts = ["2024-03-17T05:41:10+00:00", "2023-07-19T21:04:55.250125+00:00", "2024-03-17T05:41:10+05:30", "xx", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_micros(parse_timestamp("t"))).collect()]
    assert got == [1710654070000000, 1689800695250125, 1710634270000000, None, None]


def test_epoch_rounds_down(spark):
    df = spark.sql("SELECT timestamp'1969-12-31 23:59:59.5' t, timestamp_ntz'2001-09-09 01:46:40.9' n")
    assert df.select(epoch_seconds("t"), epoch_seconds("n")).first() == (-1, 1000000000)


def test_hours_and_energy(spark):
    df = spark.sql("SELECT timestamp'2024-06-09 14:05:00' a, timestamp'2024-06-09 16:12:30' b, 1250 m, 9876 n")
    got = df.select(
        hours_between("a", "b"), hours_between("b", "a"), energy_delta("m", "n"), energy_delta("m", "n", "wh")
    ).first()
    assert got == (2.13, -2.13, 8.63, 8626.0)


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([("2.675",), ("0.125",), ("-0.125",), ("abc",), (None,)], "v string")
    assert [r[0] for r in df.select(rounded_double("v")).collect()] == [2.68, 0.13, -0.13, None, None]


def test_flag_and_label(spark):
    df = spark.createDataFrame([(1.0, 2), (0.0, 3), (None, 9)], "v double, message_type int")
    got = df.select(positive_flag("v"), table_name(F.lit("A"), "message_type")).collect()
    assert [tuple(r) for r in got] == [(1, "ARequest"), (0, "AResponse"), (0, None)]


def test_date_parts(spark):
    df = spark.createDataFrame([(datetime(2023, 4, 5, 6, 7, 8),)], "ts timestamp")
    assert rows(df.select(*[c for c in date_part_columns("ts").values()])) == [(2023, 4, 5, 6, 7)]
    assert list(date_part_columns("ts", ["year", "day"])) == ["year", "day"]
