"""Message logs derived row by row from the given tables, for the registered queries.

No row is grouped, dropped or invented: every log grows with its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chargetrail.schemas import IMPORT_POWER, METER_VALUES, START_REQUEST, START_RESPONSE, STATUS, STOP_REQUEST
from chargetrail.sources import spread

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ssxxx"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_event_log(events: DataFrame) -> DataFrame:
    """`events` with the envelope's columns; errors count as responses, all others as requests."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.when(F.col("event_type") == "error", 3).otherwise(2).alias("message_type"),
        F.col("user_id").cast("string").alias("charge_point_id"),
        F.col("event_type").alias("action"),
        F.date_format(ts, ISO_MICROS).alias("write_timestamp"),
        F.col("props").alias("body"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_log(table(spark, sf_dir, "events"))


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as meter samples of one long session per user; power is the value above 30."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("transaction_id"),
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("value") - 30).alias("value"),
    )


def as_status_log(events: DataFrame) -> DataFrame:
    """`events` as status notifications; the event type is the status."""
    at = F.date_format(F.col("ts").cast("timestamp"), ISO_MICROS)
    body = F.to_json(
        F.struct(
            F.lit(1).alias("connector_id"),
            F.lit("NoError").alias("error_code"),
            F.col("event_type").alias("status"),
            at.alias("timestamp"),
        )
    )
    return _messages(events, STATUS, F.col("event_id"), F.col("user_id"), at, body)


def _messages(df: DataFrame, message, message_id: Column, charge_point: Column, at: Column, body: Column) -> DataFrame:
    return df.select(
        message_id.cast("string").alias("message_id"),
        F.lit(message.message_type).alias("message_type"),
        charge_point.cast("string").alias("charge_point_id"),
        F.lit(message.action).alias("action"),
        at.alias("write_timestamp"),
        body.alias("body"),
    )


def _iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO_SECONDS)


def charging_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charging sessions: each order starts and stops one, each line item sends meter values.

    The session of an order lasts as many seconds as the order costs, and uses as many Wh as it
    costs cents. Stops of open orders (about a third) carry no transaction id.
    """
    orders = spread(table(spark, sf_dir, "orders"))
    began = F.unix_timestamp("o_orderdate")
    ended = began + F.floor("o_totalprice")
    start_id = F.concat(F.lit("start-"), F.col("o_orderkey"))
    start_request = F.struct(
        F.lit(1).alias("connector_id"),
        F.col("o_orderpriority").alias("id_tag"),
        F.col("o_custkey").alias("meter_start"),
        _iso(began).alias("timestamp"),
    )
    start_response = F.struct(
        F.col("o_orderkey").alias("transaction_id"),
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("parent_id_tag")
        ).alias("id_tag_info"),
    )
    stop_request = F.struct(
        (F.col("o_custkey") + F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("meter_stop"),
        _iso(ended).alias("timestamp"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderkey")).alias("transaction_id"),
        F.col("o_orderstatus").alias("reason"),
        F.col("o_orderpriority").alias("id_tag"),
        F.array("o_orderstatus", "o_orderpriority").alias("transaction_data"),
    )
    customer = F.col("o_custkey")
    return (
        _messages(orders, START_REQUEST, start_id, customer, _iso(began), F.to_json(start_request))
        .unionByName(
            _messages(orders, START_RESPONSE, start_id, customer, _iso(began + 2), F.to_json(start_response))
        )
        .unionByName(
            _messages(
                orders,
                STOP_REQUEST,
                F.concat(F.lit("stop-"), F.col("o_orderkey")),
                customer,
                _iso(ended),
                F.to_json(stop_request),
            )
        )
        .unionByName(_meter_messages(spread(table(spark, sf_dir, "lineitem"))))
    )


def _meter_messages(lineitem: DataFrame) -> DataFrame:
    """Two readings per line item: total power and a voltage, then the power of one phase."""
    shipped = F.unix_timestamp("l_shipdate")

    def sample(value: Column, measurand: str, unit: str, phase: str | None = None) -> Column:
        return F.struct(
            value.cast("string").alias("value"),
            F.lit("Sample.Periodic").alias("context"),
            F.lit("Raw").alias("format"),
            F.lit(measurand).alias("measurand"),
            F.lit(phase).cast("string").alias("phase"),
            F.lit(unit).alias("unit"),
        )

    def reading(after: int, *samples: Column) -> Column:
        at = shipped + F.col("l_linenumber") * 97 + after
        return F.struct(_iso(at).alias("timestamp"), F.array(*samples).alias("sampled_value"))

    power = F.col("l_quantity") - 25
    body = F.struct(
        F.col("l_linenumber").alias("connector_id"),
        F.col("l_orderkey").alias("transaction_id"),
        F.array(
            reading(
                0,
                sample(power, IMPORT_POWER, "W"),
                sample(F.col("l_extendedprice"), "Voltage", "V", "L1-N"),
            ),
            reading(30, sample(F.col("l_tax"), IMPORT_POWER, "W", "L1")),
        ).alias("meter_value"),
    )
    message_id = F.concat(
        F.lit("meter-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"), F.lit("-"), F.col("l_partkey")
    )
    written = _iso(shipped + F.col("l_linenumber") * 7)
    return _messages(lineitem, METER_VALUES, message_id, F.col("l_suppkey"), written, F.to_json(body))
