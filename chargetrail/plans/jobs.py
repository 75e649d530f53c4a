"""The domain jobs: last connection, charge data records, bronze/silver/gold, per-minute silver."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chargetrail.functions import parse_timestamp
from chargetrail.operators.joins import (
    attach_starts,
    salted_left_join,
    started_transactions,
    with_totals,
)
from chargetrail.operators.messages import (
    flatten_struct,
    import_power,
    power_samples,
    silver,
)
from chargetrail.operators.ordered import drop_repeated_messages, latest_per_key
from chargetrail.operators.parking import parking_time
from chargetrail.operators.stats import distribution, histogram
from chargetrail.operators.timeslice import DAY, MINUTE, with_date_parts
from chargetrail.schemas import (
    CDR_COLUMNS,
    CDR_WIDE_COLUMNS,
    EVENT_LOG,
    METER_POWER,
    METER_VALUES,
    SILVER_CLASSES,
    START_REQUEST,
    START_RESPONSE,
    STOP_REQUEST,
    MessageClass,
)
from chargetrail.session import materialise
from chargetrail.sinks import create_database, create_external_table, write_parquet, write_partitioned, write_slice
from chargetrail.sinks.files import SLICE
from chargetrail.sources import read_csv_log, read_last_minute, read_parquet

#: Bytes of a row group of the bronze table.
BRONZE_GROUP = 8 << 20
#: Writer options of bronze, silver and gold: message texts take about half of what they take by default.
LAKE = {"compression": "zstd"}

SILVER = {message.table: message for message in SILVER_CLASSES}


def last_connections(log: DataFrame) -> DataFrame:
    """The most recent message of every charge point, with the time it was written."""
    return (
        log.withColumn("converted_timestamp", parse_timestamp("write_timestamp"))
        .transform(latest_per_key, ts="converted_timestamp")
        .drop("write_timestamp")
        .withColumnRenamed("converted_timestamp", "write_timestamp")
    )


def gold_cdr(
    started: DataFrame,
    stop_requests: DataFrame,
    power: DataFrame,
    unit: str = "kwh",
    keep_left_key: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """One wide charge data record per stopped transaction.

    Pass tables, not plans: keys are counted before they are joined. The parking time is attached
    to the started transactions before the stops are, so the counted left sides are both tables.
    """
    parking = parking_time(power, ranges=ranges)
    started = materialise(salted_left_join(started, parking, "transaction_id", True), "started_parking")
    return (
        stop_requests.transform(attach_starts, started, keep_left_key)
        .transform(with_totals, unit)
        .select(*CDR_WIDE_COLUMNS)
    )


def transaction_ends(
    log: DataFrame, response: MessageClass, request: MessageClass, stop: MessageClass
) -> tuple[DataFrame, DataFrame]:
    """Started transactions, and stops, of a log; only the fields that they have are parsed."""
    started = started_transactions(
        silver(log, response, ("transaction_id",)), silver(log, request, ("meter_start", "timestamp"))
    )
    wanted = ("transaction_id", "meter_stop", "timestamp")
    return started, silver(log, stop, wanted).select(*wanted)


def cdr_from_log(
    log: DataFrame,
    unit: str = "wh",
    wide_ids: bool = False,
    keep_left_key: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Charge data records straight from an event log in a columnar table.

    Each message class is scanned and the needed fields of its JSON parsed once; the few columns that are needed are
    written to the shared folder, because joins on a parsed value would parse it again to test and
    count it. A CSV log would be read once per class: use the bronze table of `write_bronze` then.
    """

    def of(message: MessageClass) -> MessageClass:
        return message.wide_ids() if wide_ids else message

    # Most of the work first: what tasks have run before for other bodies slows the parsing down.
    power = materialise(power_samples(log, of(METER_POWER)), "power")
    started, stops = transaction_ends(log, of(START_RESPONSE), of(START_REQUEST), of(STOP_REQUEST))
    return gold_cdr(
        materialise(started, "started"), materialise(stops, "stops"), power, unit, keep_left_key, ranges
    ).select(*CDR_COLUMNS)


def write_bronze(log: DataFrame, path: str) -> None:
    """Bronze: the raw log as Parquet, one folder per message class, parsed from its source once.

    There are a handful of classes, so a task writes a file for each that it meets. The log is not shuffled for that: its
    texts would lie on the executors' disks once more, for as long as the session keeps the shuffle. Bodies are costly to
    parse for their size. Small row groups let several tasks share a file.
    """
    options = {"parquet.block.size": BRONZE_GROUP, **LAKE}
    write_partitioned(log, path, ["action", "message_type"], mode="overwrite", rebalance=False, options=options)


def write_silver(bronze: DataFrame, base: str, classes: list[MessageClass] | None = None) -> None:
    """Silver: one flattened table per message class; each reads only its bronze folder."""
    for message in classes or SILVER_CLASSES:
        write_parquet(silver(bronze, message), f"{base}/{message.table}", LAKE)


def write_gold(spark: SparkSession, silver_base: str, path: str, **options) -> None:
    """Gold: charge data records from the silver tables."""
    tables = {name: read_parquet(spark, f"{silver_base}/{name}") for name in SILVER}
    started = started_transactions(tables[START_RESPONSE.table], tables[START_REQUEST.table])
    power = import_power(tables[METER_VALUES.table])
    cdr = gold_cdr(materialise(started, "started"), tables[STOP_REQUEST.table], power, **options)
    write_parquet(cdr, path, LAKE)


def medallion(
    spark: SparkSession, csv_path: str, base: str, classes: list[MessageClass] | None = None, **options
) -> DataFrame:
    """CSV log -> bronze -> silver -> gold below `base`; returns the gold table."""
    write_bronze(read_csv_log(spark, csv_path), f"{base}/bronze")
    # The folders hold the partition columns as text; the schema keeps message_type an integer.
    bronze = read_parquet(spark, f"{base}/bronze", EVENT_LOG)
    write_silver(bronze, f"{base}/silver", classes)
    write_gold(spark, f"{base}/silver", f"{base}/gold", **options)
    return read_parquet(spark, f"{base}/gold")


def silver_minute(
    spark: SparkSession,
    bronze_path: str,
    base: str,
    now: datetime,
    database: str | None = None,
    classes: list[MessageClass] | None = None,
    database_location: str | None = None,
    by_charge_point: bool = False,
) -> dict[str, str]:
    """Silver tables for the minute before `now`; returns the written folder of each table.

    Messages that were delivered twice are kept once; those without a message id all stay. Partitions carry the minute
    and are replaced as a whole, so a repeated run changes nothing. With `by_charge_point` the folders are
    charge_point_id/year/month/day, and below each of them a slice per minute, which is replaced as one; a charge point's
    days are then read without those of others. With `database`, the tables and the minute's partitions are also registered
    there.
    """
    minute = read_last_minute(spark, bronze_path, now).transform(
        drop_repeated_messages,
        ("charge_point_id", "message_id", "message_type", "action"),
        known=("message_id",),
    )
    # Read and shuffled once for all tables.
    minute = materialise(minute, "minute")
    written = now - timedelta(minutes=1)
    partition = {part: getattr(written, part) for part in MINUTE}
    tables = {"EventLog": minute}
    for message in classes or SILVER_CLASSES:
        tables[message.table] = with_date_parts(silver(minute, message))
    paths = {table: f"{base}/{table}" for table in tables}
    layout: tuple[str, ...] = ("charge_point_id", *DAY) if by_charge_point else MINUTE
    added = {}
    for table, rows in tables.items():
        if by_charge_point:
            stamp = written.strftime("%Y%m%d%H%M")
            folders = write_slice(rows, paths[table], stamp, layout)
            added[table] = folders.withColumn(SLICE, F.lit(stamp)) if database else None
        else:
            write_partitioned(rows, paths[table], layout, "replace", ["charge_point_id"])
    if database:
        name = create_database(spark, database, database_location, use=False)
        for table, rows in tables.items():
            schema, parts, specs = rows.schema, layout, [partition]
            if by_charge_point:
                # No more than the minute has charge points.
                schema, parts = StructType([*schema, StructField(SLICE, StringType())]), (*layout, SLICE)
                specs = [row.asDict() for row in added[table].collect()]
            create_external_table(spark, name, table, paths[table], schema=schema, partition_by=parts, added=specs)
    return paths


def cdr_report(cdr: DataFrame, column: str = "total_energy", width: float = 1.0, by: list[str] | None = None):
    """Box-plot figures and histogram of a CDR column, as two small tables."""
    return distribution(cdr, column, by), histogram(cdr, column, width, by)
