"""Batch scans."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from chargetrail.operators.timeslice import time_slice
from chargetrail.schemas import EVENT_LOG
from chargetrail.sources.index import with_row_index
from chargetrail.sources.json_arrays import json_array_records, parsed_records


def read_csv_log(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = EVENT_LOG,
    delimiter: str = ",",
    escape: str = "\\",
    header: bool = True,
) -> DataFrame:
    """Event-log CSV. `schema=None` infers the types, which costs a second pass over the files.

    Use `escape='"'` for files that double their quotes. A `.gz` file is one split: see `spread`.
    """
    reader = (
        spark.read.option("header", header).option("delimiter", delimiter).option("escape", escape)
    )
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan out to all cores if it has fewer splits than there are cores.

    Meant before costly parsing of few unsplittable files (`.gz`, small Parquet). A scan with many
    splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    layout: str = "lines",
    index_by: list[str] | None = None,
    index_name: str = "index",
) -> DataFrame:
    """JSON records, one per line (`lines`) or one array of objects per file (`array`).

    A large array file is cut and parsed by several tasks (`json_array_records`). `index_by` adds a dense 0..n row index in the order of these columns; an empty list keeps the
    order of the files.
    """
    if layout == "array":
        df = parsed_records(json_array_records(spark, path), schema)
    else:
        df = (spark.read if schema is None else spark.read.schema(schema)).json(path)
    return df if index_by is None else with_row_index(df, index_by, index_name)


def has_delta(spark: SparkSession) -> bool:
    """Whether the session was set up for Delta tables."""
    return "io.delta" in spark.conf.get("spark.sql.extensions", "")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Partitioned lake table; filters on its partition columns prune folders.

    Without a schema Spark guesses the types of partition columns, which turns a key such as "0012" into a number: give
    the schema, with partition columns, where keys are text. An empty text is written as NULL and read as NULL.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def read_time_slice(
    spark: SparkSession, path: str, when: datetime, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Rows of one minute of a table with year..minute columns."""
    return read_table(spark, path, fmt, schema).transform(time_slice, when)


def read_last_minute(
    spark: SparkSession, path: str, now: datetime, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Rows of the minute before `now` (UTC)."""
    return read_time_slice(spark, path, now - timedelta(minutes=1), fmt, schema)
