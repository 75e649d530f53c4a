"""Streaming sources and enrichment from a static table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chargetrail.functions import epoch_seconds


def rate_stream(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    """Columns `timestamp` and `value` (0, 1, 2, ...)."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files that appear under `path`; without a limit a batch takes all new ones."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def enrich(stream: DataFrame, static: DataFrame, sequence: str = "value", index: str = "index") -> DataFrame:
    """Left join of a stream's sequence number with a static table's row index; keeps no state.

    Spark broadcasts `static` only if its size is below the session's broadcast threshold.
    """
    return stream.join(static, stream[sequence] == static[index], "left").drop(index)


def replay(
    stream: DataFrame, log: DataFrame, sequence: str = "value", arrived: str = "timestamp", index: str = "index"
) -> DataFrame:
    """Log rows in the order of their index, written at the time the stream delivers them."""
    old = ("write_timestamp", "write_timestamp_epoch")
    return (
        enrich(stream, log.drop(*old), sequence, index)
        .drop(sequence)
        .withColumnRenamed(arrived, "write_timestamp")
        .withColumn("write_timestamp_epoch", epoch_seconds(F.col("write_timestamp")))
    )
