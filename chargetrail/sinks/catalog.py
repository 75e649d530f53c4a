"""Databases and external tables in the Spark catalog."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def sanitised_name(text: str) -> str:
    """Only letters and digits remain."""
    return re.sub("[^A-Za-z0-9]+", "", text)


def create_database(spark: SparkSession, name: str, location: str | None = None, use: bool = True) -> str:
    """Create the database if it is missing and make it the current one; returns its name."""
    name = sanitised_name(name)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    if use:
        spark.sql(f"USE `{name}`")
    return name


def _literal(value: int | str | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_external_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    fmt: str = "PARQUET",
    schema: StructType | None = None,
    partition_by: tuple[str, ...] | list[str] = (),
    added: list[dict[str, int | str]] | None = None,
) -> str:
    """Register files at `location`; returns the qualified name.

    With a schema no file is opened to find it, and the folder may still be empty. A partitioned
    folder shows no rows until its partitions are registered, so that is done here: those of `added`,
    or without it all that a listing of the folder finds.
    """
    name = f"`{database}`.`{table}`"
    columns = partitions = ""
    if schema is not None:
        columns = " (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ")"
        if partition_by:
            partitions = " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name}{columns} USING {fmt}{partitions} LOCATION '{location}'"
    )
    if partition_by and fmt.upper() != "DELTA":
        if added is None:
            spark.catalog.recoverPartitions(name)
        specs = [
            "PARTITION (" + ", ".join(f"`{part}` = {_literal(values[part])}" for part in partition_by) + ")"
            for values in added or []
        ]
        for at in range(0, len(specs), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(specs[at : at + 500]))
    return name
