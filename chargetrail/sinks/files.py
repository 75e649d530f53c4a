"""Batch sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargetrail.functions import table_name
from chargetrail.operators.timeslice import DAY
from chargetrail.storage import exists, remove


def write_parquet(df: DataFrame, path: str, options: dict[str, object] | None = None) -> None:
    """Overwrite a Parquet table; `options` are those of Spark's writer."""
    df.write.mode("overwrite").options(**(options or {})).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] | list[str] = ("charge_point_id", *DAY),
    mode: str = "append",
    sort_within: tuple[str, ...] | list[str] = (),
    fmt: str = "parquet",
    rebalance: bool = True,
    options: dict[str, object] | None = None,
) -> None:
    """Write a folder per partition value.

    Rows are rebalanced on the partition columns first: a small partition becomes one file, and
    adaptive execution splits a partition that holds far more rows than the others over several
    tasks. With a handful of partition values `rebalance=False` saves that shuffle: every task then
    writes one file per value it meets. `mode="replace"` replaces just the partitions present in `df`, so that a repeated run
    leaves the same table; `append` adds files. `sort_within` clusters rows inside the files so
    that scans skip row groups on these columns. `options` are those of Spark's writer.
    """
    partition_by = list(partition_by)
    placed = df.hint("rebalance", *partition_by) if rebalance else df
    if sort_within:
        placed = placed.sortWithinPartitions(*partition_by, *sort_within)
    writer = placed.write.format(fmt).partitionBy(*partition_by).options(**(options or {}))
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.save(path)


SLICE = "slice"


def write_slice(
    df: DataFrame,
    path: str,
    name: str,
    partition_by: tuple[str, ...] | list[str] = ("charge_point_id", *DAY),
    fmt: str = "parquet",
) -> DataFrame:
    """Write one slice, such as a minute's rows, into a table whose folders are shared by many slices; returns the
    folders it has, a row of partition values each.

    Below each folder the slice has one of its own, `slice=<name>`. Writing the slice again replaces all it had before, also
    in folders where it has no rows any more, and leaves the other slices alone. Which folders a slice has is listed below
    `path/_slices`: the old and new ones while it is written, then the new ones.
    """
    spark, columns = df.sparkSession, list(partition_by)
    listed = f"{path}/_slices/{name}"
    folders = df.select(columns).distinct()
    had = [spark.read.schema(folders.schema).parquet(at) for at in (listed, f"{listed}.both") if exists(spark, f"{at}/_SUCCESS")]
    left = None
    if had:
        old = reduce(DataFrame.unionByName, had).distinct().alias("old")
        same = reduce(Column.__and__, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns])
        left = old.join(folders.alias("new"), same, "left_anti").collect()  # only folders that the slice leaves
        if left:
            both = folders.unionByName(spark.createDataFrame(left, folders.schema))
            both.write.mode("overwrite").parquet(f"{listed}.both")
    write_partitioned(df.withColumn(SLICE, F.lit(name)), path, [*columns, SLICE], "replace", fmt=fmt)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for row in left or []:
        parts = [escape(column, None if row[column] is None else str(row[column])) for column in columns]
        remove(spark, "/".join([path, *parts, f"{SLICE}={name}"]))
    folders.write.mode("overwrite").parquet(listed)
    remove(spark, f"{listed}.both")
    return spark.read.schema(folders.schema).parquet(listed)


def write_routed(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] | list[str] = (),
    mode: str = "append",
    fmt: str = "parquet",
) -> None:
    """Send each message to the folder `table=<action><Request|Response>`, all in one pass.

    Rows are rebalanced on the table, so the number of files follows the rows and not the tasks. An
    empty input writes no rows and creates no table folder.
    """
    routed = df.withColumn("table", table_name())
    write_partitioned(routed, path, ["table", *partition_by], mode, fmt=fmt)
