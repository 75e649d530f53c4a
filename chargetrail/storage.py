"""Small file operations through Spark's own file systems, so that they reach whatever store the tables are in."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in `path`, sorted; none if it is missing."""
    system, target = _at(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this package's own making; a missing one is no fault."""
    system, target = _at(spark, path)
    system.delete(target, True)


def publish(spark: SparkSession, path: str) -> None:
    """Make an empty marker file appear as a whole, by renaming it into place."""
    system, target = _at(spark, path)
    system.mkdirs(target.getParent())
    _, draft = _at(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    system.create(draft).close()
    if not system.rename(draft, target) and not system.exists(target):
        raise OSError(f"could not publish {path}")
