"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from chargetrail.storage import remove


def build_session(app_name: str = "chargetrail", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone, for sessions this package did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared folder (`spark.checkpoint.dir`).

    Paths are grouped by application, so that the files of finished ones can be removed. Only a
    local master may run without that setting; there a temporary folder is chosen once per
    application.
    """
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Temporary folders of local sessions without a setting, by application.
_LOCAL: dict[str, str] = {}


def _own_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(application)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL[application] = tempfile.mkdtemp(prefix="chargetrail-")
    return f"{base.rstrip('/')}/chargetrail/{application}"


def clear_work(spark: SparkSession) -> None:
    """Remove all that this application has written below `work_path`, once its results are read or stored elsewhere.

    DataFrames that still read from there fail afterwards.
    """
    remove(spark, _own_folder(spark))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and return a scan of it.

    Cuts the lineage so that later plans read one fixed copy, whatever executors are lost.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
