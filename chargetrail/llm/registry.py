"""Registered queries of the subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chargetrail.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

#: Rows that a Python task holds at once; small, as texts may be very long.
ROWS_PER_BATCH = 500


def prepared(spark: SparkSession) -> SparkSession:
    """The session with UTC times, small Arrow batches and this package on its Python workers' path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return use_utc(spark)


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL check where SQL can express it."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepared(spark), sf_dir)

        QUERIES[function.__name__] = run
        if check is not None:
            CHECKS[function.__name__] = check
        return run

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
