"""Registered queries: a Spark callable and, where it can be said in SQL, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chargetrail.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under `name` or its own name, with its SQL check."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        QUERIES[name or function.__name__] = run
        if check is not None:
            CHECKS[name or function.__name__] = check
        return run

    return register
