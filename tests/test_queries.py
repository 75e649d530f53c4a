"""Every query of the event-log library on the smallest tables, against its SQL check in DuckDB."""

import math
import os

import pytest

from __spark_entry__ import entry, queries
from chargetrail import session
from chargetrail.plans.registry import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    yield connection
    connection.close()


def comparable(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return value


def in_name_order(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(comparable(row[i]) for i in order) for row in data]
    return sorted(columns), sorted(found, key=repr)


TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    df = queries()[name](spark, SF_DIR)
    got = in_name_order(df.columns, df.collect())
    check = tables.sql(CHECKS[name])
    assert got == in_name_order(check.columns, check.fetchall())
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(check.columns, map(str, check.types)))


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["charge_point_id", "transaction_id"] and df.count() > 0


def test_medallion_text_log_takes_little_disk(spark, folder, monkeypatch):
    """The log as plain text is some fifty times as large as the tables it is derived from."""
    sf_dir = "/root/testdata/sf0.01"
    monkeypatch.setattr(session, "_own_folder", lambda spark: folder)
    assert queries()["medallion_tables"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    written = sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names)
    tables = sum(os.path.getsize(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem"))
    assert 0 < written < 15 * tables
