"""Every registered query with SQL equals DuckDB on the same tables (sf0.001), exactly."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ovenplan.plans import oracle, registry

from .conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float)):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# Spark type -> DuckDB type name, for the schema part of the comparison.
SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, con, key):
    df = registry.queries()[key](spark, SF_SMALL)
    rel = con.sql(oracle.oracle_sql()[key])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


def test_every_query_has_sql_or_is_model():
    # The library's own queries; those of llm/ are tested in tests/llm.
    missing = set(registry.queries()) - set(entry.oracle_sql())
    assert all(k.startswith("model_") for k in missing), missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "product_key", "product_name", "warehouse_key", "quantity", "amount"]
