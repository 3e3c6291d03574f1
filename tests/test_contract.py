"""Driver contract: entry() runs, and every query of the catalogue equals its DuckDB oracle on the sf0.001 tables.

The text operators' queries, which the entry module adds where they can be imported, are compared in ``tests/llm``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tillgrid.plans import catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01")))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_dir, t + '.parquet')}')")
    return con


def test_entry_runs_with_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


# Spark type names and the DuckDB type each must come out as.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = contract.queries()[name](spark, sf_dir)
    got = _canon(df.columns, df.collect())
    rel = duck.sql(contract.oracle_sql()[name])
    cols = rel.columns
    assert sorted(df.columns) == sorted(cols)
    duck_types = dict(zip(cols, (str(t) for t in rel.types)))
    for f in df.schema.fields:
        spark_type = f.dataType.simpleString()
        assert _TYPES.get(spark_type, spark_type.upper()) == duck_types[f.name], (f.name, spark_type)
    assert got == _canon(cols, rel.fetchall())
