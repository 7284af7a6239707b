"""Every registered query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from docquarry.plans import catalog

QUERIES, SQL = catalog.QUERIES, catalog.SQL
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def tables(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows):
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted(str([plain(v) for v in row]) for row in rows)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, tables, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name not in SQL:
        assert rows
        return
    listed = ", ".join(columns)
    found = tables.execute(f"SELECT {listed} FROM ({SQL[name]})")
    types = {c[0]: str(c[1]) for c in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert comparable(rows) == comparable(found.fetchall())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["total_samples", "top1_accuracy", "hit_rate_at_k", "mrr", "answer_coverage_at_k"]
    assert df.count() == 1
