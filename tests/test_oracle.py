"""Every registered query against its oracle in DuckDB, as a multiset of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry_module

TABLES = Path("/root/testdata/sf0.01")
QUERIES = entry_module.order_queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    if not TABLES.is_dir():
        pytest.skip("no test tables")
    import duckdb

    with duckdb.connect() as connection:
        for file in TABLES.glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(entry_module.queries())


TYPES = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, tables, name):
    """The same names, types and rows."""
    frame = QUERIES[name](spark, str(TABLES))
    columns = sorted(frame.columns)
    relation = tables.sql(ORACLE[name])
    wanted_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == wanted_types
    wanted = relation.select(*(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(row) for row in frame.select(*columns).collect()]
    assert got
    assert Counter(got) == Counter(wanted)


def test_entry(spark):
    if not TABLES.is_dir():
        pytest.skip("no test tables")
    assert entry_module.entry(spark).columns == ["kpi_name", "kpi_value", "kpi_key"]
