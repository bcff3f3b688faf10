"""Queries that SQL can express, against it."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

from tidyledger.llm.queries import ORACLE, queries

TABLES = Path("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", ORACLE)
def test_matches_oracle(spark, duck, name):
    if not TABLES.is_dir():
        pytest.skip("no test tables")
    for file in TABLES.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    frame = queries()[name](spark, str(TABLES))
    columns = sorted(frame.columns)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    wanted = Counter(relation.select(*columns).fetchall())
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == wanted
