"""Joins on a key of which a few values may have a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY = 256  # keys whose rows are not shuffled


def lookup(rows: DataFrame, table: DataFrame, key: str, heavy: int = HEAVY) -> DataFrame:
    """`rows` joined to `table`, which has one row for each key, with the number `n` of its rows in `rows`.

    What `table` has of the keys with the most rows, at most `heavy` of them, is
    broadcast; the rows of all others are shuffled to it. Null keys match nothing.
    """
    common = table.orderBy(F.desc("n"), key).limit(heavy).withColumn("_common", F.lit(True))
    marked = rows.join(F.broadcast(common.drop("n")), key, "left")
    rest = marked.filter("_common is null").select(*rows.columns).join(table.drop("n"), key)
    return marked.filter("_common").drop("_common").unionByName(rest)
