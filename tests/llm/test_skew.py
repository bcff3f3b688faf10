from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidyledger.llm.graph import components
from tidyledger.llm.skew import lookup


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_is_a_join(spark):
    """A third of the rows has one key, some keys have no match, some are null."""
    keys = [7 if i % 3 == 0 else None if i % 50 == 1 else i % 400 for i in range(3000)]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key long, value int").repartition(6)
    table = rows.filter("key is not null and key % 5 <> 0").groupBy("key").agg(
        F.max("value").alias("most"), F.count("*").alias("n")
    )
    for heavy in (1, 3, 1000):
        found = lookup(rows, table, "key", heavy)
        assert found.columns == ["key", "value", "most"]
        wanted = Counter(map(tuple, rows.join(table.drop("n"), "key").collect()))
        assert Counter(map(tuple, found.collect())) == wanted
    assert lookup(rows, table.filter("false"), "key").count() == 0
    assert lookup(rows.filter("false"), table, "key").count() == 0


def test_rows_of_the_heaviest_keys_are_not_shuffled(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("key"), "id")
    table = rows.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    found = lookup(rows, table, "key", 8)
    found.collect()
    spread = found.groupBy(F.spark_partition_id(), "key").count().filter("key = 5").collect()
    assert len(spread) >= 4  # where they were read, not in one partition
    assert "BroadcastHashJoin" in _plan(found)


def test_components_of_a_large_star(spark):
    """A hub with most of the links, a chain and pairs."""
    edges = [(0, i) for i in range(1, 3000)] + [(10_000 + i, 10_001 + i) for i in range(60)]
    edges += [(20_000 + 2 * i, 20_001 + 2 * i) for i in range(50)] + [(2999, 5000), (5001, 5000), (1, 1)]
    frame = spark.createDataFrame([(b, a) if (a + b) % 2 else (a, b) for a, b in edges], "a long, b long").repartition(5)
    found = {r.node: r.root for r in components(frame).collect()}
    wanted = {n: 0 for n in [*range(3000), 5000, 5001]}
    wanted |= {n: 10_000 for n in range(10_000, 10_061)} | {n: n - n % 2 for n in range(20_000, 20_100)}
    assert found == wanted
