"""Fences that keep filters from moving below the columns they test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The same rows and columns, with ``names`` computed below any later filter.

    Catalyst pushes a filter, also the NULL test that a join implies, beneath
    the projection that computes its columns. Costly expressions then run twice
    for each row, in code too large for the JVM to compile, and two uses of one
    shuffle stop looking the same, so the shuffle runs twice as well. A filter
    on generated columns stays above their generator, which is part of the same
    compiled stage. Columns not in ``names`` pass by the fence, so they are
    still pruned when nobody reads them. Those in ``names`` are not: the fence
    stays, and all who read one fenced table read the same columns of it, which
    lets them share its shuffle. Where nobody may read them, use :func:`barrier`.
    """
    others = [name for name in df.columns if name not in names]
    fenced = df.select(*others, F.inline(F.array(F.struct(*names))))
    return fenced.select(*df.columns)


def barrier(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The same rows and columns; a later filter on ``names`` stays above them.

    Unlike behind :func:`compute_once`, a column that nobody reads is pruned with
    all that leads to it. The number of the task is never negative, so the values
    are what they were; but Catalyst takes it for an expression that may change
    and neither moves a filter below it nor merges it into the uses above it.
    """
    passed = [
        F.when(F.spark_partition_id() >= 0, F.col(name)).alias(name) if name in names else F.col(name)
        for name in df.columns
    ]
    return df.select(*passed)
