"""Exact median of any number of values without a large single task.

The built-in ``median`` keeps every distinct value of the column in one final
aggregation buffer. Here equal values are counted first, which also takes the
weight out of a value that is repeated very often, and the middle rank is then
narrowed down twice. Each step looks at a table whose size has a fixed bound:

1. bins of 1/1024 octave: 2,100 octaves, two signs, so 4.3 million rows at most
   (18 thousand for amounts between 5 and a million);
2. 2**21 equal slots of the bin that holds the middle rank;
3. the values in the slot that holds it: a bin has fewer than 2**43 doubles, so
   a slot has a few million at most (one or two for amounts in cents).

The bin and the slot that hold the middle are single rows, so joining them back
is a broadcast of one row, on equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BINS_PER_OCTAVE = 1024
SLOTS = 2**21

# Above every bin number: doubles end below octave 1,100 either way.
_OCTAVES = 1100


# Both keys end in a coalesce so that they are known not to be NULL. A join would
# otherwise add a test for that, which travels down and makes the two uses of
# one shuffle look different, so that it would run twice.


def _bin_of(value: Column, per_octave: int) -> Column:
    """A bin number that never decreases when ``value`` grows; NaN is next to last.

    NULL comes last. It is counted as no copies, so it is never the middle; a
    filter in its place would make the input differ from its other uses.
    """
    edge = _OCTAVES * per_octave
    size = F.floor(F.log2(F.abs(value)) * per_octave).cast("int") + edge
    number = (
        F.when(value.isNull(), 5 * edge)
        .when(F.isnan(value), 4 * edge)
        .when(value == float("inf"), 3 * edge)
        .when(value == float("-inf"), -3 * edge)
        .when(value > 0, size)
        .when(value < 0, -size)
    )
    return F.coalesce(number, F.lit(0))


def _slot_of(value: Column, slots: int) -> Column:
    """Equal slots between the smallest and largest value of the picked bin."""
    share = (value - F.col("low")) / (F.col("high") - F.col("low"))
    return F.coalesce(F.when(F.col("high") > F.col("low"), F.floor(share * slots)), F.lit(0))


def _pick(groups: DataFrame, key: str) -> DataFrame:
    """The one group, in the order of ``key``, that holds rank ``target``.

    ``target`` becomes the rank inside the group and ``after`` the smallest
    value beyond it. The window has no partitions: see the bounds above.
    """
    order = W.orderBy(key)
    before, copies, target = F.col("before"), F.col("copies"), F.col("target")
    ranked = groups.withColumns(
        {
            "before": F.sum("copies").over(order) - copies,
            "after": F.coalesce(F.lead("low").over(order), F.col("after")),
        }
    )
    holds_target = (before <= target) & (target < before + copies)
    return ranked.filter(holds_target).withColumn("target", target - before)


def exact_median(
    df: DataFrame,
    column: str,
    bins_per_octave: int = BINS_PER_OCTAVE,
    slots: int = SLOTS,
) -> DataFrame:
    """One row with ``median``, interpolated; NULL when there are no values."""
    value = F.col("value")
    sizes = [
        F.sum("copies").alias("copies"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ]
    carried = ("target", "after", "even")

    counted = (
        df.groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(column).alias("copies"))
        .select("value", "copies", _bin_of(value, bins_per_octave).alias("bin"))
    )
    total = F.sum("copies").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    bins = counted.groupBy("bin").agg(*sizes)
    bins = bins.withColumns(
        {
            "target": F.floor((total - 1) / 2),
            "even": total % 2 == 0,
            "after": F.lit(None).cast("double"),
        }
    )
    middle_bin = _pick(bins, "bin").select("bin", "low", "high", "target", "after", "even")

    in_bin = counted.join(F.broadcast(middle_bin), "bin")
    in_bin = in_bin.select("value", "copies", _slot_of(value, slots).alias("slot"), *carried)
    in_slots = in_bin.groupBy("slot").agg(*sizes, *(F.max(name).alias(name) for name in carried))
    middle_slot = _pick(in_slots, "slot").select("slot", "target", "after", "even")

    in_slot = in_bin.select("value", "copies", "slot", value.alias("low"))
    middle = _pick(in_slot.join(F.broadcast(middle_slot), "slot"), "value")

    # The upper middle is the next value when the lower one has no copy left.
    is_last_copy = F.col("target") + 1 == F.col("copies")
    mean = value * 0.5 + F.col("after") * 0.5
    result = F.when(F.col("even") & is_last_copy, mean).otherwise(value)
    return middle.agg(F.max(result).alias("median"))
