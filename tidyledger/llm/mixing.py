"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a pseudo-random order, once per pass. A copy
of a document finishes at the virtual time `words of its source up to its end /
weight of the source`. The finish times of all sources are sorted by range over
the cluster, the words served up to each are a running total over that order,
and the list is truncated where the total reaches the budget. At that virtual
time every source has been served in proportion to its weight, and a source that
ran dry earlier has left its share to the others. The copy that a source is
serving at the cut is taken up to the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyledger.llm.common import WORD, Aside, checkpointed, quoted, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # words of the mix for each word of the corpus
PASSES = 2  # times that a document may be used

_NEW = ("size", "source_size", "weight", "target", "before", "taken_by_pass", "taken")


def _queues(df: DataFrame) -> DataFrame:
    """The rows with their queue (never null) and part of it, by a hash of id and text.

    So rows without an id, or with one id and many texts, are dealt out too.
    """
    source = F.col("_source").cast("string")
    order = F.md5(F.concat_ws("/", F.col("_id").cast("string"), "_tie"))
    return df.withColumns(
        {
            "_queue": F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)),
            "_order": order,
            "_part": F.substring(order, 1, 3),
        }
    )


def _sources(parts: DataFrame, weights: Sequence[int]) -> DataFrame:
    """One row per source: its words and weight. By code point, null last."""
    # "n" sorts before "s...", so the null source is put last by a flag.
    by_name = Window.orderBy(F.col("_queue") == "n", "_queue")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights)
    return (
        parts.groupBy("_queue")
        .agg(F.sum("_part_size").alias("source_size"))
        .withColumn("weight", F.element_at(turn, place + 1))
    )


def _queued(queues: DataFrame, parts: DataFrame, sources: DataFrame) -> DataFrame:
    """`before`: words of the source queued before the row within one pass.

    Summed over the 4096 parts of a source first and then within each part, so
    that no task holds a whole source.
    """
    earlier = Window.partitionBy("_queue").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn(
        "_offset", F.coalesce(F.sum("_part_size").over(earlier), F.lit(0))
    ).join(sources, "_queue")
    within = (
        Window.partitionBy("_queue", "_part")
        .orderBy("_order", "_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("size").over(within), F.lit(0))
    return (
        queues.withColumn("_ahead", ahead)
        .join(offsets.drop("_part_size"), ["_queue", "_part"])
        .withColumn("before", F.col("_offset") + F.col("_ahead"))
    )


def find_cut(queued: DataFrame, sources: DataFrame, share: float, passes: int) -> float:
    """The virtual time at which `share` of all words has been served.

    Finish times are sorted by range; each partition gives one row of totals, and
    only the partition in which the budget is reached is summed row by row. One
    row of each and the totals come to the driver. Without words the time is 0.
    """
    start = F.col("pass") * F.col("source_size") + F.col("before")
    finish = (start + F.col("size")) / F.col("weight")
    # Of texts without words, which may be many at one time, nothing is ever served.
    copies = queued.filter("size > 0").select(
        "size", "source_size", "weight", "before", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass")
    ).select(finish.alias("finish"), F.lit(0).cast("long").alias("ended"), F.lit(0).cast("long").alias("idle"))
    # A source that runs dry: from then on its words stay and its weight is gone.
    ended = passes * F.col("source_size")
    dry = sources.select(
        (ended / F.col("weight")).alias("finish"),
        ended.cast("long").alias("ended"),
        F.col("weight").cast("long").alias("idle"),
    )
    words, weights = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)).cast("long")
    ).first()
    budget = F.lit(float(words) * float(share))

    line = checkpointed(copies.unionByName(dry).repartitionByRange("finish").sortWithinPartitions("finish"))
    line = line.withColumn("place", F.spark_partition_id())
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        line.groupBy("place")
        .agg(F.max("finish").alias("finish"), F.sum("ended").alias("ended"), F.sum("idle").alias("idle"))
        .withColumn("ended_before", F.coalesce(F.sum("ended").over(upto), F.lit(0)))
        .withColumn("idle_before", F.coalesce(F.sum("idle").over(upto), F.lit(0)))
        .withColumn("all_ended", F.col("ended_before") + F.col("ended"))
        .withColumn("active", F.lit(weights) - F.col("idle_before") - F.col("idle"))
    )
    reached = F.col("all_ended") + F.col("active") * F.col("finish") >= budget
    at = places.filter(reached).orderBy("place").limit(1)
    found = at.select("place", "ended_before", "idle_before").first()
    if found is None:  # more is asked for than there is: everything is taken
        return float(line.agg(F.max("finish")).first()[0] or 0.0)
    rows = line.filter(F.col("place") == found["place"])
    so_far = Window.orderBy("finish", "idle").rowsBetween(Window.unboundedPreceding, -1)
    active = F.lit(weights - found["idle_before"]) - F.coalesce(F.sum("idle").over(so_far), F.lit(0))
    served = F.lit(found["ended_before"]) + F.coalesce(F.sum("ended").over(so_far), F.lit(0))
    first = (
        rows.select("finish", active.alias("active"), served.alias("words"))
        .filter(F.col("words") + F.col("active") * F.col("finish") >= budget)
        .orderBy("finish")
        .limit(1)
        .select(F.try_divide(budget - F.col("words"), F.col("active")).alias("time"), "finish")
        .first()
    )
    return float(first["finish"] if first["time"] is None else first["time"])


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    digest_column: str | None = None,
) -> DataFrame:
    """`df` with what the mix takes of each row; no row is dropped.

    New columns (columns of these names, in any case, are replaced): `size` (words;
    null text has 0), `source_size`, `weight`, `target` (words the mix wants of the
    source, at most `passes` times its size), `before`, `taken_by_pass` (words from
    the start of the text, for each pass) and `taken` (their sum). Sources take the
    weights in turn by code point, null last. Documents queue by the MD5 of id and
    MD5 of the text, those that agree in both by size. A table without
    `text_column` gives the words as `size` and may give the MD5 of the texts as
    `digest_column` (which is not returned). An empty table gives an empty one.
    """
    has_text = text_column.lower() in [c.lower() for c in df.columns]
    if has_text:
        text = F.col(quoted(text_column))
        size, tie = word_count(text), F.md5(F.coalesce(text, F.lit("")))
    else:
        size, tie = F.col("size"), F.lit("") if digest_column is None else F.col(quoted(digest_column))
    aside = Aside(df, (*_NEW, *([] if digest_column is None else [digest_column])))
    wide = df.select(
        *aside.columns(),
        F.col(quoted(id_column)).alias("_id"),
        F.col(quoted(source_column)).alias("_source"),
        size.alias("size"),
        tie.alias("_tie"),
    )
    slim = checkpointed(wide.select("_id", "_source", "size", "_tie"))
    queues = _queues(slim)
    parts = checkpointed(queues.groupBy("_queue", "_part").agg(F.sum("size").alias("_part_size")))
    sources = checkpointed(_sources(parts, weights))
    slim_queued = _queued(queues, parts, sources)
    time = find_cut(slim_queued, sources, share, passes)
    of_slim = {id_column: "_id", source_column: "_source"}
    if set(aside.names.values()) <= set(of_slim):
        queued = slim_queued.withColumns({name: F.col(of_slim[c]) for name, c in aside.names.items()})
    else:
        queued = _queued(_queues(wide), parts, sources)
    served = F.col("weight") * F.lit(time)
    by_pass = [
        F.greatest(
            F.lit(0).cast("long"),
            F.least(F.col("size"), F.floor(served - (p * F.col("source_size") + F.col("before"))).cast("long")),
        )
        for p in range(passes)
    ]
    return queued.select(
        *aside.back(),
        "size",
        "source_size",
        F.col("weight").cast("int").alias("weight"),
        F.least(F.lit(float(passes)) * F.col("source_size"), served).alias("target"),
        "before",
        F.array(*by_pass).alias("taken_by_pass"),
        sum(by_pass[1:], by_pass[0]).alias("taken"),
    )


def mixed_rows(mixed: DataFrame, columns: Sequence[str], text_column: str = "text") -> DataFrame:
    """The mix itself: a row per copy, with the columns named.

    A copy that is taken in part has the text up to its last taken word; copies
    of which nothing is taken are left out.
    """
    copy = mixed.select("*", F.explode("taken_by_pass").alias("_words")).filter(F.col("_words") > 0)
    # The text up to word n: skip to the place where n words have been passed.
    words = F.regexp_extract_all(F.col(text_column), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    part = F.when(F.col("_words") < F.col("size"), F.array_join(F.slice(words, F.lit(1), F.col("_words").cast("int")), ""))
    return copy.withColumn(text_column, F.coalesce(part, F.col(text_column))).select(*columns)
