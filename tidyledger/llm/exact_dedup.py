"""Exact deduplication with the frequent digests split off before the shuffle.

A Misra-Gries summary (Spark's frequent-items sketch) proposes the digests that
may be frequent; one exact aggregation verifies them and finds the row of each
that stays. These winners, at most `heavy` rows, are broadcast, and every other
row of a frequent digest leaves on the map side. What remains is shuffled by
digest; no group of it can be large, since the large ones are gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyledger.llm.common import Aside, checkpointed, quoted, text_of

HEAVY = 256  # winners that are broadcast
TRACKED = 4096  # counters of the summary; a digest above about 1/3000 of the rows is found


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the UTF-8 text in lower-case hex; null is empty text."""
    return F.sha2(text_of(text), 256)


def heavy_winners(
    df: DataFrame, id_column: str, digest_column: str, heavy: int = HEAVY, tracked: int = TRACKED
) -> DataFrame:
    """Verified frequent digests: `_digest`, `_keep_id`, `_size`; at most `heavy` rows."""
    found = df.select(
        F.expr(f"approx_top_k(`{digest_column}`, {int(heavy)}, {int(tracked)})").alias("found")
    )
    proposed = found.select(F.explode("found.item").alias("_digest"))
    return (
        df.select(F.col(digest_column).alias("_digest"), F.col(id_column).alias("_id"))
        .join(F.broadcast(proposed), "_digest", "left_semi")
        .groupBy("_digest")
        .agg(F.max("_id").alias("_keep_id"), F.count("*").alias("_size"))
        .filter(F.col("_size") > 1)
    )


def mark_copies(
    df: DataFrame,
    winners: DataFrame,
    id_column: str = "doc_id",
    digest_column: str = "text_sha256",
) -> DataFrame:
    """`df` with `keep_id`, `group_size` and `kept`; columns of those names are replaced.

    Of equal digests the row with the largest id is kept; ids that are null come
    last. Of rows that repeat the same id and digest one is kept. A table without
    rows gives no rows.

    `winners` is `heavy_winners` of the same rows. Which digests it holds has no
    influence on the result.
    """
    kept_columns = [c for c in df.columns if c not in ("keep_id", "group_size", "kept")]
    df = df.select(*kept_columns)
    own, digest = F.col(id_column), F.col(digest_column)
    marked = df.join(
        F.broadcast(winners.withColumn("_heavy", F.lit(True))), digest == F.col("_digest"), "left"
    )
    is_heavy = F.col("_heavy").isNotNull()
    is_winner = own.eqNullSafe(F.col("_keep_id"))
    best_first = Window.partitionBy(digest).orderBy(own.desc_nulls_last())
    group = Window.partitionBy(digest)

    gone = marked.filter(is_heavy & ~is_winner).select(
        *kept_columns,
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.lit(False).alias("kept"),
    )
    # Rows that repeat a winner's id are thinned to one of each task first: there
    # may be many of them.
    by_task = Window.partitionBy(digest, "_task").orderBy(F.lit(0))
    repeats = (
        marked.filter(is_heavy & is_winner)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_first", F.row_number().over(by_task) == 1)
    )
    others_apart = F.when(F.col("_first"), F.lit(-1)).otherwise(F.col("_task"))
    chosen = Window.partitionBy(digest, others_apart).orderBy("_task")
    stays = repeats.select(
        *kept_columns,
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_first") & (F.row_number().over(chosen) == 1)).alias("kept"),
    )
    rest = marked.filter(~is_heavy).select(
        *kept_columns,
        F.max(own).over(group).alias("keep_id"),
        F.count("*").over(group).alias("group_size"),
        (F.row_number().over(best_first) == 1).alias("kept"),
    )
    return rest.unionByName(stays).unionByName(gone)


def exact_dedup(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    heavy: int = HEAVY,
    tracked: int = TRACKED,
) -> DataFrame:
    """Every row of `df` with `text_sha256`, `keep_id`, `group_size` and `kept`.

    Texts are equal when they are identical; null counts as empty. The passes for
    the frequent digests read a stored table of ids and digests, not the texts. A
    column of `df` named like one of the four new ones, in any case, is replaced.
    """
    new = ("text_sha256", "keep_id", "group_size", "kept")
    aside = Aside(df, new)
    id_of = F.col(quoted(id_column)).alias("_id")
    named = df.select(*aside.columns(), id_of, text_digest(quoted(text_column)).alias("text_sha256"))
    digests = checkpointed(named.select("_id", "text_sha256"))
    winners = heavy_winners(digests, "_id", "text_sha256", heavy, tracked)
    return mark_copies(named, winners, "_id", "text_sha256").select(*aside.back(), *new)
