"""A corpus made ready for training: stages over the table `documents`.

Each stage takes the documents that its predecessor kept and returns those that
stay, with the columns of documents; the last one returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.llm import exact_dedup, mixing, packing, quality, simhash
from tidyledger.llm.common import checkpointed, quoted
from tidyledger.llm.queries import quality_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Columns that the operators read; all others travel under names of their own.
READ = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> DataFrame:
    """`docs` with names that no operator uses for what it adds."""
    return docs.select(*[F.col(quoted(c)).alias(c if c in READ else f"_in{i}") for i, c in enumerate(docs.columns)])


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` under their names."""
    return found.select(*[F.col(c if c in READ else f"_in{i}").alias(c) for i, c in enumerate(docs.columns)])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality.score(_aside(docs), quality_model(docs, sf_dir))
    return _back(scored.filter(F.col("predicted") == 1), docs)


def keep_distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the document with the largest id."""
    return _back(exact_dedup.exact_dedup(_aside(docs)).filter("kept"), docs)


def keep_representatives(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document: that with the smallest id.

    Null ids come last; of one id the least digest of the text stays, and of rows
    that repeat id and text the first by their other columns as JSON.
    """
    # Fit for an id that is never null and orders all rows of a group.
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", exact_dedup.text_digest().alias("digest"))
    named = _aside(docs).withColumn("_key", key)
    groups = simhash.simhash_near_duplicates(named, id_column="_key")
    stays = groups.filter(F.col("_key").eqNullSafe(F.col("component_id"))).select("_key").distinct()
    kept = named.join(stays, "_key", "left_semi")
    # Repeated rows are merged before the shuffle.
    columns = [c for c in kept.columns if c != "_key"]
    order = F.to_json(F.struct(*[c for c in columns if c != "text"]), {"ignoreNullFields": "false"})
    one = kept.groupBy("_key").agg(F.min_by(F.struct(*columns), order).alias("row"))
    return _back(one.select("row.*"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mix takes, the last of a source cut to its target."""
    aside = _aside(docs)
    return _back(mixing.mixed_rows(mixing.mix_sources(aside), aside.columns), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("exact_dedup", keep_distinct_texts),
    ("simhash", keep_representatives),
    ("mixing", mix),
    ("packing", pack),
]

#: The quality classifier, the fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each writes Parquet that the next one reads.

    The files lie in a new folder below the session's checkpoint folder.
    """
    checkpointed(spark.range(1))  # sets a folder where none is set
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
