"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.llm import (
    decontamination,
    exact_dedup,
    hard_negatives,
    language,
    language_model,
    mixing,
    packing,
    parsing,
    quality,
    secrets,
    simhash,
    token_counts,
    whitening,
)
from tidyledger.llm.common import checkpointed, word_count
from tidyledger.llm.ngrams import remainder

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/documents.parquet")


def op1_mix_sources(spark: SparkSession, directory: str) -> DataFrame:
    text = F.col("text")
    digest = F.md5(F.coalesce(text, F.lit("")))
    docs = documents(spark, directory).select("doc_id", "source", word_count(text).alias("size"), digest.alias("digest"))
    mixed = mixing.mix_sources(docs, digest_column="digest")
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_language_model(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).select("doc_id", "text")
    model = language_model.train(docs.filter(remainder("doc_id", 7) != 2))
    return language_model.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op3_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    digests = checkpointed(
        documents(spark, directory).select("doc_id", exact_dedup.text_digest().alias("text_sha256"))
    )
    winners = exact_dedup.heavy_winners(digests, "doc_id", "text_sha256")
    return exact_dedup.mark_copies(digests, winners).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op4_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.simhash_near_duplicates(documents(spark, directory).select("doc_id", "text"))


def op5_parsing_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return parsing.fingerprint_with_next(documents(spark, directory).select("doc_id", "text"))


def op6_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(documents(spark, directory).select("doc_id", "text"))


def quality_model(docs: DataFrame, directory: str) -> quality.QualityModel:
    """Voters from the labels of the documents that are not held out."""
    labels = docs.sparkSession.read.parquet(f"{directory}/labels.parquet")
    return quality.fit(docs, labels.select("doc_id", "quality").filter(remainder("doc_id", 4) != 2))


def op7_quality(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).select("doc_id", "text")
    return quality.score(docs, quality_model(docs, directory)).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def op8_secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).select("doc_id", "text")
    # Half of the rows stand for versions that an earlier scan has seen.
    ledger = secrets.Ledger(spark)
    ledger.scan(docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0))
    ledger.scan(docs)
    found = secrets.findings_of_paths(docs, ledger.rows())
    findings = F.col("findings")
    return found.select(
        "doc_id",
        *[secrets.count_of(findings, kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.listed_spans(findings, secrets.BASE), 256).alias("base_sha256"),
        secrets.listed_spans(findings).alias("spans"),
    )


def op9_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).select("doc_id", "text", "lang")
    model = language.fit(docs.filter(remainder("doc_id", 3) != 1))
    return language.predict(docs, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op10_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, directory).select("doc_id", "text"))


def op11_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory).select("doc_id", "text")
    items = spark.read.parquet(f"{directory}/benchmark.parquet").select("item_id", "text")
    return decontamination.decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def embeddings(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/embeddings.parquet")


def op12_whitening(spark: SparkSession, directory: str) -> DataFrame:
    vectors = embeddings(spark, directory).select("vec_id", "embedding")
    return whitening.transform(vectors, whitening.fit(vectors))


def op13_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = embeddings(spark, directory).select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    found = (
        op1_mix_sources,
        op2_language_model,
        op3_exact_dedup,
        op4_simhash,
        op5_parsing_fingerprints,
        op6_packing,
        op7_quality,
        op8_secret_scan,
        op9_language,
        op10_token_counts,
        op11_decontamination,
        op12_whitening,
        op13_hard_negatives,
    )
    return {query.__name__: query for query in found}


def _spans(kind: str, pattern: str, least: str = "") -> str:
    """SQL for the (start, end) pairs of a kind, from the text between the matches."""
    pattern = pattern.replace("'", "''")
    good = f"list_transform(regexp_extract_all(text, '{pattern}', {least}), lambda v: len(v) >= 6)" if least else "NULL"
    return f"""
  SELECT doc_id, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, g, {good} AS good
  FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS m,
    string_split_regex(text, '{pattern}') AS g FROM docs) WHERE len(m) > 0"""


_LATIN_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE = {
    "op1_mix_sources": f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, {_WORDS} AS size,
    md5(concat_ws('/', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS o FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), dry AS (
  -- words served when the source runs dry, if the sources dry before it have stopped
  SELECT a.source, 2 * a.source_size / a.weight AS t,
    sum(CASE WHEN 2 * b.source_size / b.weight < 2 * a.source_size / a.weight THEN 2 * b.source_size ELSE 0 END) AS ended,
    sum(CASE WHEN 2 * b.source_size / b.weight < 2 * a.source_size / a.weight THEN 0 ELSE b.weight END) AS active
  FROM sources a, sources b GROUP BY a.source, t
), cut AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - ended) / active AS v
  FROM dry WHERE ended + active * t >= 1.5 * (SELECT sum(source_size) FROM sources)
  ORDER BY t LIMIT 1
), queued AS (
  SELECT doc_id, s.source_size, weight, size,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size,
  least(2.0::DOUBLE * source_size, weight * v) AS target,
  CAST(greatest(0, least(size, floor(weight * v - before)))
     + greatest(0, least(size, floor(weight * v - (source_size + before)))) AS BIGINT) AS taken
FROM queued, cut""",
    "op3_exact_dedup": """
WITH marked AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, text_sha256,
  max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept
FROM marked""",
    "op8_secret_scan": f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(
    _spans(rule.kind, rule.pattern, "2" if rule.group else "") for rule in secrets.RULES
)}
), spans AS (
  SELECT doc_id, kind,
    list_sum(list_transform(m[1:i], lambda x: len(x))) + list_sum(list_transform(g[1:i], lambda x: len(x))) AS e,
    len(m[i]) AS n
  FROM matches WHERE good IS NULL OR good[i]
), listed AS (
  SELECT doc_id, kind, CAST(e - n AS BIGINT) AS s, concat(kind, ':', CAST(e - n AS BIGINT), ':', CAST(e AS BIGINT)) AS span,
    CASE kind {" ".join(f"WHEN '{rule.kind}' THEN {i}" for i, rule in enumerate(secrets.RULES))} END AS rank
  FROM spans
), found AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM listed GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (doc_id)""",
    "op11_decontamination": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_LATIN_WORDS} AS w FROM documents
), items AS (
  SELECT item_id, {_LATIN_WORDS} AS w FROM benchmark
), strings AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS string
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
    FROM items WHERE len(w) > 0)
), places AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS string
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM strings)
    WHERE len(w) >= m)
), found AS (
  SELECT r, i, m, item_id FROM places JOIN strings USING (m, string)
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r
), listed AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    sha256(coalesce(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)), '')) AS h
  FROM found GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)""",
    "op13_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors a, vectors b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""",
}
