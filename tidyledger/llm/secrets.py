"""Secret scans over versions of files, with a ledger of what has been scanned.

Every version is addressed by the SHA-256 of its text. A text is scanned once
per rule version, however many paths and versions have it and however often the
scan runs: the ledger holds the pairs of digest and rule version that are done.
Findings belong to digests and are joined back to all paths. The ledger is stored
in the folder that the cluster shares; every scan adds to it what it found.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidyledger.llm.common import Aside, checkpointed, quoted, text_of
from tidyledger.llm.exact_dedup import text_digest
from tidyledger.llm.shared import new_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose group is long enough."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


_ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: The base rules in their order, then those that this scan adds. Runs of a minimal
#: length are the same as whole runs of which the shorter are dropped.
RULES = (
    Rule("assign", _ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULE_VERSION = "1"
BASE = ("assign", "access", "hex")

LEDGER_SCHEMA = (
    "digest string, rule_version string, findings array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
)
HEAVY = 256  # digests with the most paths, whose findings are broadcast
FEW = 256  # findings that a broadcast digest may have, which bounds the broadcast
_MATCH = "struct<kind:string,rank:int,i:int,gap:int,length:int,good:boolean>"


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """Matches of one rule: length, text before it since the last match, and whether it counts."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    zipped = F.arrays_zip(found.alias("m"), tested.alias("t"), F.split(text, pattern, F.lit(-1)).alias("g"))
    # There is one gap more than matches.
    listed = F.transform(
        F.slice(zipped, F.lit(1), F.size(found)),
        lambda x, i: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rank).alias("rank"),
            i.alias("i"),
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("length"),
            (F.length(x["t"]) >= rule.least).alias("good"),
        ),
    )
    # Most texts have no match; they are searched once only.
    return F.when(text.rlike(rule.pattern), listed).otherwise(F.array().cast(f"array<{_MATCH}>"))


def scan_versions(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """New ledger rows: `digest`, `rule_version` and `findings`.

    One row for every digest among `versions` that `ledger` (rows of the same
    kind) does not hold under the rule version. Findings are structs of `start`,
    `rank` (of the rule), `end` and `kind`, sorted; positions are code points, the
    end exclusive. A text without findings has an empty list. Null text counts as
    empty. No rows give no rows.
    """
    text = quoted(text_column)
    texts = versions.select(text_digest(text).alias("digest"), text_of(text).alias("_text"))
    # Copies are merged before the shuffle. The steps after it keep its partitioning.
    blobs = texts.groupBy("digest").agg(F.first("_text").alias("_text"))
    if ledger is not None:
        done = ledger.filter(F.col("rule_version") == rule_version).select("digest")
        blobs = blobs.join(done, "digest", "left_anti")
    listed = F.concat(*[_matches(F.col("_text"), rule, rank) for rank, rule in enumerate(rules)])
    each = blobs.select("digest", F.explode_outer(listed).alias("_f")).select("digest", "_f.*")
    in_order = Window.partitionBy("digest", "rank").orderBy("i")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(in_order))
    finding = F.struct((F.col("end") - F.col("length")).alias("start"), "rank", "end", "kind")
    return placed.groupBy("digest").agg(
        F.lit(rule_version).alias("rule_version"),
        F.array_sort(F.collect_list(F.when(F.col("good"), finding))).alias("findings"),
    )


class Ledger:
    """The stored ledger: a folder with one batch of Parquet files for each scan.

    One scan at a time may add to it. A scan that fails adds nothing.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or new_folder(spark, "secret-ledger")

    def rows(self) -> DataFrame:
        """All pairs that are done, with their findings."""
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.folder).select("digest", "rule_version", "findings")

    def scan(
        self,
        versions: DataFrame,
        text_column: str = "text",
        rules: tuple[Rule, ...] = RULES,
        rule_version: str = RULE_VERSION,
    ) -> None:
        """Scan the texts that the ledger does not hold under the rule version, and add them."""
        added = scan_versions(versions, self.rows(), text_column, rules, rule_version)
        added.write.parquet(f"{self.folder}/batch={uuid.uuid4().hex}")


def findings_of_paths(
    versions: DataFrame, ledger: DataFrame, text_column: str = "text", rule_version: str = RULE_VERSION
) -> DataFrame:
    """`versions` without the text, with `digest` and `findings` of every row.

    Columns of these names, in any case, are replaced. `ledger` must hold all the
    digests; a digest that it lacks has null findings. Of the digests that most
    rows have, the findings are broadcast (of those with at most FEW), so that a
    text with a large share of the rows does not meet them all in one task.
    """
    aside = Aside(versions, ("digest", "findings", text_column))
    paths = checkpointed(versions.select(*aside.columns(), text_digest(quoted(text_column)).alias("digest")))
    done = ledger.filter(F.col("rule_version") == rule_version).select("digest", "findings")
    frequent = paths.groupBy("digest").count().filter("count > 1").orderBy(F.desc("count"), "digest").limit(HEAVY)
    few = done.filter(F.size("findings") <= FEW).join(F.broadcast(frequent.select("digest")), "digest", "left_semi")
    marked = paths.join(F.broadcast(few.withColumn("_few", F.lit(True))), "digest", "left")
    rest = marked.filter("_few is null").select(*aside.names, "digest").join(done, "digest", "left")
    near = marked.filter("_few").select(*aside.names, "digest", "findings")
    return rest.unionByName(near).select(*aside.back(), "digest", "findings")


def listed_spans(findings: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Findings as kind:start:end, comma-joined; all kinds or those given."""
    if kinds is not None:
        findings = F.filter(findings, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def count_of(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("long")
