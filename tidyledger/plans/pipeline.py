"""The whole run: raw table to clean table, quality reports and KPI table."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.operators import kpi, layers, quality
from tidyledger.operators.rules import ORDER_RULES, Rule
from tidyledger.plans.session import size_session
from tidyledger.sources.writers import replace_table, write_files


@dataclass(frozen=True)
class Tables:
    """The written tables, each read back; ``folder`` is None for catalog tables."""

    clean_table: DataFrame
    kpi_results: DataFrame
    quality_summary: DataFrame
    segment_mapping: DataFrame
    payment_methods: DataFrame
    malformed_lines: DataFrame
    folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set; name a shared folder for the tables")
    return folder


def run(
    spark: SparkSession,
    raw: DataFrame,
    target: str | None = None,
    rules: tuple[Rule, ...] = ORDER_RULES,
    database: str | None = None,
    input_bytes: int | None = None,
) -> Tables:
    """Write every table into a new folder below ``target``, or into ``database``.

    Without ``target`` the folder lies below the shared one. No earlier run is
    touched, whatever happens to this one. With ``database`` the tables become
    catalog tables, each created or replaced.

    The raw table is scanned twice: for the clean table and for the quality
    profile, of which the reports are sums. The KPIs read the clean table as
    written: column by column, and without cleaning again when an executor is
    lost. ``input_bytes``, if known, sets the session's shuffle and scan sizes.
    """
    if input_bytes is not None:
        size_session(spark, input_bytes)
    folder = None
    if database is None:
        folder = f"{(target or shared_folder(spark)).rstrip('/')}/run-{uuid4().hex}"

    def write(name: str, df: DataFrame) -> DataFrame:
        return replace_table(df, f"{database}.{name}") if folder is None else write_files(df, f"{folder}/{name}")

    gold = write("clean_table", layers.clean(raw, rules))
    results = write("kpi_results", kpi.kpi_results(gold))
    profile = write("quality_profile", quality.profile(raw, rules))
    return Tables(
        clean_table=gold,
        kpi_results=results,
        quality_summary=write("quality_summary", quality.summary_of(profile)),
        segment_mapping=write("segment_mapping", quality.segment_mapping_of(profile)),
        payment_methods=write("payment_methods", quality.payment_methods_of(profile)),
        malformed_lines=write("malformed_lines", quality.malformed_of(profile)),
        folder=folder,
    )


def stage_counts(tables: Tables) -> DataFrame:
    """Rows per layer from the written tables, without another look at the raw one."""
    total, kept = F.col("total_rows"), F.col("kept_after_filter")
    before = tables.quality_summary.select(total, F.coalesce(kept, F.lit(0)).alias("kept"))
    early = before.selectExpr(
        "stack(4, 1, 'raw', total_rows, 2, 'parsed', total_rows, 3, 'normalised', total_rows,"
        " 4, 'filtered', kept) AS (stage_no, stage, row_count)"
    )
    final = tables.clean_table.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(5).alias("stage_no"), F.lit("final").alias("stage"), "row_count"
    )
    return early.unionByName(final)
