"""Profiles and quality checks. All are single aggregations with small results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.operators.fence import compute_once
from tidyledger.operators.layers import (
    clean_table,
    copies_per_order,
    fenced,
    normalised_beside_raw,
    silver_normalised,
    silver_parsed,
)
from tidyledger.operators.rules import ORDER_RULES, Rule, passes_all, violations
from tidyledger.schema import AUDITED_COLUMNS, GOLD_COLUMNS, MALFORMED, RAW_COLUMNS


def _row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def sample(df: DataFrame, n: int = 20, ordered: bool = False) -> DataFrame:
    """The first ``n`` rows: any rows, or with ``ordered`` the smallest ones.

    Unordered it reads no more partitions than it needs. Ordered it is a
    top-n: every task keeps ``n`` rows and nothing is sorted whole.
    """
    if ordered:
        df = df.orderBy(*(F.col(name).asc_nulls_last() for name in df.columns))
    return df.limit(n)


def _null_counts(columns: tuple[str, ...], inside: str = "") -> list[Column]:
    return [
        F.sum(F.when(F.col(inside + name).isNull(), 1).otherwise(0)).alias(f"null_{name}")
        for name in columns
    ]


def _date_failures() -> Column:
    failed = F.when(F.col("parsed_dt").isNull(), 1).otherwise(0)
    return F.sum(failed).alias("date_parse_failures")


def null_audit(raw: DataFrame, columns: tuple[str, ...] = AUDITED_COLUMNS) -> DataFrame:
    """One row: ``total_rows`` and ``null_<column>`` for each column."""
    return raw.agg(_row_count("total_rows"), *_null_counts(columns))


def value_counts(df: DataFrame, column: str, count_name: str) -> DataFrame:
    """How often each value occurs, NULL included, most frequent first."""
    counts = df.groupBy(column).agg(_row_count(count_name))
    return counts.orderBy(F.col(count_name).desc(), F.col(column).asc_nulls_last())


def segment_profile(df: DataFrame) -> DataFrame:
    """``value_counts`` of customer_segment, for the raw or normalised layer."""
    return value_counts(df, "customer_segment", "nbr_segments")


def payment_profile(df: DataFrame) -> DataFrame:
    """``value_counts`` of payment_method."""
    return value_counts(df, "payment_method", "nbr_methods")


def segment_mapping_profile(raw: DataFrame) -> DataFrame:
    """Raw segment against corrected segment with row counts, in one pass."""
    pairs = normalised_beside_raw(raw).select(
        F.col("raw.customer_segment").alias("raw_segment"), "customer_segment"
    )
    counts = pairs.groupBy("raw_segment", "customer_segment").agg(_row_count("nbr_rows"))
    labels = (F.col(name).asc_nulls_last() for name in ("raw_segment", "customer_segment"))
    return counts.orderBy(F.col("nbr_rows").desc(), *labels)


def parse_health(parsed: DataFrame) -> DataFrame:
    """One row: ``total_rows`` and ``date_parse_failures``."""
    return parsed.agg(_row_count("total_rows"), _date_failures())


def rule_impact(normalised: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """One row: how many rows each rule would drop. Rules overlap."""
    return normalised.agg(*violations(rules))


def kept_after_filter(filtered: DataFrame) -> DataFrame:
    """One row: the number of rows that passed the rules."""
    return filtered.agg(_row_count("kept_after_filter"))


def distinct_rows(filtered: DataFrame) -> DataFrame:
    """One row: the number of distinct rows; NULLs count as equal."""
    return clean_table(filtered).agg(_row_count("distinct_rows"))


def duplicate_rows(filtered: DataFrame) -> DataFrame:
    """The orders that occur more than once, with their number of ``copies``."""
    return copies_per_order(filtered).filter("copies > 1")


def stage_row_counts(raw: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """Rows per layer: (stage_no, stage, row_count), in one scan and one shuffle.

    The first three layers keep every row. Rows that a rule drops are counted
    together, without their columns, so that they do not travel one by one.
    """
    kept = F.coalesce(passes_all(rules), F.lit(False))
    marked = fenced(silver_normalised(silver_parsed(raw)), rules).withColumn("kept", kept)
    marked = compute_once(marked, ("kept",))
    day = F.col("parsed_dt").cast("date").alias("date")
    columns = [day if name == "date" else F.col(name) for name in GOLD_COLUMNS]
    groups = marked.select("kept", *[F.when(F.col("kept"), c).alias(n) for n, c in zip(GOLD_COLUMNS, columns)])
    counts = groups.groupBy("kept", *GOLD_COLUMNS).agg(_row_count("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0)).alias("filtered"),
        F.count(F.when(F.col("kept"), 1)).alias("final"),
    )
    return counts.selectExpr(
        "stack(5, 1, 'raw', total, 2, 'parsed', total, 3, 'normalised', total,"
        " 4, 'filtered', filtered, 5, 'final', final) AS (stage_no, stage, row_count)"
    )


def _summary_counts(rules: tuple[Rule, ...]) -> list[Column]:
    return [
        _row_count("total_rows"),
        *_null_counts(AUDITED_COLUMNS, "raw."),
        _date_failures(),
        *violations(rules),
        F.sum(F.when(passes_all(rules), 1).otherwise(0)).alias("kept_after_filter"),
    ]


def quality_summary(raw: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """NULL audit, parse health, rule impact and kept rows as one row, in one scan."""
    return normalised_beside_raw(raw).agg(*_summary_counts(rules))


# The columns by which the profile is grouped.
_PROFILE_KEYS = ("raw_segment", "customer_segment", "payment_method")


def profile(raw: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """The counts of ``quality_summary`` by raw and corrected segment and payment method.

    With them the number of ``malformed_lines`` of the files. One scan, from
    which the reports below are sums.
    """
    rows = normalised_beside_raw(raw).withColumn("raw_segment", F.col("raw.customer_segment"))
    malformed = _malformed_count("raw.") if MALFORMED in raw.columns else F.lit(0).cast("long")
    counts = _summary_counts(rules)
    return rows.groupBy(*_PROFILE_KEYS).agg(*counts, malformed.alias("malformed_lines"))


def summary_of(profiled: DataFrame) -> DataFrame:
    """``quality_summary`` from a profile."""
    names = [name for name in profiled.columns if name not in (*_PROFILE_KEYS, "malformed_lines")]
    first = F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows")
    return profiled.agg(first, *[F.sum(name).alias(name) for name in names if name != "total_rows"])


def segment_mapping_of(profiled: DataFrame) -> DataFrame:
    """``segment_mapping_profile`` from a profile."""
    keys = ("raw_segment", "customer_segment")
    counts = profiled.groupBy(*keys).agg(F.sum("total_rows").alias("nbr_rows"))
    return counts.orderBy(F.col("nbr_rows").desc(), *[F.col(name).asc_nulls_last() for name in keys])


def payment_methods_of(profiled: DataFrame) -> DataFrame:
    """``payment_profile`` from a profile."""
    counts = profiled.groupBy("payment_method").agg(F.sum("total_rows").alias("nbr_methods"))
    return counts.orderBy(F.col("nbr_methods").desc(), F.col("payment_method").asc_nulls_last())


def malformed_of(profiled: DataFrame) -> DataFrame:
    """``malformed_lines`` from a profile."""
    return profiled.agg(F.coalesce(F.sum("malformed_lines"), F.lit(0)).alias("malformed_lines"))


def _malformed_count(inside: str = "") -> Column:
    # A reader only notices what is wrong with the columns that it is asked for.
    every = F.coalesce(*[F.col(inside + name).cast("string") for name in RAW_COLUMNS], F.lit(""))
    return F.count(F.when(F.col(inside + MALFORMED).isNotNull(), every))


def malformed_lines(raw: DataFrame) -> DataFrame:
    """One row: how many lines of the files could not be read whole; 0 for other sources."""
    count = _malformed_count() if MALFORMED in raw.columns else F.lit(0).cast("long")
    return raw.agg(count.alias("malformed_lines"))
