"""The cleaning layers: raw, parsed, normalised, filtered, clean.

Every layer but the last is a narrow select or filter, so raw to filtered is
one stage. The clean table adds the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.functions import (
    binary_flag,
    canonical_date,
    clean_text,
    map_typos,
    parse_timestamp,
    to_double,
    to_integer,
    to_key,
)
from tidyledger.operators.fence import barrier, compute_once
from tidyledger.operators.rules import ORDER_RULES, Rule, columns_needed, columns_read, passes_all
from tidyledger.schema import BUSINESS_KEY, GOLD_COLUMNS, MALFORMED, RAW_COLUMNS, require_columns


def silver_parsed(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns; what cannot be read is NULL. Keeps every row.

    ``carry`` names further columns to take along unchanged.
    """
    require_columns(raw, RAW_COLUMNS, "the raw table")
    types = {field.name: field.dataType for field in raw.schema}
    return raw.select(
        to_key(F.col("row_id"), types["row_id"]).alias("row_id"),
        parse_timestamp(F.col("date"), types["date"]).alias("parsed_dt"),
        clean_text(F.col("customer_segment")).alias("customer_segment_raw"),
        to_double(F.col("order_amount_old"), types["order_amount_old"]).alias("order_amount_old"),
        to_double(F.col("cost"), types["cost"]).alias("cost"),
        to_integer(F.col("is_return"), types["is_return"]).alias("is_return"),
        "payment_method",
        to_integer(F.col("hour_of_day"), types["hour_of_day"]).alias("hour_of_day"),
        *carry,
    )


def silver_normalised(parsed: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Canonical date text, corrected segments, 0/1 flags. Keeps every row."""
    return parsed.select(
        "row_id",
        "parsed_dt",
        canonical_date(F.col("parsed_dt")).alias("date"),
        map_typos(F.col("customer_segment_raw")).alias("customer_segment"),
        "order_amount_old",
        "cost",
        binary_flag(F.col("is_return")).alias("is_return"),
        "payment_method",
        "hour_of_day",
        *carry,
    )


def normalised_beside_raw(raw: DataFrame) -> DataFrame:
    """The normalised layer with the raw columns beside it, in a struct ``raw``.

    With the column of malformed lines too, if the reader gave one.
    """
    columns = [name for name in (*RAW_COLUMNS, MALFORMED) if name in raw.columns]
    beside = raw.withColumn("raw", F.struct(*columns))
    return silver_normalised(silver_parsed(beside, ("raw",)), ("raw",))


def fenced(normalised: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """The same rows, with what the rules read computed once, and the segment too.

    The segment lies behind a barrier that is pruned: a count that needs the
    rules alone neither computes nor reads it.
    """
    read = columns_read(rules, normalised.columns)
    if "customer_segment" not in read:
        normalised = barrier(normalised, ("customer_segment",))
    return compute_once(normalised, read) if read else normalised


def silver_filtered(normalised: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """The rows that every rule keeps."""
    return fenced(normalised, rules).filter(passes_all(rules))


def _order_columns(filtered: DataFrame) -> DataFrame:
    """The clean-table columns with the day as a DATE, half as wide as its text."""
    return filtered.withColumn("date", F.col("parsed_dt").cast("date")).select(*GOLD_COLUMNS)


def _with_date_text(orders: DataFrame) -> DataFrame:
    return orders.withColumn("date", canonical_date(F.col("date")))


def clean_table(filtered: DataFrame) -> DataFrame:
    """Distinct orders; two rows are equal when all columns with ``row_id`` are.

    Copies are merged before the shuffle (partial aggregation), so an order
    that is repeated very often reaches a reducer once per map task only. The
    day is shuffled as a DATE and written out as text afterwards.
    """
    return _with_date_text(_order_columns(filtered).distinct())


def copies_per_order(filtered: DataFrame) -> DataFrame:
    """The clean table with the number of ``copies`` of each row before it."""
    orders = _order_columns(filtered).groupBy(*GOLD_COLUMNS)
    return _with_date_text(orders.agg(F.count(F.lit(1)).alias("copies")))


def clean(raw: DataFrame, rules: tuple[Rule, ...] = ORDER_RULES) -> DataFrame:
    """All layers from the raw to the clean table.

    Rows in which a needed column is NULL are left out at the scan already.
    """
    for name in columns_needed(rules):
        raw = raw.filter(F.col(name).isNotNull())
    return clean_table(silver_filtered(silver_normalised(silver_parsed(raw)), rules))


def dedup_business_key(filtered: DataFrame) -> DataFrame:
    """One row per order whatever its ``row_id``, with the smallest ``row_id``.

    The stricter form of :func:`clean_table`. It is an aggregate and not
    ``dropDuplicates`` because that keeps an arbitrary row.
    """
    unique = _order_columns(filtered).groupBy(*BUSINESS_KEY).agg(F.min("row_id").alias("row_id"))
    return _with_date_text(unique).select(*GOLD_COLUMNS)
