"""Column lists and schemas of every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

RAW_COLUMNS = (
    "row_id",
    "date",
    "customer_segment",
    "order_amount_old",
    "cost",
    "is_return",
    "payment_method",
    "hour_of_day",
)

# The raw columns that are checked for missing values; row_id is an opaque key.
AUDITED_COLUMNS = RAW_COLUMNS[1:]

# The clean table has the same names as the raw one, with types.
GOLD_COLUMNS = RAW_COLUMNS

# What makes an order the same order, whatever key it was loaded under.
BUSINESS_KEY = GOLD_COLUMNS[1:]

# The text of a line of a file that could not be read whole; NULL for good lines.
MALFORMED = "malformed_line"

PARSED_SCHEMA = StructType(
    [
        StructField("row_id", LongType()),
        StructField("parsed_dt", TimestampNTZType()),
        StructField("customer_segment_raw", StringType()),
        StructField("order_amount_old", DoubleType()),
        StructField("cost", DoubleType()),
        StructField("is_return", IntegerType()),
        StructField("payment_method", StringType()),
        StructField("hour_of_day", IntegerType()),
    ]
)

GOLD_SCHEMA = StructType(
    [
        StructField("row_id", LongType()),
        StructField("date", StringType()),
        StructField("customer_segment", StringType()),
        StructField("order_amount_old", DoubleType()),
        StructField("cost", DoubleType()),
        StructField("is_return", IntegerType()),
        StructField("payment_method", StringType()),
        StructField("hour_of_day", IntegerType()),
    ]
)

KPI_SCHEMA = StructType(
    [
        StructField("kpi_name", StringType()),
        StructField("kpi_value", StringType()),
        StructField("kpi_key", StringType()),
    ]
)


def require_columns(df: DataFrame, names: tuple[str, ...], what: str) -> None:
    """Raise when ``df`` lacks one of ``names``; the message says which."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
