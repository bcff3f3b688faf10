"""Raw tables from files and catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidyledger.schema import MALFORMED, RAW_COLUMNS, require_columns


def read_raw_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with a header line: text columns, a whole number as ``row_id``.

    Columns are found by name, so they may stand in any order with others
    between them; all files must have the same header. Fields may be quoted, with
    quotes inside doubled. An empty field is NULL. A line with fields too few or
    too many, or whose ``row_id`` is no whole number, keeps the fields that can be
    read, and the column ``malformed_line`` has its text (read it with all columns,
    as ``quality.malformed_lines`` does). Files are split, so
    records must not span lines unless ``multiLine`` is set.
    """
    settings = {"header": True, "quote": '"', "escape": '"', **options}
    names = spark.read.options(**settings).csv(path).columns
    missing = [name for name in RAW_COLUMNS if name not in names]
    if missing:
        raise ValueError(f"the header of {path} lacks the columns {', '.join(missing)}")
    fields = [StructField(name, LongType() if name == "row_id" else StringType()) for name in names]
    reader = spark.read.schema(StructType([*fields, StructField(MALFORMED, StringType())])).options(
        mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=MALFORMED
    )
    return reader.options(**settings).csv(path).select(*RAW_COLUMNS, MALFORMED)


def read_raw_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files; columns may be text or numbers."""
    raw = spark.read.parquet(path)
    require_columns(raw, RAW_COLUMNS, path)
    return raw.select(*RAW_COLUMNS)


def read_raw_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or temporary view."""
    raw = spark.table(name)
    require_columns(raw, RAW_COLUMNS, name)
    return raw.select(*RAW_COLUMNS)
