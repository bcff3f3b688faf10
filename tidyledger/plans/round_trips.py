"""The raw orders through each kind of store and back.

Every function writes into a new folder below the one that the cluster shares,
and returns what a reader makes of it.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.operators import layers
from tidyledger.plans import pipeline
from tidyledger.plans.session import working_folder
from tidyledger.schema import MALFORMED, RAW_COLUMNS
from tidyledger.sources import readers, writers
from tidyledger.sources.derived import damaged_lines


def _folder(df: DataFrame, name: str) -> str:
    return f"{working_folder(df.sparkSession)}/{name}-{uuid4().hex}"


def _as_csv(raw: DataFrame) -> DataFrame:
    """The orders written as CSV with some damaged lines, and read back."""
    folder = _folder(raw, "csv")
    # One column whose name is the header and whose values are whole lines; the
    # separator and the quote are characters that occur in no line.
    plain = {"header": True, "sep": "\x01", "quote": "\x02", "escape": "\x02", "ignoreLeadingWhiteSpace": False}
    lines = damaged_lines(raw).toDF(",".join(RAW_COLUMNS))
    lines.write.options(ignoreTrailingWhiteSpace=False, **plain).csv(folder)
    return readers.read_raw_csv(raw.sparkSession, folder)


def csv_import(raw: DataFrame) -> DataFrame:
    """The raw columns as read from CSV, and whether the line was ``malformed``."""
    return _as_csv(raw).select(*RAW_COLUMNS, F.col(MALFORMED).isNotNull().alias("malformed"))


def csv_run(raw: DataFrame) -> DataFrame:
    """A whole run over the CSV files: one row of counts from its tables."""
    tables = pipeline.run(raw.sparkSession, _as_csv(raw), working_folder(raw.sparkSession))
    final = tables.clean_table.agg(F.count(F.lit(1)).alias("clean_rows"))
    counts = tables.quality_summary.select("total_rows", "date_parse_failures", "kept_after_filter")
    # Three tables of one row each, put side by side by a constant key.
    one = F.lit(1).alias("one")
    joined = counts.select("*", one).join(tables.malformed_lines.select("*", one), "one")
    return joined.join(final.select("*", one), "one").drop("one")


def parquet_import(raw: DataFrame) -> DataFrame:
    """The orders written as Parquet files and read back."""
    folder = _folder(raw, "parquet")
    writers.write_files(raw, folder)
    return readers.read_raw_parquet(raw.sparkSession, folder)


def catalog_table(raw: DataFrame) -> DataFrame:
    """A catalog table that held the clean orders, replaced by the raw ones."""
    spark = raw.sparkSession
    database = f"round_trip_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_folder(raw, database)}'")
    writers.replace_table(layers.clean(raw), f"{database}.orders")
    writers.replace_table(raw, f"{database}.orders")
    return readers.read_raw_table(spark, f"{database}.orders")


ROUND_TRIPS = {f.__name__: f for f in (csv_import, csv_run, parquet_import, catalog_table)}
