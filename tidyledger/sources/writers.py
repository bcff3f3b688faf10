"""Result tables as Parquet files or catalog tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame


def write_files(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the new folder ``path`` and read it back.

    The result starts from the files, so later work neither repeats what led to
    them nor depends on the executors that wrote them. A folder with files is
    never overwritten: a run that fails leaves all earlier tables whole.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the catalog table ``name`` and read it back.

    The rows are first written to a table of their own, which then takes the
    place of the old one by renaming: two changes of the catalog, no copy. If the
    write fails, the old table stays as it is, also when ``df`` reads from it; if
    the second renaming fails, the old table gets its name back.
    """
    spark = df.sparkSession
    mark = uuid4().hex
    staged, retired = f"{name}_staged_{mark}", f"{name}_retired_{mark}"
    try:
        df.write.format("parquet").saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    replaces = spark.catalog.tableExists(name)
    if replaces:
        spark.sql(f"ALTER TABLE {name} RENAME TO {retired}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if replaces:
            spark.sql(f"ALTER TABLE {retired} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {retired}")
    return spark.table(name)
