"""Sources, sinks, views and the whole run."""

from __future__ import annotations

import csv
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tests.test_layers import RAW_TYPES, ROWS
from tidyledger.operators import kpi, layers, quality
from tidyledger.operators.rules import ORDER_RULES, Rule
from tidyledger.plans import pipeline, session, views
from tidyledger.schema import GOLD_SCHEMA, RAW_COLUMNS
from tidyledger.sources import readers, writers


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW_TYPES)


def rows(df):
    """Rows as text, so that NaN equals NaN."""
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_csv_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.option("header", True).option("escape", '"').csv(path)
    back = readers.read_raw_csv(spark, path)
    assert dict(back.dtypes) == {**{name: "string" for name in back.columns}, "row_id": "bigint"}
    assert rows(layers.clean(back)) == rows(layers.clean(raw))
    assert quality.malformed_lines(back).first()[0] == 0


def test_csv_of_another_writer(spark, tmp_path):
    """Doubled quotes, commas inside quotes, another order of columns, a column too many."""
    names = ["hour_of_day", "extra", *RAW_COLUMNS[:-1]]
    line = {
        "row_id": "9", "date": "2024-05-01", "customer_segment": 'a "b", c', "order_amount_old": "10",
        "cost": "4", "is_return": "0", "payment_method": 'x, "y"', "hour_of_day": "1", "extra": "?",
    }
    with (tmp_path / "x.csv").open("w", newline="") as file:
        writer = csv.DictWriter(file, names)
        writer.writeheader()
        writer.writerow(line)
        writer.writerow({**line, "row_id": "10", "payment_method": None})
    raw = readers.read_raw_csv(spark, str(tmp_path / "x.csv"))
    assert quality.malformed_lines(raw).first()[0] == 0
    gold = {r.row_id: r for r in layers.clean(raw).collect()}
    assert (gold[9].payment_method, gold[9].customer_segment, gold[9].hour_of_day) == ('x, "y"', 'a "b", c', 1)
    assert gold[10].payment_method is None


def test_malformed_lines_are_kept_and_counted(spark, tmp_path):
    good = "2024-05-01,gold,10,4,0,card,1"
    lines = [",".join(RAW_COLUMNS), f"1,{good}", f"2,{good},surplus", "3,2024-05-01,gold", f"four,{good}"]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    raw = readers.read_raw_csv(spark, str(tmp_path / "x.csv"))
    assert quality.malformed_lines(raw).first()[0] == 3
    assert raw.count() == 4
    assert sorted(str(r.row_id) for r in layers.clean(raw).collect()) == ["1", "2", "None"]
    assert sum(r.malformed_line is not None for r in raw.collect()) == 3
    assert quality.malformed_lines(raw.drop("malformed_line")).first()[0] == 0


def test_csv_without_a_column_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c,d,e,f,g,h\n1,2,3,4,5,6,7,8\n")
    with pytest.raises(ValueError, match="row_id, date"):
        readers.read_raw_csv(spark, str(tmp_path / "x.csv"))


@pytest.mark.parametrize("kind", ["csv", "parquet", "table"])
def test_smallest_key_and_schema_from_every_source(spark, tmp_path, kind):
    """Of the keys 9 and 10 the smaller number stays, not the smaller text."""
    order = ("2024-05-01", "gold", "10", "4", "0", "card", "1")
    keys = ["10", "9"] if kind == "csv" else [10, 9]
    types = RAW_TYPES.replace("row_id long", "row_id string") if kind == "csv" else RAW_TYPES
    df = spark.createDataFrame([(key, *order) for key in keys], types)
    path = str(tmp_path / "raw")
    if kind == "csv":
        df.write.option("header", True).csv(path)
        raw = readers.read_raw_csv(spark, path)
    elif kind == "parquet":
        df.write.parquet(path)
        raw = readers.read_raw_parquet(spark, path)
    else:
        df.createOrReplaceTempView("keyed_orders")
        raw = readers.read_raw_table(spark, "keyed_orders")
    filtered = layers.silver_filtered(layers.silver_normalised(layers.silver_parsed(raw)))
    assert [r.row_id for r in layers.dedup_business_key(filtered).collect()] == [9]
    assert layers.clean(raw).dtypes == [(f.name, f.dataType.simpleString()) for f in GOLD_SCHEMA]


def test_parquet_and_table(spark, raw, tmp_path):
    raw.selectExpr("*", "1 AS other").write.parquet(str(tmp_path / "raw"))
    assert rows(readers.read_raw_parquet(spark, str(tmp_path / "raw"))) == rows(raw)
    raw.createOrReplaceTempView("raw_orders")
    assert readers.read_raw_table(spark, "raw_orders").columns == list(RAW_COLUMNS)


def test_files_are_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_files(spark.range(5).toDF("x"), path).count() == 5
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_files(spark.range(2).toDF("x"), path)
    assert spark.read.parquet(path).count() == 5


def test_replace_table_replaces(spark, tmp_path):
    spark.sql(f"CREATE DATABASE sink LOCATION '{tmp_path}'")
    try:
        assert writers.replace_table(spark.range(5).toDF("x"), "sink.t").count() == 5
        other = spark.range(2).toDF("y")
        assert writers.replace_table(other, "sink.t").columns == ["y"]
        assert spark.sql("SELECT count(*) FROM sink.t").first()[0] == 2
    finally:
        spark.sql("DROP DATABASE sink CASCADE")


def names_in(spark, database) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


def test_a_failed_write_leaves_the_first_table_whole(spark, tmp_path):
    spark.sql(f"CREATE DATABASE swap LOCATION '{tmp_path}'")
    try:
        writers.replace_table(spark.range(5).toDF("x"), "swap.t")
        broken = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).otherwise(1).alias("y"))
        with pytest.raises(Exception, match="broken"):
            writers.replace_table(broken, "swap.t")
        assert sorted(r.x for r in spark.table("swap.t").collect()) == [0, 1, 2, 3, 4]
        assert names_in(spark, "swap") == ["t"]
        # The new rows may come from the table that they replace.
        grown = writers.replace_table(spark.table("swap.t").selectExpr("x + 1 AS x"), "swap.t")
        assert sorted(r.x for r in grown.collect()) == [1, 2, 3, 4, 5]
        assert names_in(spark, "swap") == ["t"]
    finally:
        spark.sql("DROP DATABASE swap CASCADE")


def test_a_failed_renaming_gives_the_old_table_its_name_back(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE DATABASE swap LOCATION '{tmp_path}'")
    run = type(spark).sql

    def fail(session, query, *args, **kwargs):
        if re.match(r"ALTER TABLE \S+_staged_", query):
            raise RuntimeError("no renaming")
        return run(session, query, *args, **kwargs)

    try:
        writers.replace_table(spark.range(5).toDF("x"), "swap.t")
        monkeypatch.setattr(type(spark), "sql", fail)
        with pytest.raises(RuntimeError, match="no renaming"):
            writers.replace_table(spark.range(2).toDF("y"), "swap.t")
        monkeypatch.undo()
        assert spark.table("swap.t").count() == 5
        assert names_in(spark, "swap") == ["t"]
    finally:
        monkeypatch.undo()
        spark.sql("DROP DATABASE swap CASCADE")


def test_run_reports_malformed_lines(spark, raw, tmp_path):
    good = "2024-05-01,gold,10,4,0,card,1"
    lines = [",".join(RAW_COLUMNS), f"1,{good}", f"2,{good},surplus", "3,2024-05-01,gold", f"four,{good}"]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    from_file = readers.read_raw_csv(spark, str(tmp_path / "x.csv"))
    assert pipeline.run(spark, from_file, str(tmp_path / "out")).malformed_lines.first()[0] == 3
    assert pipeline.run(spark, raw, str(tmp_path / "out")).malformed_lines.first()[0] == 0
    assert scans(quality.profile(from_file)) == 1


def test_a_working_folder_on_a_cluster_must_be_named(spark, tmp_path):
    class Cluster:
        master = "spark://host:7077"

    class Session:
        sparkContext = Cluster()
        conf = {}

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        assert session.working_folder(spark) != session.working_folder(spark)
    with pytest.raises(ValueError, match=re.escape("spark.checkpoint.dir")):
        session.working_folder(Session())
    Session.conf = {"spark.checkpoint.dir": f"{tmp_path}/"}
    assert session.working_folder(Session()) == str(tmp_path)


def test_run(spark, raw, tmp_path):
    tables = pipeline.run(spark, raw, str(tmp_path))
    assert rows(tables.clean_table) == rows(layers.clean(raw))
    assert rows(tables.kpi_results) == rows(kpi.kpi_results(layers.clean(raw)))
    assert tables.quality_summary.first().kept_after_filter == 5
    stages = pipeline.stage_counts(tables).orderBy("stage_no").collect()
    assert [r.row_count for r in stages] == [10, 10, 10, 5, 4]
    profile = spark.read.parquet(f"{tables.folder}/quality_profile")
    assert rows(quality.summary_of(profile)) == rows(quality.quality_summary(raw))
    assert rows(tables.segment_mapping) == rows(quality.segment_mapping_profile(raw))
    assert rows(tables.payment_methods) == rows(quality.payment_profile(raw))


def test_a_failed_run_leaves_the_earlier_one_whole(spark, raw, tmp_path, monkeypatch):
    first = pipeline.run(spark, raw, str(tmp_path))
    monkeypatch.setattr(kpi, "kpi_results", lambda gold: gold.select(F.raise_error(F.lit("broken"))))
    with pytest.raises(Exception, match="broken"):
        pipeline.run(spark, raw, str(tmp_path))
    monkeypatch.undo()
    assert first.clean_table.count() == 4
    assert len({first.folder, pipeline.run(spark, raw, str(tmp_path)).folder}) == 2


def test_run_into_a_database(spark, raw, tmp_path):
    spark.sql(f"CREATE DATABASE results LOCATION '{tmp_path}'")
    try:
        for _ in range(2):
            pipeline.run(spark, raw, database="results")
        value = spark.sql("SELECT kpi_value FROM results.kpi_results WHERE kpi_name = 'kpi_8'").first()[0]
        assert value == kpi.kpi_8(layers.clean(raw)).first().kpi_value
        assert spark.table("results.clean_table").count() == 4
    finally:
        spark.sql("DROP DATABASE results CASCADE")


def test_run_sizes_the_session(spark, raw, tmp_path):
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {name: spark.conf.get(name) for name in names}
    try:
        pipeline.run(spark, raw, str(tmp_path), input_bytes=40 * session.GIB)
        assert spark.conf.get(names[0]) == "20"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_without_a_folder_there_is_no_run(spark, raw):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match=re.escape("spark.checkpoint.dir")):
            pipeline.run(spark, raw)


def test_views(spark, raw):
    views.register_layers(raw)
    views.register_kpis(spark.table("clean_table"))
    assert spark.sql("SELECT count(*) FROM silver_parsed").first()[0] == len(ROWS)
    assert spark.sql("SELECT count(*) FROM silver_filtered").first()[0] == 5
    value = spark.sql("SELECT kpi_value FROM kpi_8").first()[0]
    assert spark.sql("SELECT kpi_value FROM kpi_results WHERE kpi_name = 'kpi_8'").first()[0] == value


def code_size(df, capsys) -> int:
    """Bytes of the largest generated method."""
    spark = df.sparkSession
    with_adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    return max(sizes, default=0)


@pytest.fixture(scope="module")
def stored(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "raw")
    raw.write.parquet(path)
    return readers.read_raw_parquet(spark, path)


@pytest.mark.parametrize("name", entry_module.order_queries())
def test_generated_code_stays_small_enough_to_compile(stored, name, capsys, monkeypatch):
    """The JVM never compiles a method of more than 8,000 bytes of bytecode."""
    monkeypatch.setattr(entry_module, "read_dirty_orders", lambda spark, directory: stored)
    query = entry_module.order_queries()[name]
    assert code_size(query(stored.sparkSession, ""), capsys) < 8000


@pytest.mark.parametrize("name", entry_module.order_queries())
def test_every_stage_compiles(stored, name, monkeypatch):
    """Spark falls back to interpretation where generated code is refused; here it must not."""
    spark = stored.sparkSession
    monkeypatch.setattr(entry_module, "read_dirty_orders", lambda spark, directory: stored)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        entry_module.order_queries()[name](spark, "").write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


def test_columns_of_custom_rules_are_fenced(stored, capsys):
    rules = (*ORDER_RULES, Rule("known", "customer_segment = 'gold' AND date LIKE '%2024'"))
    assert code_size(layers.clean(stored, rules), capsys) < 8000


def test_rows_without_a_needed_column_stop_at_the_scan(stored, capsys):
    def pushed(rules):
        layers.clean(stored, rules).explain("formatted")
        found = re.search(r"PushedFilters: \[([^]]*)\]", capsys.readouterr().out)
        return found.group(1) if found else ""

    for name in ("date", "order_amount_old", "cost", "is_return", "hour_of_day"):
        assert f"IsNotNull({name})" in pushed(ORDER_RULES)
    assert pushed((Rule("any", "cost > 0 OR cost IS NULL"),)) == ""


def scans(df) -> int:
    """File scans of the plan that ran; what is reused counts once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return plan.count("FileScan")


def test_one_scan_for_the_stage_counts(stored):
    assert scans(quality.stage_row_counts(stored)) == 1
    assert scans(quality.profile(stored)) == 1


def test_columns_nobody_needs_are_not_read(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    stored = readers.read_raw_parquet(spark, str(tmp_path / "raw"))
    filtered = layers.silver_filtered(layers.silver_normalised(layers.silver_parsed(stored)))
    plan = filtered.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"FileScan parquet \[([^]]*)\]", plan).group(1)
    assert "customer_segment" not in read and "payment_method" not in read


def test_shuffle_partitions():
    assert session.shuffle_partitions(10, 8) == 8
    assert session.shuffle_partitions(100 * 10**12, 4000) == 46567
