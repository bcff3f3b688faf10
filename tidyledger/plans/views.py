"""Temporary views of the layers and KPIs, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidyledger.operators import kpi, layers


def register_layers(raw: DataFrame) -> dict[str, DataFrame]:
    """Views silver_parsed, silver_normalised, silver_filtered and clean_table.

    They are definitions, nothing is computed. To query the clean table often,
    write it once and register that: see :mod:`tidyledger.plans.pipeline`.
    """
    parsed = layers.silver_parsed(raw)
    normalised = layers.silver_normalised(parsed)
    filtered = layers.silver_filtered(normalised)
    views = {
        "silver_parsed": parsed,
        "silver_normalised": normalised,
        "silver_filtered": filtered,
        "clean_table": layers.clean_table(filtered),
    }
    return _register(views)


def register_kpis(gold: DataFrame) -> dict[str, DataFrame]:
    """Views kpi_1 to kpi_10 and kpi_results over a clean table."""
    views = {name: build(gold) for name, build in kpi.KPIS.items()}
    views["kpi_results"] = kpi.kpi_results(gold)
    return _register(views)


def _register(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
