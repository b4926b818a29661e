"""Queries over the driver tables and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrapanel.plans import audit_queries, grid_queries, label_queries, map_queries, more_queries, national_queries, panel_queries, selection_queries, topup_queries, variant_queries

_PARTS = (panel_queries, grid_queries, selection_queries, label_queries, audit_queries, more_queries, variant_queries, national_queries, map_queries, topup_queries)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_queries.entry(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for part in _PARTS for name, (run, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.QUERIES.items() if sql}
