"""Queries by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import additions, catalog, policies, preparation, scenes  # noqa: F401 - they register their queries
from . import queries as all_queries


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_queries.QUERIES["w1_clips"](spark, sf_dir)


def queries() -> dict[str, all_queries.Query]:
    return dict(all_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(all_queries.SQL)
