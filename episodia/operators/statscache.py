"""Statistics kept by the hash of what they depend on (survey §2.13)."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def cache_key(dependencies: Iterable[str]) -> str:
    """SHA-256 of all dependencies, in order."""
    return hashlib.sha256("".join(dependencies).encode()).hexdigest()


def load_statistics(spark: SparkSession, folder: str, key: str) -> DataFrame | None:
    """The statistics kept under a key; None if there are none."""
    try:
        return spark.read.json(f"{folder}/statistics_{key}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def require_statistics(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """As load_statistics(), but an error says what to do where there are none."""
    found = load_statistics(spark, folder, key)
    if found is None:
        raise FileNotFoundError(f"no statistics under {folder} for {key}: compute them first")
    return found


def cached_statistics(spark: SparkSession, folder: str, dependencies: Iterable[str], compute: Callable[[], DataFrame]) -> DataFrame:
    """The statistics of the dependencies: read if kept, else computed, kept as JSON lines and read back."""
    key = cache_key(dependencies)
    found = load_statistics(spark, folder, key)
    if found is None:
        compute().write.json(f"{folder}/statistics_{key}")
        found = require_statistics(spark, folder, key)
    return found
