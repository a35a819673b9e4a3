"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(key: Column, seed: int = 0) -> Column:
    """A repeatable pseudo-random number below 2^32 for an integer key, the same in any SQL engine."""
    return F.pmod((key.cast("long") + seed) * F.lit(2654435761), F.lit(4294967296))


def hash_uniform(key: Column, seed: int = 0) -> Column:
    """hash_order as a number in [0, 1)."""
    return hash_order(key, seed) / F.lit(4294967296.0)


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))
