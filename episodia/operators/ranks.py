"""Ranks and running sums over a whole table, without a window that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def running_sum(rows: DataFrame, order: list[str], value: Column, name: str, parts: int = 64, by: tuple[str, ...] = ()) -> DataFrame:
    """rows plus the sum of `value` up to and with each row in ascending order, of all rows or by key.

    order[0] must be a number or a text, the order total, and keys not null. Approximate quantiles of order[0] (of texts,
    those of some 4,000 sampled by hash) cut the table into about `parts` ranges; each is summed up by itself and starts from the sum of those before, which is one number for
    each range and key. Any cuts give the same result, and a key that holds most of the rows is many tasks.
    """
    kind = rows.schema[order[0]].dataType
    cuts = _text_cuts(rows, order[0], parts) if isinstance(kind, StringType) else _number_cuts(rows, order[0], parts)
    bounds = F.array(*[F.lit(c) for c in cuts]) if cuts else F.array().cast(ArrayType(kind))
    ranged = rows.withColumn("_range", F.size(F.filter(bounds, lambda b: b < F.col(order[0])))).withColumn("_value", value)
    sums = ranged.groupBy(*by, "_range").agg(F.sum("_value").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*(by or (F.lit(0),))).orderBy("_range")) - F.col("_sum")  # a row for each range
    sums = sums.select(*by, "_range", before.alias("_before"))
    within = F.sum("_value").over(Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = ranged.join(sums if by else F.broadcast(sums), [*by, "_range"])
    return joined.withColumn(name, F.col("_before") + within).drop("_range", "_value", "_before")


def _number_cuts(rows: DataFrame, column: str, parts: int) -> list[float]:
    shares = [k / parts for k in range(1, parts)]
    return sorted(set(rows.agg(F.percentile_approx(column, shares, 10_000).alias("cuts")).first().cuts or []))


def _text_cuts(rows: DataFrame, column: str, parts: int, sample: int = 4096) -> list[str]:
    n = rows.count()
    drawn = rows.select(column)
    if n > sample:
        drawn = drawn.where(F.xxhash64(column).bitwiseAND(F.lit((1 << 63) - 1)) < F.lit(int(sample / n * (1 << 63))))
    drawn = drawn.distinct().limit(4 * sample)
    found = sorted(r[0] for r in drawn.collect() if r[0] is not None)
    return sorted({found[len(found) * k // parts] for k in range(1, parts)}) if found else []


def row_ranks(rows: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """rows plus their number from 1 in ascending order, and `total`, the number of all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return running_sum(rows, order, F.lit(1).cast("long"), name).join(F.broadcast(total))
