"""Mergeable histograms whose bins follow the range of the data (survey rows A4, F5)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATE = "n long, mean double, square double, low double, high double, exponent int, first long, counts array<long>"


def exponent_of(low: float, high: float, bins: int) -> int:
    """The smallest e such that bins of width 2^e, laid from 0, cover [low, high] with at most `bins` of them."""
    most = max(abs(low), abs(high))
    if most == 0:
        return -1000
    e = max(-1000, int(np.frexp(most)[1]) - 53)  # numbers have 53 bits
    if high > low:
        e = max(e, int(np.floor(np.log2((high - low) / bins))))
    while np.floor(np.ldexp(high, -e)) - np.floor(np.ldexp(low, -e)) + 1 > bins:
        e += 1
    return e


class RangeHistogram:
    """Counts in bins of width 2^exponent. When the range grows, pairs of bins join, so that no count changes its place."""

    def __init__(self, bins: int) -> None:
        self.bins, self.n, self.mean, self.square = bins, 0, 0.0, 0.0
        self.low, self.high, self.exponent, self.first = np.inf, -np.inf, None, 0
        self.counts = np.zeros(0, np.int64)

    def update(self, values: np.ndarray) -> None:
        """Adds finite values."""
        if not len(values):
            return
        self.low, self.high = min(self.low, float(values.min())), max(self.high, float(values.max()))
        n = self.n + len(values)
        self.mean += (float(values.mean()) - self.mean) * len(values) / n
        self.square += (float((values**2).mean()) - self.square) * len(values) / n
        e = exponent_of(self.low, self.high, self.bins)
        first = int(np.floor(np.ldexp(self.low, -e)))
        counts = np.zeros(int(np.floor(np.ldexp(self.high, -e))) - first + 1, np.int64)
        if self.n:
            np.add.at(counts, (np.arange(self.first, self.first + len(self.counts)) >> (e - self.exponent)) - first, self.counts)
        np.add.at(counts, np.floor(np.ldexp(values, -e)).astype(np.int64) - first, 1)
        self.n, self.exponent, self.first, self.counts = n, e, first, counts

    def state(self) -> tuple:
        return self.n, self.mean, self.square, self.low, self.high, self.exponent, self.first, self.counts


def histogram_states(rows: DataFrame, key: str, value: str, bins: int = 5000) -> DataFrame:
    """A4: (key, STATE): one state for each key of each task, made in one pass over the rows.

    Null, NaN and infinite values don't count. On a stream each micro-batch gives states of its own, which can be merged
    with all others. A task holds `bins` counts for each of its keys.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, RangeHistogram] = {}
        for frame in frames:
            frame = frame[np.isfinite(frame["value"].to_numpy(float))]
            for k, own in frame.groupby("key", sort=False):
                held.setdefault(k, RangeHistogram(bins)).update(own["value"].to_numpy(float))
        names = ["key", *[c.split()[0] for c in STATE.split(", ")]]
        for k, histogram in held.items():
            yield pd.DataFrame([(k, *histogram.state())], columns=names)

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value")).where("key is not null").mapInPandas(count, f"key {kind}, {STATE}").withColumnRenamed("key", key)


def merge_states(states: DataFrame, *keys: str, bins: int = 5000) -> DataFrame:
    """states (keys, STATE) as those of the whole, in any order and grouping with the same counts.

    The joint range gives the exponent, by arithmetic on columns; each state's counts move to it as bin numbers shifted
    to the right. What is shuffled are counts by (key, bin), summed up before.
    """
    n = F.sum("n")
    ranges = states.groupBy(*keys).agg(
        n.alias("n"), (F.sum(F.col("n") * F.col("mean")) / n).alias("mean"), (F.sum(F.col("n") * F.col("square")) / n).alias("square"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.max("exponent").alias("least"),
    )
    wide = lambda e: F.floor(F.col("high") / F.pow(F.lit(2.0), e)) - F.floor(F.col("low") / F.pow(F.lit(2.0), e)) + 1 > bins
    spread = F.when(F.col("high") > F.col("low"), F.floor(F.log2((F.col("high") - F.col("low")) / bins)).cast("int"))
    e = F.greatest(F.col("least"), F.coalesce(spread, F.col("least")))
    ranges = ranges.withColumn("e", e)
    for _ in range(2):  # the logarithm may be short by two, at bins cut by the ends
        ranges = ranges.withColumn("e", F.col("e") + F.when(wide(F.col("e")), 1).otherwise(0))
    grid = ranges.select(*keys, F.col("e").alias("exponent"), F.floor(F.col("low") / F.pow(F.lit(2.0), "e")).cast("long").alias("first"), F.floor(F.col("high") / F.pow(F.lit(2.0), "e")).cast("long").alias("last"), "n", "mean", "square", "low", "high")
    placed = states.select(*keys, F.col("exponent").alias("own"), F.col("first").alias("begin"), F.posexplode("counts").alias("at", "count")).where("count > 0").join(grid.select(*keys, "exponent"), list(keys))
    bin_of = F.expr("shiftright(begin + at, least(exponent - own, 63))")  # beyond 63 a shift begins again at 0
    counts = placed.groupBy(*keys, bin_of.alias("bin")).agg(F.sum("count").alias("count")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("counts"))
    whole = F.transform(F.sequence("first", "last"), lambda b: F.coalesce(F.col("counts")[b], F.lit(0).cast("long")))
    return grid.join(counts, list(keys)).select(*keys, "n", "mean", "square", "low", "high", "exponent", "first", whole.alias("counts"))


def statistics_of(states: DataFrame, *keys: str, shares: Sequence[float] = (0.01, 0.99)) -> DataFrame:
    """A4: (keys, n, mean, std, low, high, width, quantiles): of merged states; fewer than two values are an error.

    A quantile is the lower edge of the bin in which that share of the values is reached, so it is right to a bin's width.
    """
    enough = F.when(F.col("n") >= 2, F.col("n")).otherwise(F.raise_error(F.lit("statistics need two values at least")).cast("long"))
    upto = Window.partitionBy(*keys).orderBy("bin")
    width = F.pow(F.lit(2.0), F.col("exponent"))
    bins = states.select(*keys, "n", width.alias("width"), "first", F.posexplode("counts").alias("at", "count")).withColumn("bin", F.col("first") + F.col("at")).withColumn("upto", F.sum("count").over(upto))
    edge: list[Column] = [F.min(F.when(F.col("upto") >= F.col("n") * F.lit(float(q)), F.col("bin") * F.col("width"))) for q in shares]
    quantiles = bins.groupBy(*keys).agg(F.array(*edge).alias("quantiles"))
    std = F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return states.select(*keys, enough.alias("n"), "mean", std.alias("std"), "low", "high", width.alias("width")).join(quantiles, list(keys))
