"""Statistics per dimension, episode and clip (survey rows A1-A21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dimensions(vectors: DataFrame, vector: str) -> DataFrame:
    """One row per component: vectors' columns, dim and x as double."""
    return vectors.select("*", F.posexplode(vector).alias("dim", "raw")).withColumn("x", F.col("raw").cast("double")).drop("raw")


def dataset_statistics(rows: DataFrame) -> DataFrame:
    """A1-A3 by dim: mean, both deviations, range and exact 1 % and 99 % quantiles, by linear interpolation."""
    moments = rows.groupBy("dim").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.stddev_samp("x").alias("std_samp"), F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"))
    return moments.join(exact_quantiles(rows, {"q01": 0.01, "q99": 0.99}), "dim", "left").select("dim", "mean", "std", "std_samp", "low", "high", "q01", "q99", "n")


def exact_quantiles(rows: DataFrame, shares: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """By dim one column for each share: the exact quantile, interpolated between the two order statistics around it.

    A sketch brackets every quantile by values whose ranks lie a few parts in `accuracy` away; a second pass counts what
    is below a bracket and the different values within it, and finds the first one above. Only these few are put in order.
    """
    x, names, gap = F.col("x"), list(shares), 3 / accuracy
    rows = rows.where("x is not null")
    ends = [min(1.0, max(0.0, q + side * gap)) for q in shares.values() for side in (-1, 1)]
    found = rows.groupBy("dim").agg(F.count("x").alias("n"), F.percentile_approx("x", ends, accuracy).alias("ends"))
    brackets = found.select("dim", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.struct(F.get("ends", 2 * i).alias("low"), F.get("ends", 2 * i + 1).alias("high")))).alias("i", "b"))
    share = F.element_at(F.array(*[F.lit(float(q)) for q in shares.values()]), F.col("i") + 1)
    rank = (F.col("n") - 1) * share
    brackets = brackets.select("dim", "i", "b.low", "b.high", rank.alias("rank"))
    kind = F.when(x < F.col("low"), 0).when(x > F.col("high"), 2).otherwise(1)
    sided = rows.select("dim", "x").join(F.broadcast(brackets), "dim").withColumn("kind", kind)  # a few brackets for each dimension
    counts = sided.groupBy("dim", "i", "rank", "kind", F.when(F.col("kind") == 1, x).alias("value")).agg(F.count(F.lit(1)).alias("size"), F.min("x").alias("x"))
    upto = F.sum("size").over(Window.partitionBy("dim", "i").orderBy("kind", "value"))
    at = lambda r: F.min(F.when(F.col("upto") > r, x))
    floor = F.floor("rank")
    both = counts.withColumn("upto", upto).groupBy("dim", "i", "rank").agg(at(floor).alias("a"), at(F.ceil("rank")).alias("b"))
    value = F.col("a") + (F.coalesce("b", "a") - F.col("a")) * (F.col("rank") - floor)
    return both.groupBy("dim").agg(*[F.max(F.when(F.col("i") == k, value)).alias(name) for k, name in enumerate(names)])


def nonzero_std(rows: DataFrame, key: str, value: str, eps: float = 1e-8) -> DataFrame:
    """A5: the deviation that counts zeros as missing for the squares only."""
    z = F.when(F.abs(value) > eps, F.col(value)).otherwise(0.0)
    nz = F.greatest(F.count_if(F.abs(value) > eps), F.lit(1))
    n = F.count(F.lit(1))
    return rows.groupBy(key).agg(F.sqrt(F.greatest(F.sum(z * z) / nz - F.pow(F.sum(z) / n, F.lit(2)) * n / nz, F.lit(0.0))).alias("std"))


def padded_statistics(frames: DataFrame, value: str, least: float = 1e-2) -> DataFrame:
    """Mean and deviation as if every episode were padded to the longest with its last row."""
    size = F.count(F.lit(1)).over(Window.partitionBy("ep"))
    top = frames.groupBy("ep").count().agg(F.max("count").alias("top"))
    weighted = frames.withColumn("size", size).join(F.broadcast(top)).withColumn("w", F.when(F.col("idx") == F.col("size") - 1, 1 + F.col("top") - F.col("size")).otherwise(1).cast("double"))
    x = F.col(value)
    total, first, second = F.sum("w"), F.sum(F.col("w") * x), F.sum(F.col("w") * x * x)
    return weighted.agg(total.alias("n"), (first / total).alias("mean"), F.greatest(F.sqrt((second - first * first / total) / (total - 1)), F.lit(least)).alias("std"))


def pooled_statistics(parts: DataFrame) -> DataFrame:
    """Mean and deviation over datasets from each one's n, mean and std."""
    n = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / n
    var = F.sum((F.col("n") - 1) * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / n - mean * mean
    return parts.agg(mean.alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"), n.alias("n"))


def displacement(frames: DataFrame, value: str) -> DataFrame:
    """A10: per episode the largest distance from frame 0, and whether it moved."""
    base = F.first(value).over(Window.partitionBy("ep").orderBy("idx"))
    return frames.withColumn("moved", F.abs(F.col(value) - base)).groupBy("ep").agg(F.max("moved").alias("max_moved"), F.bool_or(F.col("moved") > 1e-5).alias("moving"))


def contiguous_prefix(rows: DataFrame, key: str, number: str) -> DataFrame:
    """How far the distinct numbers of a key run from 0 without a hole, and whether holes follow."""
    seen = rows.select(key, number).distinct().withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(number)) - 1)
    return seen.groupBy(key).agg(F.count_if(F.col(number) == F.col("nth")).alias("prefix"), (F.count_if(F.col(number) != F.col("nth")) > 0).alias("holes"))


def running_success(trials: DataFrame, key: str, order: str, success: str) -> DataFrame:
    """Trials, successes and rate so far."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = F.sum(F.col(success).cast("long")).over(w)
    return trials.withColumn("trials", F.count(F.lit(1)).over(w)).withColumn("successes", hits).withColumn("rate", F.round(F.lit(100.0) * F.col("successes") / F.col("trials"), 1))


def most_frequent(rows: DataFrame, value: str, order: str) -> DataFrame:
    """The value that occurs most, the earliest on ties."""
    return rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first").limit(1).select(value, "n")


def histogram_quantiles(rows: DataFrame, share: float, bins: int = 5000) -> DataFrame:
    """A4 by dim: the lower edge of the first of `bins` even bins up to which `share` of the values lie.

    Only counts per bin are shuffled and put in order, never the values.
    """
    ends = rows.groupBy("dim").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("n"))
    wide = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(1.0)
    at = F.least(F.floor((F.col("x") - F.col("low")) / wide * bins), F.lit(bins - 1))
    counts = rows.join(ends, "dim").groupBy("dim", "low", "high", "n", at.alias("bin")).agg(F.count("x").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("dim").orderBy("bin"))
    reached = counts.withColumn("upto", upto).where(F.col("upto") >= F.col("n") * share)
    return reached.groupBy("dim").agg(F.min(F.col("low") + F.col("bin") * wide / bins).alias("quantile"))


def widened_bounds(rows: DataFrame, margin: float = 1e-4) -> DataFrame:
    """A7 by dim: the range, `margin` wider on both sides."""
    return rows.groupBy("dim").agg((F.min("x") - margin).alias("low"), (F.max("x") + margin).alias("high"))


def bucket_statistics(rows: DataFrame, path: str, value: Column, keywords: dict[str, str], other: str) -> DataFrame:
    """Count, mean and deviation by the first keyword that the path holds."""
    bucket = F.lit(other)
    for word, name in reversed(keywords.items()):
        bucket = F.when(F.col(path).contains(word), name).otherwise(bucket)
    return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def episode_statistics(frames: DataFrame, value: str) -> DataFrame:
    """Mean, deviation and root of the mean square by episode."""
    x = F.col(value)
    return frames.groupBy("ep").agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.sqrt(F.avg(x * x)).alias("rms"))


def most_moving(frames: DataFrame, value: str) -> DataFrame:
    """The episode of the widest range, the first on ties."""
    return frames.groupBy("ep").agg((F.max(value) - F.min(value)).alias("motion")).orderBy(F.desc("motion"), "ep").limit(1)


def point_counts(points: DataFrame, *keys: str) -> DataFrame:
    """A12."""
    return points.groupBy(*keys).agg(F.count(F.lit(1)).alias("points"))


def distinct_names(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The sorted different names of each key, and its rows."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_set(name)).alias("names"), F.count(F.lit(1)).alias("points"))


def manifest(clips: DataFrame, split: str, episode: str, complete: Column) -> DataFrame:
    """Clips, different episodes and complete clips of every split."""
    return clips.groupBy(F.col(split).alias("split")).agg(F.count(F.lit(1)).alias("clips"), F.countDistinct(episode).alias("episodes"), F.count_if(complete).alias("complete"))


def plan_totals(episodes: DataFrame, task: str, pending: Column) -> DataFrame:
    """Tasks, episodes and those still to do."""
    return episodes.agg(F.countDistinct(task).alias("tasks"), F.count(F.lit(1)).alias("episodes"), F.count_if(pending).alias("pending"))


def mean_of_fields(rows: DataFrame, key: str, fields: dict[str, Column]) -> DataFrame:
    """The mean of each field by key; rows without a field don't count for it."""
    return rows.groupBy(key).agg(*[F.avg(c).alias(name) for name, c in fields.items()])


def zscores(rows: DataFrame, statistics: DataFrame) -> DataFrame:
    """rows (dim, x) with the columns of statistics, one row per dimension, which is small."""
    return rows.join(F.broadcast(statistics), "dim")
