"""Splits, samples and allocations (survey rows T1-T20)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import row_ranks, running_sum

#: Rows that may be sent to every executor.
BROADCAST_ROWS = 50_000


def even_positions(n: Column, k: int) -> Column:
    """K positions spread evenly over 0..n-1, truncated; all of them if n <= k."""
    step = (n - 1) / F.lit(float(max(k - 1, 1)))
    spread = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == k - 1, n - 1).otherwise(F.floor(i * step)).cast("long")) if k > 1 else F.array(F.lit(0).cast("long"))
    return F.when(n <= 0, F.array().cast("array<bigint>")).when(n <= k, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(spread)


def even_place(nth: Column, n: Column, k: int) -> Column:
    """The place of position nth in even_positions(n, k), null if it isn't among them; by arithmetic, without the list."""
    step = (n - 1) / F.lit(float(max(k - 1, 1)))
    near = F.floor(nth / F.greatest(step, F.lit(1.0)))
    found = F.when(nth == n - 1, F.lit(k - 1)) if k > 1 else F.when(nth == 0, F.lit(0))
    for i in (near - 1, near, near + 1) if k > 1 else ():
        found = found.when((i >= 0) & (i < k - 1) & (F.floor(i * step) == nth), i)
    return F.when(n <= k, nth).otherwise(found).cast("long")


def split_episodes(episodes: DataFrame, key: str, share: float, order: Column) -> DataFrame:
    """Episodes plus is_test; the ceil(share * n) last in `order`, a number, are the test split."""
    ranked = row_ranks(episodes.withColumn("_order", order), ["_order", key])
    return ranked.withColumn("is_test", F.col("rank") > F.col("total") - F.ceil(F.col("total") * share)).drop("_order", "rank", "total")


def floor_split(episodes: DataFrame, key: str, share: float = 0.8) -> DataFrame:
    """The first floor(share * n) episodes by key, a number, train."""
    return row_ranks(episodes, [key]).withColumn("is_train", F.col("rank") <= F.floor(F.col("total") * share)).drop("rank", "total")


def shuffled_split(episodes: DataFrame, key: str, share: float, order: Column) -> DataFrame:
    """The last int(share * n) in a shuffled order validate. With none of them all episodes train, where a slice that
    ends before the last 0 would leave nothing."""
    ranked = row_ranks(episodes.withColumn("_order", order), ["_order", key])
    return ranked.withColumn("is_val", F.col("rank") > F.col("total") - F.floor(F.col("total") * share)).drop("_order", "rank", "total")


def downsample(episodes: DataFrame, key: str, mask: Column, size: int, order: Column) -> DataFrame:
    """Plus `kept`: the mask cut down to its `size` rows of the smallest order."""
    best = episodes.where(mask).withColumn("_order", order).orderBy("_order", key).limit(size).select(key, F.lit(True).alias("kept"))
    best = F.broadcast(best) if size <= BROADCAST_ROWS else best
    return episodes.join(best, key, "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def last_episode(episodes: DataFrame, key: str) -> DataFrame:
    """Plus is_val, true for the last episode."""
    top = episodes.agg(F.max(key).alias("top"))
    return episodes.join(F.broadcast(top)).withColumn("is_val", F.col(key) == F.col("top")).drop("top")


def shuffled_head(rows: DataFrame, order: Column, key: str, size: int) -> DataFrame:
    """The first `size` rows of a shuffled order, for a cached validation set."""
    return rows.withColumn("_order", order).orderBy("_order", key).limit(size).drop("_order")


def by_length(lengths: DataFrame, draws: DataFrame, bucket: int = 1024) -> DataFrame:
    """(draw, ep, start): draws (draw, uniform) fall on episodes in proportion to their length; start is the frame hit."""
    placed = running_sum(lengths, ["ep"], F.col("n"), "end").withColumn("begin", F.col("end") - F.col("n"))
    total = lengths.agg(F.sum("n").alias("total"))
    at = draws.join(F.broadcast(total)).withColumn("position", F.least(F.floor(F.col("uniform") * F.col("total")), F.col("total") - 1)).withColumn("bucket", F.floor(F.col("position") / bucket))
    listed = placed.select("ep", "begin", "end", F.explode(F.sequence(F.floor(F.col("begin") / bucket), F.floor((F.col("end") - 1) / bucket))).alias("bucket"))
    return at.join(listed, "bucket").where("position >= begin and position < end").select("draw", "ep", (F.col("position") - F.col("begin")).alias("start"))


def weighted_source(draws: DataFrame, weights: dict[str, float], uniform: Column) -> DataFrame:
    """For every draw the source into whose share of the running weights its uniform number falls."""
    total, upto, chosen = sum(weights.values()), sum(weights.values()), F.lit(list(weights)[-1])
    for name in reversed(list(weights)):
        chosen = F.when(uniform < upto / total, F.lit(name)).otherwise(chosen) if upto < total else F.lit(name)
        upto -= weights[name]
    return draws.withColumn("source", chosen)


def top_k(rows: DataFrame, key: str, score: str, order: str, k: int, largest: bool = True) -> DataFrame:
    """T4 over a finished table: the k best of each key, the earlier of equals."""
    best = F.col(score).desc() if largest else F.col(score).asc()
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(best, order))).where(F.col("rank") <= k)


def assign_greedy(tasks: DataFrame, task: str, size: str, bins: int) -> DataFrame:
    """(task, size, bin): the largest task first, by name on ties, to the least loaded bin, the first on ties.

    A sequential rule, so the tasks, a short list, are folded in one row.
    """
    items = F.sort_array(F.collect_list(F.struct((-F.col(size)).cast("double").alias("less"), F.col(task).alias("name"))))
    empty = F.struct(F.array_repeat(F.lit(0.0), bins).alias("load"), F.array().cast("array<int>").alias("to"))

    def place(state: Column, item: Column) -> Column:
        at = F.array_position(state.load, F.array_min(state.load)).cast("int")
        return F.struct(F.transform(state.load, lambda x, i: F.when(i == at - 1, x - item.less).otherwise(x)).alias("load"), F.concat(state.to, F.array(at - 1)).alias("to"))

    folded = tasks.agg(items.alias("items")).select("items", F.aggregate("items", empty, place, lambda s: s.to).alias("to"))
    return folded.select(F.explode(F.arrays_zip("items", "to")).alias("x")).select(F.col("x.items.name").alias(task), (-F.col("x.items.less")).alias(size), F.col("x.to").alias("bin"))


def deal_batches(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """N chunks of nearly equal size, larger ones first; the first order column is a number."""
    k, size, more = F.col("rank") - 1, F.floor(F.col("total") / n), F.col("total") % n
    large = more * (size + 1)
    batch = F.when(k < large, F.floor(k / (size + 1))).otherwise(more + F.floor((k - large) / F.greatest(size, F.lit(1))))
    return row_ranks(rows, list(order)).withColumn("batch", batch.cast("long")).drop("rank", "total")


def split_lists(rows: DataFrame, split: str, key: str, keep: int) -> DataFrame:
    """T5: the first `keep` keys of every split in order, as a list."""
    nth = F.row_number().over(Window.partitionBy(split).orderBy(key))
    return rows.select(split, key).distinct().withColumn("nth", nth).where(F.col("nth") <= keep).groupBy(split).agg(F.sort_array(F.collect_list(key)).alias("keys"))


def closest_axis(vectors: DataFrame, key: str, vector: Column, target: Column) -> DataFrame:
    """The row of each key whose vector has the largest inner product with the target; the first row on ties is the smallest `pos`."""
    product = F.aggregate(F.zip_with(vector, target, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = vectors.withColumn("product", product)
    best = scored.groupBy(key).agg(F.max_by(F.struct("pos", "product"), F.struct("product", -F.col("pos"))).alias("b"))
    return best.select(key, "b.pos", "b.product")


def modality_batches(rows: DataFrame, size: int, ranks: int, order: Column) -> DataFrame:
    """(batch, rank, id, modality, length): batches of one modality each, dealt over ranks by length.

    rows: id, modality, length. Each modality is shuffled by `order`, a number, and cut into batches of `size`; the last
    one is filled up with rows of the modality's first batch. Within a batch the longest rows come first and go to the
    rank of the least total length that has room for more, the first on ties. Batches are numbered in the order of
    md5(modality:batch); the one with the longest row gets number 0, in exchange with the one that had it. size must be
    a multiple of ranks.
    """
    if size % ranks:
        raise ValueError("a batch must divide evenly over the ranks")
    shuffled = running_sum(rows.withColumn("_order", order), ["_order", "id"], F.lit(1).cast("long"), "_all", by=("modality",))
    counts = rows.groupBy("modality").agg(F.count(F.lit(1)).alias("n"))
    numbered = shuffled.withColumn("nth", F.col("_all") - 1).join(F.broadcast(counts), "modality").withColumn("own", F.floor(F.col("nth") / size).cast("long"))
    last = F.floor((F.col("n") - 1) / size).cast("long")
    missing = (last + 1) * size - F.col("n")
    fill = numbered.where((F.col("own") == 0) & (F.col("nth") < missing) & (last > 0)).withColumn("own", last).withColumn("nth", F.col("nth") + F.col("n"))
    full = numbered.unionByName(fill).select("modality", "own", "id", "length", "nth")
    dealt = full.groupBy("modality", "own").agg(F.sort_array(F.collect_list(F.struct((-F.col("length")).alias("less"), "nth", "id"))).alias("items"), F.max("length").alias("longest"))
    empty = F.struct(F.transform(F.sequence(F.lit(1), F.lit(ranks)), lambda i: F.lit(0).cast("long")).alias("load"), F.transform(F.sequence(F.lit(1), F.lit(ranks)), lambda i: F.lit(0)).alias("held"), F.array().cast("array<int>").alias("to"))

    def place(state: Column, item: Column) -> Column:
        room = F.transform(state.load, lambda load, i: F.when(F.get(state.held, i) < size // ranks, load).otherwise(F.lit(2**62)))
        at = F.array_position(room, F.array_min(room)).cast("int")
        put = lambda a, more: F.transform(a, lambda x, i: F.when(i == at - 1, x + more).otherwise(x))
        return F.struct(put(state.load, -item.less).alias("load"), put(state.held, F.lit(1)).alias("held"), F.concat(state.to, F.array(at - 1)).alias("to"))

    placed = dealt.withColumn("to", F.aggregate("items", empty, place, lambda s: s.to))
    key = F.conv(F.substring(F.md5(F.concat(F.col("modality").cast("string"), F.lit(":"), F.col("own").cast("string"))), 1, 12), 16, 10).cast("long")
    batches = running_sum(placed.withColumn("key", key), ["key", "modality", "own"], F.lit(1).cast("long"), "number").withColumn("number", F.col("number") - 1)
    longest = batches.orderBy(F.desc("longest"), "number").limit(1).select(F.col("number").alias("top"))
    batch = F.when(F.col("number") == F.col("top"), F.lit(0).cast("long")).when(F.col("number") == 0, F.col("top")).otherwise(F.col("number"))
    rows = batches.join(F.broadcast(longest)).select(batch.alias("batch"), "modality", F.explode(F.arrays_zip("to", "items")).alias("x"))
    return rows.select("batch", F.col("x.to").alias("rank"), F.col("x.items.id").alias("id"), "modality", (-F.col("x.items.less")).alias("length"))


def farthest_points(points: DataFrame, key: str, k: int) -> DataFrame:
    """(key, nth, id, x, y, z): k points of each cloud (key, id, x, y, z), each the farthest from those before; the
    point of the smallest id is the first, ties go to the smaller id. A cloud of fewer points is filled up with zeros, id
    null. A cloud is one task, as each step needs all its points."""

    def sample(cloud: pd.DataFrame) -> pd.DataFrame:
        cloud = cloud.sort_values("id")
        xyz = cloud[["x", "y", "z"]].to_numpy(float)
        chosen, far, at = [], np.full(len(xyz), np.inf), 0
        for _ in range(min(k, len(xyz))):
            chosen.append(at)
            far = np.minimum(far, ((xyz - xyz[at]) ** 2).sum(axis=1))
            far[chosen] = -1
            at = int(far.argmax())
        short = k - len(chosen)
        return pd.DataFrame({
            key: cloud[key].iloc[0], "nth": range(k), "id": pd.array([*cloud["id"].to_numpy()[chosen], *[None] * short], "Int64"),
            **{c: [*xyz[chosen, j], *[0.0] * short] for j, c in enumerate("xyz")},
        })

    return points.select(key, "id", "x", "y", "z").groupBy(key).applyInPandas(sample, f"{key} {points.schema[key].dataType.simpleString()}, nth long, id long, x double, y double, z double")


def budgeted_sample(rows: DataFrame, group: str, is_robot: str, order: str, k: int) -> DataFrame:
    """K rows of each group, evenly spread; robots get a quarter at most unless the other rows don't fill the rest."""
    n = rows.groupBy(group).agg(F.count_if(is_robot).alias("robots"), F.count_if(~F.col(is_robot)).alias("others"))
    first = F.least("robots", F.lit(max(1, k // 4)))
    others = F.least("others", k - first)
    plan = n.select(group, "robots", "others", F.least("robots", k - others).alias("robot_budget"), others.alias("other_budget"))
    numbered = rows.withColumn("nth", F.row_number().over(Window.partitionBy(group, is_robot).orderBy(order)) - 1).join(plan, group)
    size, budget = (F.when(F.col(is_robot), F.col(a)).otherwise(F.col(b)) for a, b in (("robots", "others"), ("robot_budget", "other_budget")))
    # nth is the i-th of `budget` even positions floor(i * step) if the i next to nth / step gives it; the last one is size - 1
    step, nth = (size - 1) / F.greatest(budget - 1, F.lit(1)), F.col("nth")
    near = F.floor(nth / F.greatest(step, F.lit(1.0)))
    hit = F.lit(False)
    for i in (near - 1, near, near + 1):
        hit = hit | ((i >= 0) & (i < budget - 1) & (F.floor(i * step) == nth))
    chosen = F.when(budget <= 0, False).when(budget == 1, nth == 0).when(budget >= size, True).otherwise((nth == size - 1) | hit)
    return numbered.where(chosen).select(*rows.columns)


def effective_length(sources: DataFrame, size: str, weight: str) -> DataFrame:
    """The share of each source when weights multiply sizes, and the length after which each primary one (weight 1) is through."""
    part = F.col(size) * F.col(weight)
    total = sources.agg(F.sum(part).alias("total"), F.max(F.when(F.col(weight) == 1, F.col(size) / part)).alias("rounds"))
    return sources.join(F.broadcast(total)).withColumn("share", part / F.col("total")).withColumn("length", F.floor(F.col("rounds") * F.col("total"))).drop("total", "rounds")


def epoch_draws(sources: DataFrame, size: str = "size", weight: str = "weight", primary: str = "primary", name: str = "source", step: float = 0.6180339887498949) -> DataFrame:
    """(draw, source, nth): draws from 0 until every primary source is through once; nth counts a source's own draws from 0.

    sources: name, size, weight, primary. A source's share of the draws is size * weight over the sum of those. Draw i
    falls where the fraction of i * step lies in the running shares (sources by name). The step spreads draws evenly, so
    that no stretch lacks a source for long. The sources, a short list, come to the driver; without a primary source
    there are no draws.
    """
    listed = [(r[0], int(r[1]), r[1] * r[2], bool(r[3])) for r in sources.select(name, size, weight, primary).orderBy(name).collect() if r[1] and r[2]]
    spark, total = sources.sparkSession, sum(s[2] for s in listed)
    needed = max([-(-n * total // share) for _, n, share, first in listed if first], default=0)
    chosen, upto = F.lit(listed[-1][0]) if listed else F.lit(None).cast("string"), total
    for source, _, share, _ in reversed(listed):
        chosen = F.when(F.col("uniform") < upto / total, F.lit(source)).otherwise(chosen)
        upto -= share
    while True:
        draws = spark.range(int(needed)).select(F.col("id").alias("draw"), F.pmod(F.col("id") * F.lit(step), F.lit(1.0)).alias("uniform")).select("draw", chosen.alias(name))
        numbered = running_sum(draws, ["draw"], F.lit(1).cast("long"), "nth", by=(name,)).withColumn("nth", F.col("nth") - 1)
        through = {r[0]: r[1] for r in draws.groupBy(name).count().collect()}
        if all(through.get(source, 0) >= n for source, n, _, first in listed if first):
            break
        needed = needed * 1.1 + 10
    ends = F.lit(False)
    for source, n, _, first in listed:
        if first:
            ends = ends | ((F.col(name) == source) & (F.col("nth") == n - 1))
    last = numbered.where(ends).agg(F.max("draw")).first()[0]
    return numbered.where(F.col("draw") <= (-1 if last is None else last)).select("draw", name, "nth")


def interleave(rows: DataFrame, draws: DataFrame, name: str, order: list[str]) -> DataFrame:
    """The rows of all sources in the order of draws (draw, source, nth): draw, epoch, and the columns of rows.

    A source's rows stand in `order` (a number first); its nth draw takes the row nth modulo its size, so that a source
    that is used up begins again. Positions come from running sums in ranges and the rows by an equi join on (source,
    position): no buffer holds a source. Rows of a null source take no part.
    """
    placed = running_sum(rows.where(F.col(name).isNotNull()), order, F.lit(1).cast("long"), "_place", by=(name,)).withColumn("_place", F.col("_place") - 1)
    sizes = rows.groupBy(name).agg(F.count(F.lit(1)).alias("_size"))
    due = draws.join(F.broadcast(sizes), name).withColumns({"_place": F.col("nth") % F.col("_size"), "epoch": F.floor(F.col("nth") / F.col("_size")).cast("long")})
    return due.select("draw", "epoch", name, "_place").join(placed, [name, "_place"]).drop("_place")


def apportion(sources: DataFrame, n: int, weight: str = "weight", order: str = "pos") -> DataFrame:
    """Sources plus `share`: n dealt out in whole numbers by weight, at least 1 to each weight above 0.

    Weights whose part of what is left would be below 1 get 1 and leave the rest to the others, which makes further ones
    fall below, until none does. In ascending order those are a beginning of the list, which ends at the first weight
    whose part of the rest is 1 or more; running sums find it. The others get the whole of their part, and what remains
    goes to the largest fractions, the later in `order` (a number, different in every row) on ties. A weight of 0 gets
    none of it. Fewer than the weights above 0, or a negative weight, is an error.
    """
    counted = sources.agg(F.count(F.when(F.col(weight) > 0, 1)).alias("n"), F.sum(weight).alias("total"), F.min(weight).alias("low")).first()
    if counted.n > n or (counted.low or 0) < 0:
        raise ValueError("weights must not be negative, nor more than what is to be dealt")
    if not counted.n:
        return sources.withColumn("share", F.lit(0).cast("long"))
    positive = row_ranks(running_sum(sources.where(F.col(weight) > 0).select(order, weight), [weight, order], F.col(weight).cast("double"), "_upto"), [weight, order])
    before, place = F.col("_upto") - F.col(weight), F.col("rank") - 1
    first = positive.where(F.col(weight) * (n - place) >= F.lit(float(counted.total)) - before).agg(F.min("rank").alias("rank")).first().rank or counted.n + 1
    fixed = positive.where(F.col("rank") < first).select(order, F.lit(1).cast("long").alias("share"))
    rest = positive.where(F.col("rank") >= first)
    left, weights = n - (first - 1), rest.agg(F.sum(weight)).first()[0] or 1.0
    part = F.col(weight) / F.lit(float(weights)) * left
    parts = rest.select(order, F.floor(part).cast("long").alias("_whole"), (F.floor(part) - part).alias("_less"), (-F.col(order)).alias("_later"))
    remaining = left - (parts.agg(F.sum("_whole")).first()[0] or 0)
    dealt = row_ranks(parts, ["_less", "_later"]).select(order, (F.col("_whole") + (F.col("rank") <= remaining).cast("long")).alias("share"))
    return sources.join(fixed.unionByName(dealt), order, "left").withColumn("share", F.coalesce("share", F.lit(0).cast("long")))
