"""Long episodes, ranks and quantiles against plain Python; no window that rereads an episode for every row."""

import time
from bisect import bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodia.operators import joins, ranks, sampling, stats, windows

N = 200_000


@pytest.fixture(scope="module")
def long_episode(spark):
    df = spark.range(N).select(F.lit(1).cast("long").alias("ep"), F.col("id").alias("idx"), (F.col("id") * 7919 % 1000 / 1000).alias("v")).cache()
    df.count()
    yield df
    df.unpersist()


CASES = {
    "forward_chunk": lambda f: windows.forward_chunk(f, "v", 5).select(F.sum(F.col("chunk")[4])),
    "future_window": lambda f: windows.future_window(f, "v", 4).select(F.sum(F.col("future")[3])),
    "binarize_gripper": lambda f: windows.binarize_gripper(f, "v").select(F.sum("gripper")),
    "gather_sequences": lambda f: windows.gather_sequences(f, "v", 4, 1, 3).select(F.sum(F.col("values")[3])),
    "forward_grid": lambda f: joins.forward_grid(f, "ep", "idx", "v", 1.0).select(F.sum("value")),
    "aligned_grid": lambda f: joins.aligned_grid(f, "ep", "idx", "v", 1.0, N).select(F.sum("value")),
    "history": lambda f: joins.history(f, f.select("ep", F.col("idx").alias("t0")), "v", 2, 3).select(F.sum("value")),
    "zero_padded_suffix": lambda f: windows.zero_padded_suffix(f, "v", 4).select(F.sum(F.col("actions")[3])),
}


@pytest.mark.parametrize("name", CASES)
def test_a_long_episode_takes_seconds(long_episode, name):
    began = time.perf_counter()
    CASES[name](long_episode).collect()
    assert time.perf_counter() - began < 20


def test_long_windows_are_right(long_episode):
    v = np.arange(N) * 7919 % 1000 / 1000
    chunk = windows.forward_chunk(long_episode, "v", 3).where(f"idx in (0, {N - 2}, {N - 1})").orderBy("idx").collect()
    assert [r.chunk for r in chunk] == [[v[0], v[1], v[2]], [v[-2], v[-1], v[-1]], [v[-1]] * 3]
    decided = np.where(v > 0.95, 1.0, np.where(v < 0.05, 0.0, np.nan))
    want, following = np.empty(N), v[-1]
    for i in range(N - 1, -1, -1):
        following = following if np.isnan(decided[i]) else decided[i]
        want[i] = following
    got = windows.binarize_gripper(long_episode, "v").orderBy("idx").select("gripper").toPandas()["gripper"].to_numpy()
    assert (got == want).all()


def test_null_values_are_not_taken_for_the_end(spark):
    rows = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, 3.0)], "ep long, idx long, v double")
    assert [r.chunk for r in windows.forward_chunk(rows, "v", 2).orderBy("idx").collect()] == [[1.0, None], [None, 3.0], [3.0, 3.0]]
    assert [r.past for r in windows.past_window(rows, "v", 2).orderBy("idx").collect()] == [[1.0, 1.0], [1.0, None], [None, 3.0]]


def test_running_sums_and_ranks(spark):
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 50, 500), np.full(300, 7)])
    rows = [(int(k), i, int(v)) for i, (k, v) in enumerate(zip(keys, rng.integers(0, 9, len(keys)), strict=True))]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    got = {r.i: (r.total_v, r["rank"], r.total) for r in ranks.row_ranks(ranks.running_sum(df, ["k", "i"], F.col("v"), "total_v"), ["k", "i"]).collect()}
    upto, want = 0, {}
    for n, (_, i, v) in enumerate(sorted(rows), 1):
        upto += v
        want[i] = (upto, n, len(rows))
    assert got == want
    assert ranks.row_ranks(df.limit(0), ["k", "i"]).count() == 0
    keyed = {r.i: r.n for r in ranks.running_sum(df.withColumn("odd", F.col("v") % 2), ["k", "i"], F.lit(1), "n", by=("odd",)).collect()}
    seen = {0: 0, 1: 0}
    for _, i, v in sorted(rows):
        seen[v % 2] += 1
        assert keyed[i] == seen[v % 2]


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    columns = {0: rng.normal(size=20_000), 1: np.full(500, 3.0), 2: rng.integers(0, 3, 7000).astype(float), 3: np.array([5.0]), 4: np.array([1.0, 2.0]), 5: rng.lognormal(0, 4, 9000)}
    rows = spark.createDataFrame([(d, float(x)) for d, xs in columns.items() for x in xs] + [(0, None), (9, None)], "dim int, x double")
    shares = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r.dim: [r[n] for n in shares] for r in stats.exact_quantiles(rows, shares).collect()}
    assert got.keys() == columns.keys()
    for d, xs in columns.items():
        assert np.allclose(got[d], [np.quantile(xs, q) for q in shares.values()], rtol=1e-12, atol=1e-12), d
    assert stats.dataset_statistics(rows).where("dim = 9").first().n == 0


def test_history_over_gaps_and_buckets(spark):
    rng = np.random.default_rng(3)
    have = {ep: sorted(rng.choice(2000, 40, replace=False).tolist()) for ep in (1, 2)}
    frames = spark.createDataFrame([(ep, i, float(i)) for ep, own in have.items() for i in own], "ep long, idx long, v double")
    targets = [(ep, int(t)) for ep in have for t in rng.integers(-10, 2100, 60)]
    got = {(r.ep, r.t0, r.h): (r.value, bool(r.valid)) for r in joins.history(frames, spark.createDataFrame(targets, "ep long, t0 long"), "v", 4, 37, bucket=16).collect()}
    for ep, t in targets:
        for h in range(4):
            at = bisect_right(have[ep], t - 37 * h) - 1
            hit = have[ep][max(at, 0)]
            assert got[ep, t, h] == (float(hit), h == 0 or hit == t - 37 * h)


def test_positions_in_closed_form(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 5, 12, 13, 40)], "n long")
    for r in df.select("n", sampling.even_positions(F.col("n"), 12).alias("p")).collect():
        assert r.p == (list(range(r.n)) if r.n <= 12 else [*np.linspace(0, r.n - 1, 12).astype(int)])
    rows = [(g, bool(i % 3 == 0), i) for g, n in ((1, 5), (2, 100), (3, 1000), (4, 13)) for i in range(n)]
    got = {}
    for r in sampling.budgeted_sample(spark.createDataFrame(rows, "g long, robot boolean, i long"), "g", "robot", "i", 12).collect():
        got.setdefault((r.g, r.robot), []).append(r.i)
    for g in (1, 2, 3, 4):
        robots, others = ([i for x, r, i in rows if x == g and r == kind] for kind in (True, False))
        n_others = min(len(others), 12 - min(len(robots), 3))
        n_robots = min(len(robots), 12 - n_others)
        for kind, own, k in ((True, robots, n_robots), (False, others, n_others)):
            want = [own[j] for j in sorted(set(np.linspace(0, len(own) - 1, k).astype(int).tolist()))] if k > 1 else own[:k]
            assert sorted(got.get((g, kind), [])) == want


def test_deal_and_global_rows(spark):
    for n in (1, 3, 7, 20):
        got = {r.i: r.batch for r in sampling.deal_batches(spark.range(11).withColumnRenamed("id", "i"), n, "i").collect()}
        want = [b for b, part in enumerate(np.array_split(np.arange(11), n)) for _ in part]
        assert [got[i] for i in range(11)] == want
    sizes = {3: 5, 8: 3000, 9: 1}
    frames = spark.createDataFrame([(e, i) for e, n in sizes.items() for i in range(n)], "ep long, idx long")
    flat = [(e, i) for e, n in sorted(sizes.items()) for i in range(n)]
    got = {r.position: (r.ep, r.start) for r in joins.global_rows(frames, spark.range(-3, 3100).withColumnRenamed("id", "position")).collect()}
    assert got == dict(enumerate(flat))
    draws = spark.createDataFrame([(k, k / 50) for k in range(50)], "draw long, uniform double")
    assert {r.draw: (r.ep, r.start) for r in sampling.by_length(windows.lengths(frames), draws).collect()} == {k: flat[int(k / 50 * len(flat))] for k in range(50)}
