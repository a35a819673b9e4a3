"""Joint trees, histograms, mixtures, files, images and nulls, on literal cases and against plain Python."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodia.functions import geometry, images, normalize
from episodia.operators import filters, histograms, kinematics, ranks, sampling, windows
from episodia.operators.scene import IDENTITY
from episodia.sources import episodes, files, sinks

LINKS = "link string, parent string, joint string, kind string, origin array<double>, axis array<double>"


def shifted(x):
    return [1.0, 0.0, 0.0, x, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def test_chain_of_64_joints(spark):
    n = 64
    links = spark.createDataFrame([(f"l{i}", f"l{i - 1}" if i else "base", f"j{i}", "revolute" if i % 2 else "prismatic", shifted(0.5), [0.0, 0.0, 2.0]) for i in range(n)], LINKS)
    values = spark.createDataFrame([(s, f"j{i}", 0.05 * s) for s in (1, 2) for i in range(n - 1)], "sample int, joint string, value double")
    got = {(r.sample, r.link): np.array(r.pose).reshape(4, 4) for r in kinematics.link_poses(links, values).collect()}
    assert len(got) == 2 * (n + 1)
    for s in (1, 2):
        pose = np.eye(4)
        assert np.allclose(got[s, "base"], pose)
        for i in range(n):
            q = 0.05 * s if i < n - 1 else 0.0  # the last joint has no value
            own = np.eye(4)
            if i % 2:
                own[:2, :2] = [[math.cos(q), -math.sin(q)], [math.sin(q), math.cos(q)]]
            else:
                own[2, 3] = 2 * q
            pose = pose @ np.array(shifted(0.5)).reshape(4, 4) @ own
            assert np.allclose(got[s, f"l{i}"], pose)


def test_bad_trees(spark):
    circle = spark.createDataFrame([("a", "b", "j", "fixed", IDENTITY, [0.0] * 3), ("b", "a", "k", "fixed", IDENTITY, [0.0] * 3)], LINKS)
    with pytest.raises(ValueError, match="circle"):
        kinematics.ancestors(circle)
    twice = spark.createDataFrame([("a", "b", "j", "fixed", IDENTITY, [0.0] * 3), ("a", "c", "k", "fixed", IDENTITY, [0.0] * 3)], LINKS)
    with pytest.raises(ValueError, match="two joints"):
        kinematics.ancestors(twice)


@pytest.mark.parametrize("seed", range(4))
def test_histograms_merge_in_any_order(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(size=500) * 10.0**seed, rng.normal(size=300) + 1e3 * seed, [0.0] * 5])
    parts = np.array_split(rng.permutation(values), 7)
    made = []
    for part in parts:
        h = histograms.RangeHistogram(64)
        for piece in np.array_split(part, 5):
            h.update(piece)
        assert len(h.counts) <= 64 and h.counts.sum() == len(part)
        made.append(("k", *h.state()[:-1], h.counts.tolist()))
    states = lambda rows: spark.createDataFrame(rows, f"key string, {histograms.STATE}")
    whole = histograms.merge_states(states(made), "key", bins=64).first()
    first = histograms.merge_states(states(made[4:]), "key", bins=64)
    again = histograms.merge_states(first.unionByName(states(made[:4])), "key", bins=64).first()
    assert whole.counts == again.counts and whole.exponent == again.exponent and sum(whole.counts) == len(values)
    stats = histograms.statistics_of(histograms.merge_states(states(made), "key", bins=64), "key", shares=(0.1, 0.5, 0.99)).first()
    for q, share in zip(stats.quantiles, (0.1, 0.5, 0.99), strict=True):
        exact = np.sort(values)[math.ceil(share * len(values)) - 1]
        assert q <= exact < q + stats.width
    assert stats.mean == pytest.approx(values.mean()) and stats.std == pytest.approx(values.std())


@pytest.mark.parametrize("power", [20, 63, 64, 128, 300])
def test_histograms_of_very_different_sizes(spark, power):
    tiny, large = histograms.RangeHistogram(16), histograms.RangeHistogram(16)
    tiny.update(np.array([1.5, -1.25, 1.75]) * 2.0**-power)
    large.update(np.array([3.0, 100.0]))
    both = histograms.RangeHistogram(16)
    both.update(np.array([1.5, -1.25, 1.75]) * 2.0**-power)
    both.update(np.array([3.0, 100.0]))
    states = [("k", *h.state()[:-1], h.counts.tolist()) for h in (tiny, large)]
    got = histograms.merge_states(spark.createDataFrame(states, f"key string, {histograms.STATE}"), "key", bins=16).first()
    assert (got.exponent, got.first, got.counts) == (both.exponent, both.first, both.counts.tolist()) and sum(got.counts) == 5


def test_histograms_of_awkward_values(spark):
    rows = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", float("inf")), ("a", 3.0), ("a", 3.0), ("b", 1.0), (None, 1.0)], "key string, x double")
    merged = histograms.merge_states(histograms.histogram_states(rows, "key", "x"), "key")
    a = histograms.statistics_of(merged.where("key = 'a'"), "key").first()
    assert (a.n, a.low, a.high) == (2, 3.0, 3.0) and a.quantiles == [3.0, 3.0]
    with pytest.raises(Exception, match="two values"):
        histograms.statistics_of(merged.where("key = 'b'"), "key").collect()


def plain_apportion(weights, n):
    share, left = [0] * len(weights), list(weights)
    while any(w > 0 and w / sum(left) * n < 1 for w in left):
        small = [i for i, w in enumerate(left) if w > 0 and w / sum(left) * n < 1]
        n -= len(small)
        for i in small:
            share[i], left[i] = 1, 0
    total = sum(left)
    part = [w / total * n if total else 0 for w in left]
    for i, p in enumerate(part):
        share[i] += math.floor(p)
    rest = n - sum(math.floor(p) for p in part)
    for i in sorted((i for i, w in enumerate(left) if w > 0), key=lambda i: (part[i] - math.floor(part[i]), i), reverse=True)[:rest]:
        share[i] += 1
    return share


@pytest.mark.parametrize(("weights", "n"), [([5.0, 1.0, 0.1], 8), ([1.0, 1.0, 1.0], 3), ([0.0, 2.0, 1.0], 7), ([100.0, 3.0, 2.0, 1.0, 0.5], 9), ([1.0], 4), ([0.0, 0.0], 4), ([float(x * x) for x in range(1, 40)], 61)])
def test_apportion(spark, weights, n):
    df = spark.createDataFrame(list(enumerate(weights)), "pos long, weight double")
    got = [r.share for r in sampling.apportion(df, n).orderBy("pos").collect()]
    assert got == plain_apportion(weights, n)
    assert sum(got) == (n if any(weights) else 0) and all(s >= 1 for s, w in zip(got, weights, strict=True) if w > 0)


def test_apportion_errors(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 1.0)], "pos long, weight double")
    with pytest.raises(ValueError):
        sampling.apportion(df, 1)
    with pytest.raises(ValueError):
        sampling.apportion(df.withColumn("weight", -F.col("weight")), 5)


def test_interleave_shows_every_primary_row(spark):
    rows = spark.createDataFrame([("a", i) for i in range(30)] + [("b", i) for i in range(7)] + [("c", i) for i in range(50)], "source string, id long")
    sources = spark.createDataFrame([("a", 30, 1.0, True), ("b", 7, 2.0, True), ("c", 50, 0.3, False)], "source string, size long, weight double, primary boolean")
    got = sampling.interleave(rows, sampling.epoch_draws(sources), "source", ["id"]).collect()
    assert sorted(r.draw for r in got) == list(range(len(got)))
    assert {r.id for r in got if r.source == "a"} == set(range(30)) and {r.id for r in got if r.source == "b"} == set(range(7))
    assert all(r.epoch == n // 7 and r.id == n % 7 for n, r in enumerate(sorted((r for r in got if r.source == "b"), key=lambda r: r.draw)))
    none = sampling.epoch_draws(sources.withColumn("primary", F.lit(False)))
    assert none.count() == 0


def test_ranks_of_texts(spark):
    rng = random.Random(5)
    texts = sorted({"".join(rng.choices("abé𐐷", k=rng.randint(0, 5))) for _ in range(600)})
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    assert [r.rank for r in ranks.row_ranks(df, ["t"]).orderBy("t").collect()] == list(range(1, len(texts) + 1))


def test_tar_shards_read_back(spark, tmp_path):
    samples = spark.createDataFrame([(f"{i:03d}.bin", bytes([i]) * (i * 37 % 900)) for i in range(40)] + [("999.bin", None)], "key string, payload binary")
    numbered = sinks.number_shards(samples.withColumn("payload", F.coalesce("payload", F.lit(b""))), ["key"], 3000)
    sinks.write_tar_shards(numbered, str(tmp_path / "tars"), "val")
    members = [(p.name, key, payload) for p in sorted((tmp_path / "tars").iterdir()) for key, payload in sinks.tar_members(p.read_bytes())]
    assert [(k, v) for _, k, v in members] == [(f"{i:03d}.bin", bytes([i]) * (i * 37 % 900)) for i in range(40)] + [("999.bin", b"")]
    assert len({n for n, _, _ in members}) > 3 and all(n.startswith("val-") for n, _, _ in members)


def test_aborted_and_repeated_writes_leave_nothing(spark, tmp_path):
    out = tmp_path / "out"
    bad = spark.range(40).select(F.concat(F.col("id").cast("string"), F.lit(".txt")).alias("name"), F.when(F.col("id") == 39, F.raise_error(F.lit("boom")).cast("binary")).otherwise(F.lit(b"x")).alias("content"))
    with pytest.raises(Exception, match="boom"):
        sinks.write_plain_files(bad.repartition(8), str(out))
    assert not out.exists() or not list(out.iterdir())
    twice = spark.createDataFrame([("a.txt", b"1"), ("a.txt", b"2")], "name string, content binary")
    with pytest.raises(Exception, match="two files"):
        sinks.write_plain_files(twice, str(out))
    assert not out.exists() or not list(out.iterdir())
    sinks.write_plain_files(spark.createDataFrame([("d/a.txt", b"1")], "name string, content binary"), str(out))
    sinks.write_plain_files(spark.createDataFrame([("b.txt", b"2")], "name string, content binary"), str(out), "overwrite")
    assert [p.name for p in out.iterdir()] == ["b.txt"]


def test_point_clouds_read_back(spark, tmp_path):
    rows = [("c", i, i * 0.5, -i * 1.0, 2.0, i % 256) for i in range(5000)] + [("one", 0, 1.0, 2.0, 3.0, 4)]
    points = spark.createDataFrame(rows, "cloud string, nth long, x double, y double, z double, red int")
    sinks.write_point_clouds(points.repartition(6), str(tmp_path / "clouds"), "nth")
    cloud = sinks.read_point_cloud((tmp_path / "clouds/c.ply").read_bytes())
    assert len(cloud) == 5000 and cloud["x"].tolist() == [i * 0.5 for i in range(5000)] and cloud["red"][257] == 1
    assert sinks.read_point_cloud((tmp_path / "clouds/one.ply").read_bytes()).tolist() == [(1.0, 2.0, 3.0, 4)]


def test_files_that_cannot_be_parsed_name_themselves(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{")
    found = files.episode_files(spark, str(tmp_path), "*.json")

    def parse(path, content):
        raise ValueError("no row")
        yield

    with pytest.raises(Exception, match="bad.json: no row"):
        files.parse_files(found, parse, "x long").collect()


@pytest.mark.parametrize(("shape", "item", "target", "longest", "want"), [((1000, 14), 4, 2e6, None, (1000, 14)), ((100_000, 14), 4, 2e6, None, (35715, 14)), ((500, 480, 640, 3), 1, 2e6, None, (3, 480, 640, 3)), ((500, 4, 2000, 2000, 3), 1, 2e6, None, (1, 1, 334, 2000, 3)), ((500, 480, 640, 3), 1, 2e6, 2, (2, 480, 640, 3)), ((7,), 8, 16, None, (2,))])
def test_optimal_chunks(shape, item, target, longest, want):
    assert files.optimal_chunk(shape, item, target, longest) == want


def test_images(spark):
    df = spark.createDataFrame([([float(i) for i in range(6)],)], "p array<double>")
    one = lambda c: df.select(c.alias("c")).first().c
    assert one(images.resize(F.col("p"), 2, 3, 2, 3)) == [0, 1, 2, 3, 4, 5]
    assert one(images.resize(F.col("p"), 2, 3, 1, 1)) == [2.5]
    assert one(images.resize(F.col("p"), 2, 3, 4, 3))[:6] == [0, 1, 2, 0.75, 1.75, 2.75]
    assert one(images.resize_with_pad(F.col("p"), 2, 3, 4, 3, -1.0)) == [-1, -1, -1, 0, 1, 2, 3, 4, 5, -1, -1, -1]
    assert one(images.crop(F.col("p"), 2, 3, 0, 1, 2, 2)) == [1, 2, 4, 5]
    assert one(images.center_crop(F.col("p"), 2, 3, 1.0)) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        images.crop(F.col("p"), 2, 3, 1, 1, 2, 2)


def test_alignment(spark):
    lit = lambda v: tuple(F.lit(float(x)) for x in v)
    turn = lambda a, b, **kw: np.array(spark.range(1).select(geometry.aligning_rotation(lit(a), lit(b), **kw).alias("m")).first().m, float).reshape(3, 3)
    assert np.allclose(turn((0, 0, 2), (3, 0, 0)) @ [0, 0, 1], [1, 0, 0])
    assert np.allclose(turn((1, 2, 3), (2, 4, 6)), np.eye(3)) and np.allclose(turn((1, 0, 0), (-1, 0, 0)), np.eye(3))
    for v in ((1, 0, 0), (0, 1, 0), (1, 2, 3)):
        m = turn(v, [-x for x in v], turn_back=True)
        assert np.allclose(m @ v, [-x for x in v]) and np.allclose(m @ m.T, np.eye(3)) and np.linalg.det(m) == pytest.approx(1)
    frame = np.array([list(r) for r in zip(*[iter(spark.range(1).select(F.array(*[c for row in geometry.facing_frame(lit((0, 0, 1)), lit((1, 0, 0)), lit((0, 0, 1))) for c in row]).alias("m")).first().m)] * 3, strict=True)])
    assert np.allclose(frame[:, 0], np.array([1, 0, -1]) / 2**0.5) and np.allclose(frame @ frame.T, np.eye(3))
    assert np.allclose(spark.range(1).select(*geometry.projection(lit((2, 0, 0)), lit((3, 4, 5)))).first(), [3, 0, 0])
    pose = [list(map(float, r)) for r in ((1, 0, 0, 9), (0, 0, -1, 9), (0, 1, 0, 9))]
    target = [list(map(float, r)) for r in ((1, 0, 0, 1), (0, 1, 0, 2), (0, 0, 1, 3))]
    put = np.array(spark.range(1).select(geometry.placement(tuple(map(lit, pose)), tuple(map(lit, target))).alias("m")).first().m).reshape(3, 4)
    assert np.allclose(put[:, 1], [0, 0, 1]) and np.allclose(put[:, 3], [1, 2, 3])


def test_orbits_and_aligned_placement(spark):
    lit = lambda v: tuple(F.lit(float(x)) for x in v)
    rows = lambda m: tuple(map(lit, m))
    one = lambda c: np.array(spark.range(1).select(c.alias("c")).first().c).reshape(3, 4)
    target, center = rows(((1, 0, 0, 2), (0, 1, 0, 0), (0, 0, 1, 5))), rows(((0, -1, 0, 1), (1, 0, 0, 0), (0, 0, 1, 5)))
    quarter = F.lit(math.pi / 2)
    assert np.allclose(one(geometry.orbit(target, center, lit((0, 0, 1)), quarter)), [[0, -1, 0, 1], [1, 0, 0, 1], [0, 0, 1, 5]])
    assert np.allclose(one(geometry.orbit(target, center, lit((0, 0, 1)), quarter, towards=lit((0, -1, 0))))[:, 3], [1, -1, 5])
    assert np.allclose(one(geometry.orbit(target, center, lit((1, 0, 0)), quarter))[:, 3], [1, 0, 4])  # the center's x is the world's y
    assert np.allclose(one(geometry.orbit(target, center, lit((0, 1, 0)), quarter, frame="world"))[:, 3], [1, 0, 4])
    facing = one(geometry.orbit(target, center, lit((0, 0, 1)), F.lit(math.pi), up=lit((0, 0, 1))))
    assert np.allclose(facing[:, 3], [0, 0, 5]) and np.allclose(facing[:, 0], [1, 0, 0])
    with pytest.raises(ValueError):
        geometry.orbit(target, center, lit((0, 0, 1)), quarter, frame="camera")
    actor = rows(((0.8, 0, 0.6, 9), (-0.6, 0, 0.8, 9), (0, -1, 0, 9)))  # y down, so that upright placement turns it over
    put = one(geometry.aligned_placement(actor, rows(((1, 0, 0, 1), (0, 1, 0, 2), (0, 0, 1, 3))), [lit((1, 0, 0)), lit((0, 1, 0)), lit((-1, 0, 0))], lit((1, 0, 0)), upright=False))
    assert np.allclose(put[:, 2], [0, 0, 1]) and np.allclose(put[:, 3], [1, 2, 3]) and np.allclose(put[:, :3] @ put[:, :3].T, np.eye(3))
    assert any(np.allclose(put[:, 0], a, atol=1e-6) for a in ([1, 0, 0], [0, 1, 0], [-1, 0, 0]))


def test_nulls_keep_their_places(spark):
    f = spark.createDataFrame([(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (1, 3, 4.0)], "ep long, idx long, v double")
    rows = lambda df, c: [r[c] for r in df.orderBy("idx").collect()]
    assert rows(windows.zero_padded_suffix(f, "v", 3), "actions") == [[1, None, 3], [1, None, 3], [None, 3, 4], [3, 4, 0]]
    assert rows(windows.zero_padded_suffix(f, "v", 3), "is_pad")[3] == [False, False, True]
    assert rows(windows.recent(f, "v", 3), "ring") == [[1], [1, None], [1, None, 3], [None, 3, 4]]
    assert rows(windows.step_difference(f, "v"), "delta") == [None, None, 1]
    assert [(r.state, r.action) for r in windows.state_action(f, "v").orderBy("idx").collect()] == [(1, None), (None, 3), (3, 4)]


def test_paths_match_to_the_very_end(spark):
    df = spark.createDataFrame([("a/success/x",), ("a/success/x\n",), ("b",)], "p string")
    assert [r.p for r in filters.matching_paths(df, "p", ".*success/x").collect()] == ["a/success/x"]


def test_tokens_at_the_edges(spark):
    edges = [i * (2.0 / 255) - 1.0 for i in range(255)] + [1.0]
    xs = [e + s for e in edges for s in (-1e-12, 0.0, 1e-12)] + [float(np.nextafter(e, d)) for e in edges for d in (-2, 2)] + [-5.0, 5.0]
    got = [r.t for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double").orderBy("i").select(normalize.action_token(F.col("x")).alias("t")).collect()]
    assert got == [32000 - sum(e <= min(max(x, -1.0), 1.0) for e in edges) for x in xs]


def test_numbered_tasks(spark):
    f = spark.createDataFrame([(e, 0) for e in range(30)], "ep long, idx long")
    tasks = spark.createDataFrame([(e, [f"task {e % 7}"]) for e in range(30)], "ep long, texts array<string>")
    made = episodes.frame_tables(f, tasks)
    assert sorted((r.task, r.task_index) for r in made["tasks"].collect()) == [(f"task {i}", i) for i in range(7)]


def test_poses_of_small_and_large_trees(spark):
    rng = np.random.default_rng(4)
    kinds = ("revolute", "prismatic", "fixed", "continuous")
    rows = [(f"{t}l{i}", f"{t}l{rng.integers(max(0, i - 3), i)}" if i else f"{t}base", f"{t}j{i}", kinds[int(rng.integers(4))], [*rng.normal(size=12).tolist(), 0.0, 0.0, 0.0, 1.0], rng.normal(size=3).tolist()) for t, n in (("a", 1), ("b", 9), ("c", 40)) for i in range(n)]
    links = spark.createDataFrame(rows, LINKS)
    values = spark.createDataFrame([(s, r[2], float(rng.normal())) for s in range(40) for r in rows if rng.random() < 0.7], "sample int, joint string, value double")
    base = Path(spark.conf.get("spark.checkpoint.dir", None) or episodes.scratch_folder(spark, "x").rsplit("/", 1)[0])
    written = lambda: {str(p) for p in base.glob("poses*/*") if p.is_dir()}
    before = written()
    got = {(r.sample, r.link): np.array(r.pose) for r in kinematics.link_poses(links, values).collect()}
    assert written() == before  # small trees leave no table of poses
    halved = {(r.sample, r.link): np.array(r.pose) for r in kinematics.link_poses(links, values, most=8).collect()}
    assert len(written() - before) == 1  # a round's table goes when the next one is there
    assert got.keys() == halved.keys() and len(got) == 40 * (50 + 3)
    assert all(np.allclose(got[k], halved[k], rtol=1e-6) for k in got)
