"""Literal cases of scenes, samples, codecs, nested columns and transforms."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodia.functions import codecs, geometry
from episodia.operators import filters, sampling, scene, statscache, structs, transforms, windows
from episodia.sources import episodes
from episodia.streaming import clips

EYE = np.eye(4).ravel().tolist()


def shifted(x=0.0, y=0.0, z=0.0):
    m = np.eye(4)
    m[:3, 3] = x, y, z
    return m.ravel().tolist()


def one_clip(spark, frames):
    """Three pixels of a bottle, an untracked actor and a robot's link, over the given frames."""
    pixels = spark.createDataFrame([(1, 0, u, float(u), 0.0, -1.0, 0.0, a, *rgb, None, None, None) for u, a, rgb in ((0, 5, (255, 0, 0)), (1, 6, (0, 255, 0)), (2, 99, (0, 0, 255)))], "clip long, v long, u long, x double, y double, z double, w double, actor_id int, r int, g int, b int, nx double, ny double, nz double")
    cameras = spark.createDataFrame([(1, EYE)], "clip long, pose array<double>")
    parts = spark.createDataFrame([(1, 0, 5, "bottle", "bottle", False), (1, 1, 99, "right_link", "arm", True)], "clip long, part_pos long, actor_id int, part_name string, object_name string, is_robot boolean")
    poses = spark.createDataFrame([(1, p, j, shifted(x=float(f)) if p == 0 else shifted(y=0.25 * f)) for p in (0, 1) for j, f in enumerate(frames)], "clip long, part_pos long, t long, pose array<double>")
    return scene.build_clips(pixels, cameras, parts, poses)


def flow_at(made, t):
    return [tuple(round(v, 6) for v in (r.x, r.y, r.z)) for r in made["flows"].where(F.col("t") == t).orderBy("part", "point").collect()]


def test_one_exact_clip(spark):
    made = one_clip(spark, range(15))
    parts = made["parts"].orderBy("part").collect()
    assert [r.part_name for r in parts] == ["bottle", "robot__right_link", "static_actor_6"]
    assert [r.is_robot for r in parts] == [False, True, False] and [r.category for r in parts] == ["task_object", "robot", "static"]
    assert [r["count"] for r in made["points"].groupBy("part").count().orderBy("part").collect()] == [1, 1, 1]
    assert flow_at(made, 14) == [(14, 0, -1), (2, 3.5, -1), (1, 0, -1)]


def test_a_padded_clip_repeats_its_last_frame(spark):
    made = one_clip(spark, [4, 6, 8, 8])
    assert flow_at(made, 3) == flow_at(made, 2) and flow_at(made, 0) == [(0, 0, -1), (2, 0, -1), (1, 0, -1)]
    quaternions = made["trajectories"].select("qx", "qy", "qz", "qw").distinct().collect()
    assert [tuple(round(v, 9) for v in q) for q in quaternions] == [(0, 0, 0, 1)]


def test_objects_keep_their_order_and_dropped_actors_go(spark):
    seen = spark.createDataFrame([(1, a) for a in (3, 4, 7, 8, 9)], "clip long, actor_id int")
    parts = spark.createDataFrame([(1, 0, 9, "z", "z", False), (1, 1, 7, "arm", "r", True), (1, 2, 7, "twice", "r", True), (1, 3, 3, "a", "a", False), (1, 4, -1, "none", "n", False), (1, 5, 8, "gone", "g", False)], "clip long, part_pos long, actor_id int, part_name string, object_name string, is_robot boolean")
    names = [r.part_name for r in scene.clip_parts(seen.where("actor_id <> 8"), parts, drop=[8]).orderBy("part").collect()]
    assert names == ["z", "a", "robot__arm", "static_actor_4"]


def test_pose_literals(spark):
    half = math.sqrt(0.5)
    m = geometry.pose_matrix(tuple(map(F.lit, (1.0, 2.0, 3.0))), tuple(map(F.lit, (half, 0.0, 0.0, half))))
    q = spark.range(1).select(*geometry.matrix_quaternion(tuple(r[:3] for r in m[:3]))).first()
    assert np.allclose(np.abs(q), [0, 0, half, half])
    p = geometry.transform_point([r[:3] for r in m[:3]], tuple(r[3] for r in m[:3]), tuple(map(F.lit, (1.0, 0.0, 0.0))))
    assert np.allclose(spark.range(1).select(*p).first(), [1, 3, 3])


def test_matrix_to_quaternion_in_all_four_cases(spark):
    rng = np.random.default_rng(0)
    for axis in (np.eye(4)[k] for k in range(4)):
        q = axis + rng.normal(0, 0.05, 4)
        q /= np.linalg.norm(q)
        got = np.array(spark.range(1).select(*geometry.matrix_quaternion(geometry.quaternion_matrix(*[F.lit(float(c)) for c in q]))).first())
        assert np.allclose(got * np.sign(got[3] * q[0]), np.roll(q, -1), atol=1e-9)


def test_selected_points_and_normals_go_to_the_world(spark):
    rows = [(1, 0, 0, 0.0, 0.0, -1.0, 0.0, 7), (1, 0, 1, 1.0, 0.0, -1.0, 1.0, 7), (1, 1, 0, 2.0, 0.0, -1.0, 0.0, 7), (1, 1, 1, 3.0, 0.0, -1.0, 0.0, 8), (1, 1, 2, float("nan"), 0.0, -1.0, 0.0, 7)]
    px = spark.createDataFrame([(*r, 0.0, 0.0, 2.0) for r in rows], "clip long, v long, u long, x double, y double, z double, w double, actor_id int, nx double, ny double, nz double")
    got = scene.world_points(px, F.array(*map(F.lit, shifted(x=10.0))), keep=[7]).orderBy("x").collect()
    assert [(r.x, r.y, r.z) for r in got] == [(10, 0, -1), (12, 0, -1)] and [(r.nx, r.ny, r.nz) for r in got] == [(0, 0, 1)] * 2


def test_normals_of_a_plane_face_the_camera(spark):
    rows = [(1, v, u, float(u), float(-v), -5.0, 1.0 if (v, u) == (3, 3) else 0.0, 1 if u < 4 else 2) for v in range(6) for u in range(6)]
    got = {(r.v, r.u): (r.nx, r.ny, r.nz) for r in scene.camera_normals(spark.createDataFrame(rows, "clip long, v long, u long, x double, y double, z double, w double, actor_id int"), "clip").collect()}
    assert got[1, 1] == (0, 0, 1) and got[0, 1] == got[1, 0] == got[5, 5] == (0, 0, 0)
    assert got[3, 3] == got[3, 2] == got[2, 3] == (0, 0, 0) and got[1, 3] == got[1, 4] == (0, 0, 0)


def test_interpolation(spark):
    turn = [(math.sin(a / 2), math.cos(a / 2)) for a in (0.0, 1.0)]
    keys = spark.createDataFrame([(1, float(t), float(10 * t), 0.0, 0.0, 0.0, 0.0, -s, -c) if t else (1, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, s, c) for t, (s, c) in enumerate(turn)], "ep long, t double, x double, y double, z double, qx double, qy double, qz double, qw double")
    got = scene.interpolate(keys, spark.createDataFrame([(1, t) for t in (-1.0, 0.25, 1.0, 5.0)], "ep long, t double")).orderBy("t").collect()
    assert [r.x for r in got] == [0, 2.5, 10, 10]
    assert np.allclose([abs(r.qz) for r in got], [abs(math.sin(a / 2)) for a in (0, 0.25, 1, 1)])


def test_farthest_points(spark):
    rng = np.random.default_rng(5)
    clouds = {1: rng.normal(size=(40, 3)), 2: rng.normal(size=(3, 3))}
    df = spark.createDataFrame([(c, i, *map(float, p)) for c, own in clouds.items() for i, p in enumerate(own)], "c long, id long, x double, y double, z double")
    got = {}
    for r in sampling.farthest_points(df, "c", 8).orderBy("c", "nth").collect():
        got.setdefault(r.c, []).append((r.id, r.x))
    for c, own in clouds.items():
        chosen = [0]
        while len(chosen) < min(8, len(own)):
            far = [min(((own[i] - own[j]) ** 2).sum() for j in chosen) if i not in chosen else -1 for i in range(len(own))]
            chosen.append(int(np.argmax(far)))
        assert [i for i, _ in got[c]] == chosen + [None] * (8 - len(chosen))
    assert [x for i, x in got[2] if i is None] == [0.0] * 5


def test_modality_batches(spark):
    rng = np.random.default_rng(6)
    rows = [(i, "mm" if i % 3 else "text", int(rng.integers(1, 500))) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, modality string, length long")
    got = sampling.modality_batches(df, 8, 2, F.pmod(F.col("id") * 37, F.lit(101)).cast("double")).collect()
    batches = {}
    for r in got:
        batches.setdefault(r.batch, []).append(r)
    assert sorted(batches) == list(range(len(batches))) and {r.id for r in got} == set(range(100))
    assert len(batches) == -(-66 // 8) + -(-34 // 8)
    for own in batches.values():
        assert len(own) == 8 and len({r.modality for r in own}) == 1
        assert all(sum(r["rank"] == k for r in own) == 4 for k in range(2))
    assert max(r.length for r in batches[0]) == max(r[2] for r in rows)


def test_chunk_predictions(spark):
    chunks = spark.createDataFrame([(1, q, [float(q * 10 + i) for i in range(3)]) for q in range(3)], "ep long, q long, actions array<double>")
    got = {r.t: r.action for r in windows.temporal_ensemble(chunks).collect()}
    w = np.exp(-0.01 * np.arange(3))
    assert np.isclose(got[2], (np.array([2.0, 11.0, 20.0]) * w).sum() / w.sum()) and got[0] == 0.0 and got[4] == 22.0


def test_suffix_and_history(spark):
    rows = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([0, 0, 5, 6, 7])], "ep long, idx long, v double")
    got = {r.idx: (r.actions, r.is_pad) for r in windows.zero_padded_suffix(rows, "v", 4).collect()}
    assert got[0] == ([0, 0, 5, 6], [False] * 4) and got[4] == ([6, 7, 0, 0], [False, False, True, True])
    history = {r.idx: (r.chunk, r.past, r.mask) for r in windows.chunk_with_history(rows, "v", 2, 3, 1.0).collect()}
    assert set(history) == {1, 2, 3, 4} and history[1] == ([0, 5], [0, 0, 0], [False, False, True]) and history[4] == ([7, 7], [5, 6, 7], [True] * 3)


def test_codecs(spark):
    x = np.random.default_rng(7).uniform(-1.1, 1.1, 300).tolist() + [-1.0, 1.0, 0.0]
    edges = np.concatenate([np.linspace(a, b, n, endpoint=closed) for a, b, n, closed in codecs.SEGMENTS])
    df = spark.createDataFrame([(v,) for v in x], "x double")
    assert [r[0] for r in df.select(codecs.uneven_bin(F.col("x"))).collect()] == [int((edges <= np.clip(v, -1, 1) + 1e-12).sum()) for v in x]
    assert [r[0] for r in df.select(codecs.state_bin(F.col("x"))).collect()] == [int(np.digitize(v, np.linspace(-1, 1, 257)[:-1])) - 1 for v in x]
    assert [r[0][0] for r in df.select(codecs.even_tokens(F.array("x"))).collect()] == [32000 - int((np.linspace(-1, 1, 256) <= np.clip(v, -1, 1) + 1e-9).sum()) for v in x]
    with pytest.raises(Exception, match="multiple"):
        spark.range(1).select(codecs.bounded(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), [0.0, 0.0], [1.0, 1.0])).collect()
    linear = 0.5 * (0.058 - 0.01844) + 0.01844
    want = (math.asin((0.022**2 + linear**2 - 0.036**2) / (2 * 0.022 * linear)) - 0.4) / 1.1
    assert np.isclose(spark.range(1).select(codecs.gripper_to_angular(F.lit(0.5))).first()[0], want)


def test_nested_columns(spark):
    df = spark.createDataFrame([(1, {"a": 1}, {"a": 2, "b": 3})], "i int, x map<string,int>, y map<string,int>")
    assert df.select(structs.merge_maps(F.col("x"), F.col("y"))).first()[0] == {"a": 2, "b": 3}
    with pytest.raises(Exception, match="multiple"):
        spark.range(1).select(structs.reshape(F.array(F.lit(1.0), F.lit(2.0)), 3)).collect()
    with pytest.raises(Exception, match="unexpected cameras: odd"):
        spark.range(1).select(filters.camera_slots(F.create_map(F.lit("odd"), F.lit("x")), ["base"], F.lit("0"))).collect()
    with pytest.raises(ValueError):
        structs.reduce_sequence(F.col("x"), "median")


def test_transforms_by_name():
    assert len(transforms.STANDARDS) == 59 and set(transforms.STANDARDS) <= set(transforms.REGISTRY)
    with pytest.raises(KeyError, match="there are"):
        transforms.named("no such")
    with pytest.raises(ValueError):
        transforms.register("libero")(lambda df: df)


def test_every_standard_runs(spark):
    n = np.arange(1.0, 21.0)
    columns = {m["column"] for s in transforms.STANDARDS.values() for pieces in s.vectors.values() for m in map(transforms.PIECE.fullmatch, pieces.split())}
    packed = {"base_pose_tool_reached", "gripper_closed"}
    numbers = columns - packed
    rows = [(1, i, "take it", "push\0\0", zlib.compress(np.arange(7, dtype="<f4").tobytes()), *[(n / 100 + i).tolist()] * len(numbers)) for i in range(4)]
    schema = "ep long, idx long, natural_language_instruction string, instruction string, packed binary, " + ", ".join(f"{c} array<double>" for c in sorted(numbers))
    df = spark.createDataFrame(rows, schema).withColumns({c: F.col("packed") for c in packed})
    want = {"bridge_orig": 7, "rt1": 41, "kuka": 41, "jaco_play": 41, "language_table": 61, "furniture_bench": 7, "playfusion": 7, "nyu_franka_play": 7, "robo_net": 7, "uiuc_d3field": 41}
    for name, standard in transforms.STANDARDS.items():
        got = transforms.named(name)(df).orderBy("idx").collect()
        assert len(got) == 4 - standard.drop_first - standard.reached, name
        if name in want:
            assert {len(r.action) for r in got} == {want[name]}, name
    assert transforms.named("kuka")(df).first().gripper_closed == list(range(7))
    assert transforms.named("language_table")(df).first().language_instruction == "push"
    hydra = transforms.named("stanford_hydra")(df).where("idx = 0").first()
    assert np.allclose(hydra.gripper_state, [0.18]) and np.allclose(hydra.eef_state, [0.01, 0.02, 0.03, 0.08, 0.09, 0.1])
    with pytest.raises(ValueError, match="piece"):
        transforms.standardize(df, transforms.Standard({"action": "state[1]"}))


def test_statistics_are_computed_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(0, 0.5)], "dim long, mean double")

    for _ in range(2):
        assert statscache.cached_statistics(spark, str(tmp_path), ["a", "b"], compute).first().mean == 0.5
    assert len(calls) == 1 and statscache.cache_key(["a", "b"]) != statscache.cache_key(["b", "a"])
    with pytest.raises(FileNotFoundError):
        statscache.require_statistics(spark, str(tmp_path), "none")


def test_log_recovery(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b"',), ("",), ("[1]",), (None,)], "line string")
    assert [r.line for r in episodes.complete_lines(lines).collect()] == ['{"a": 1}']


def test_grid_goes_on_where_it_stopped(spark):
    empty = spark.createDataFrame([], "key long, next_step long")
    rows = spark.createDataFrame([(1, 0.1, 10), (1, 2.5, 20), (1, 2.7, 30), (1, 5.0, 40)], "key long, t double, v long")
    first, state = clips.continued_grid(rows.where("t < 2.6"), empty, "key", "t", "v", 1.0)
    second, state = clips.continued_grid(rows.where("t >= 2.6"), state, "key", "t", "v", 1.0)
    assert sorted((r.step, r.value) for r in first.unionByName(second).collect()) == [(0, 10), (1, 20), (2, 20), (3, 40), (4, 40), (5, 40)]
    assert state.first().next_step == 6
