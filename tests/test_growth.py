"""What moves and is sorted in lookups, clips and file readers: not more than the input's rows."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from episodia.operators import filters, joins, windows
from episodia.plans import registry
from episodia.sources import episodes, files, sinks

from .compare import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_circles_and_boxes_do_not_move(spark, monkeypatch):
    rng = random.Random(1)
    circles = [(i, rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(0, 9)) for i in range(60)]
    boxes = [(i, x, y, x + rng.uniform(0, 15), y + rng.uniform(0, 15)) for i in range(60) for x, y in [(rng.uniform(-20, 20), rng.uniform(-20, 20))]]
    c, b = spark.createDataFrame(circles, "circle long, x double, y double, r double"), spark.createDataFrame(boxes, "box long, x0 double, y0 double, x1 double, y1 double")
    want = sorted((i, k) for i, x, y, r in circles for k, x0, y0, x1, y1 in boxes if max(x0 - x, x - x1, 0) ** 2 + max(y0 - y, y - y1, 0) ** 2 <= r * r)
    for limit in (joins.BROADCAST_ROWS, 0):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
        met = joins.overlapping(c, b, 4.0)
        assert sorted(map(tuple, met.collect())) == want
        assert "Aggregate" not in plan(met)


def test_grids_move_samples_only(spark):
    rows = [("a", 0.5, 1), ("a", 3.2, None), ("a", 3.9, 7), ("a", 6.1, 2), ("b", 2.0, 5), ("b", 4.0, None), ("c", 9.0, 3)]
    df = spark.createDataFrame(rows, "key string, time double, value int")
    got = {}
    for r in joins.aligned_grid(df, "key", "time", "value", 1.0, 8).collect():
        got.setdefault(r.key, {})[r.k] = r.value
    assert got == {"a": dict(enumerate([1, 2, 2, 2, 2, 2, 2, 2])), "b": dict(enumerate([5, 5, 5, None, None, None, None, None])), "c": dict(enumerate([3] * 8))}
    assert sorted((r.k, r.value) for r in joins.forward_grid(df, "key", "time", "value", 1.0).where("key = 'b'").collect()) == [(0, 5), (1, 5), (2, 5), (3, None), (4, None)]
    assert plan(joins.aligned_grid(df, "key", "time", "value", 1.0, 8)).count("Exchange") <= 2
    assert "Join" not in plan(joins.aligned_grid(df, "key", "time", "value", 1.0, 8))


def test_history_sorts_a_target_once(spark):
    df = registry.queries()["j1_every_frame"](spark, DATA)
    text = plan(df)
    assert "SortAggregate" not in text and text.index("Generate posexplode") < text.index("Window")  # the plan's root comes first


def test_places_of_clips_do_not_move(spark):
    frames = spark.createDataFrame([(e, i, float(i * e)) for e, n in ((1, 1), (2, 7), (3, 16), (4, 33)) for i in range(n)], "ep long, idx long, v double")
    for length, stride, interval in ((8, 4, 2), (3, 50, 5), (4, 2, 3), (1, 1, 1), (5, 1, 1)):
        made = windows.clips(frames, length, stride, interval)
        want = windows.clip_positions(frames, length, stride, interval).join(frames, ["ep", "idx"])
        columns = ["ep", "clip", "j", "idx", "is_pad", "v"]
        assert sorted(map(tuple, made.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    moving = filters.moving_clips(windows.clips(frames.repartition(4, "ep"), 8, 4, 2), "v", 6)
    assert plan(moving).count("Exchange hashpartitioning(ep#") <= 2  # frames and lengths; no clip


def test_paths_are_dealt_and_rows_collected(spark):
    paths = spark.range(5000).coalesce(1).selectExpr("concat('/d/', id) AS path")

    def parse(path):
        return ({"n": int(path[3:]), "k": k} for k in range(int(path[3:]) % 3))

    got = episodes.build_table(paths, parse, "n long, k long", rows=7)
    assert got.rdd.getNumPartitions() > 1
    assert sorted(map(tuple, got.collect())) == [(n, k) for n in range(5000) for k in range(n % 3)]


def test_chunks_are_not_files_of_the_file_system(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(episodes, "scratch_folder", lambda spark, name: str(tmp_path / name))
    got = registry.queries()["s13_rechunked"](spark, DATA).collect()
    assert sum(r.files for r in got) > 50
    assert len([p for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".crc"]) <= 8 + 2  # one a task, beside what marks success


def test_chunks_hold_all_rows_in_order(spark, tmp_path):
    lengths = {None: 18, "": 1, "-3": 17, "a/b c=ä": 35, "long": 3001}
    rows = [(k, i, f"{k}:{i}", None if i % 5 == 0 else [i, i + 1]) for k, n in lengths.items() for i in range(n)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "key string, at long, text string, pair array<long>")
    files.rechunk(df, str(tmp_path / "c"), "key", "at", 17, shard_bytes=20_000)
    shards = {p.name: list(sinks.tar_members(p.read_bytes())) for p in (tmp_path / "c").iterdir()}
    assert all(sum(len(c) for _, c in members[:-1]) < 20_000 for members in shards.values()) and len(shards) > 8
    assert sum(any(name.startswith("key=long/") for name, _ in members) for members in shards.values()) > 4  # a long key is many tasks' work
    by_name = [(name, pq.read_table(pa.BufferReader(c)).to_pylist()) for members in shards.values() for name, c in members]
    names = {None: "__HIVE_DEFAULT_PARTITION__", "": "", "-3": "-3", "a/b c=ä": "a%2Fb+c%3D%C3%A4", "long": "long"}
    want = {f"key={names[k]}/{c:06d}.parquet": [{"at": i, "text": f"{k}:{i}", "pair": None if i % 5 == 0 else [i, i + 1]} for i in range(c * 17, min(n, c * 17 + 17))] for k, n in lengths.items() for c in range(-(-n // 17))}
    assert dict(by_name) == want and len(by_name) == len(want)
    assert {(r.path, r.rows, r.groups) for r in files.row_groups(spark, str(tmp_path / "c")).collect()} == {(name, len(v), 1) for name, v in want.items()}
    df.repartition(2).write.parquet(str(tmp_path / "plain"))
    assert sum(r.rows for r in files.row_groups(spark, str(tmp_path / "plain")).collect()) == len(rows)


def test_chunks_of_odd_tables(spark, tmp_path):
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    query = registry.queries()["s13_rechunked"]
    rows = [(i, datetime(2024, 1, 1) + timedelta(seconds=i), u, "x", 1.0) for u, n in ((None, 40), (-7, 17), (3, 1)) for i in range(n)]
    for name, given, want in (("odd", rows, {(None, 3, 17, 40, 3), (-7, 1, 17, 17, 1), (3, 1, 1, 1, 1)}), ("none", [], set())):
        spark.createDataFrame(given, schema).write.parquet(str(tmp_path / name / "events.parquet"))
        assert {tuple(r) for r in query(spark, str(tmp_path / name)).collect()} == want
