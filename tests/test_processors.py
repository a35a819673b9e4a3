"""Stateful processors over small streams."""

import pytest

from episodia.sources.episodes import scratch_folder
from episodia.streaming import processors
from episodia.streaming.clips import run_over_table


def stream(spark, rows, schema, files=3):
    """Rows as a stream of several micro-batches."""
    folder = scratch_folder(spark, "in")
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df, timers=False):
    with processors.rocksdb(spark):
        return run_over_table(df, scratch_folder(spark, "out"), timers).collect()


def test_broker_asks_again_after_the_horizon_and_a_reset(spark):
    rows = [("a", t, t == 4, [t + 0.1 * i for i in range(3)]) for t in range(8)] + [("b", 0, False, [7.0]), ("b", 1, False, [8.0]), ("b", 1, False, [9.0])]
    got = {(r.ep, r.t): (r.asked, r.action) for r in run(spark, processors.broker(stream(spark, rows, "ep string, t long, reset boolean, chunk array<double>"), 3))}
    want = {("a", t): (q, q + 0.1 * (t - q)) for t, q in ((0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 4), (6, 4), (7, 7))} | {("b", 0): (0, 7.0), ("b", 1): (0, None)}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == (None if want[k][1] is None else pytest.approx(want[k][1])) for k in want)


@pytest.mark.parametrize("largest", [True, False])
def test_top_k_keeps_strict_improvements(spark, largest):
    scores = [3.0, 1.0, 3.0, 2.0, 2.0, float("nan"), 5.0, 1.0, 0.5]
    rows = [("m", i, f"c{i}", s) for i, s in enumerate(scores)]
    got = sorted((r.nth, r.evicted) for r in run(spark, processors.keep_best(stream(spark, rows, "key string, nth long, name string, score double", 1), 2, largest)))
    assert got == ([(0, None), (1, None), (2, "c1"), (6, "c0")] if largest else [(0, None), (1, None), (3, "c0"), (7, "c3"), (8, "c7")])
    assert run(spark, processors.keep_best(stream(spark, rows, "key string, nth long, name string, score double", 2), 0, largest)) == []


def test_rings_on_a_stream(spark):
    rows = [("a", t, None if t == 2 else float(t)) for t in (1, 0, 4, 2, 3)] + [("a", 1, 9.0), ("b", 0, 5.0)]
    schema = "ep string, t long, value double"
    got = {(r.ep, r.t): r.ring for r in run(spark, processors.keep_recent(stream(spark, rows, schema), 3))}
    assert got == {("a", 0): [0], ("a", 1): [0, 1], ("a", 2): [0, 1, None], ("a", 3): [1, None, 3], ("a", 4): [None, 3, 4], ("b", 0): [5]}
    filled = {(r.ep, r.t): r.ring for r in run(spark, processors.keep_recent(stream(spark, rows[-1:], schema, 1), 2, filled=True))}
    assert filled == {("b", 0): [5, 5]}
    with pytest.raises(ValueError):
        processors.keep_recent(stream(spark, rows, schema), 0)


FRAMES = "ep long, idx long, is_end boolean, v double, name string"


def test_clips_carry_their_frames(spark):
    rows = [(1, i, False, i * 1.5, f"f{i}") for i in (3, 0, 1, 2, 4, 5, 6, 8, 7)] + [(1, 9, True, None, None), (1, 2, False, 3.0, "f2"), (2, 0, True, None, None)]
    got = run(spark, processors.cut_clips(stream(spark, rows, FRAMES, 2), 4, 2, 2), True)
    clips = sorted((r.clip, r.j, r.idx, r.is_pad, r.v, r.name) for r in got if r.j is not None)
    assert [[c[2] for c in clips if c[0] == k] for k in range(3)] == [[0, 2, 4, 6], [2, 4, 6, 8], [4, 6, 8, 8]]
    assert all(v == idx * 1.5 and name == f"f{idx}" for _, _, idx, _, v, name in clips) and sum(c[3] for c in clips) == 1
    assert sorted((r.ep, r.clip, r.complete) for r in got if r.j is None) == [(1, 3, True), (2, 0, True)]


def test_appending_to_an_ended_episode(spark):
    rows = [(1, 0, False, 0.0, "f"), (1, 1, True, None, None), (1, 1, False, 1.0, "late")]
    with pytest.raises(Exception, match="ended after 1 frames|ends after 1 frames"):
        run(spark, processors.cut_clips(stream(spark, rows, FRAMES), 2, 1, 1), True)
    got = run(spark, processors.cut_clips(stream(spark, rows, FRAMES), 2, 1, 1, late="drop"), True)
    assert [(r.clip, r.complete) for r in got if r.j is None] == [(1, True)]


def test_batches_do_not_grow_with_files(spark):
    from episodia.streaming import clips

    folder = scratch_folder(spark, "files")
    spark.range(0, 41, 1, 41).write.parquet(folder)
    assert clips.files_a_batch(folder, spark) == 11
    small = scratch_folder(spark, "files")
    spark.range(0, 4, 1, 3).write.parquet(small)
    assert clips.files_a_batch(small, spark) == 4


class State:
    """A state variable that counts the questions it is asked."""

    def __init__(self, asked):
        self.asked, self.value = asked, None

    def __getattr__(self, name):
        def ask(*args):
            self.asked.append(name)
            if name == "update":
                self.value = args[0]
            return {"exists": self.value is not None, "get": self.value, "iterator": iter(())}.get(name)

        return ask


def test_a_new_key_asks_for_no_state(spark):
    import pandas as pd
    from pyspark.sql.types import StructField, StringType

    asked = []
    cutter = processors.ClipCutter(4, 2, 2, [StructField("name", StringType())], 60, "error")
    cutter.cursor, cutter.frames, cutter.ended = State(asked), State(asked), State(asked)
    rows = pd.DataFrame({"idx": [0, 1, 2], "is_end": [False, False, False], "name": ["a", "b", "c"]})
    end = pd.DataFrame({"idx": [3], "is_end": [True], "name": [None]})
    [out] = list(cutter.handleInputRows((1,), iter([rows, end]), None))
    assert out[["clip", "j", "idx"]].values.tolist()[:4] == [[0, 0, 0], [0, 1, 2], [0, 2, 2], [0, 3, 2]]
    assert asked == ["exists", "exists", "update"]
