"""Literal cases of the operators."""

import pytest
from pyspark.sql import functions as F

from episodia.functions import geometry, normalize, text
from episodia.operators import joins, sampling, windows
from episodia.operators.schema import rename_columns
from episodia.sources import episodes
from episodia.streaming.clips import stream_clips


def frames(spark, n, ep=1):
    return spark.range(n).select(F.lit(ep).cast("long").alias("ep"), F.col("id").alias("idx"), F.col("id").cast("double").alias("v"))


def clips_of(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.clip, r.j)):
        out.setdefault(r.clip, []).append((r.idx, r.is_pad))
    return list(out.values())


def test_clips_with_residual(spark):
    got = clips_of(windows.clip_positions(frames(spark, 9), 4, 2, 2).collect())
    assert [[i for i, _ in c] for c in got] == [[0, 2, 4, 6], [2, 4, 6, 8], [4, 6, 8, 8]]
    assert [sum(p for _, p in c) for c in got] == [0, 0, 1]


def test_exactly_one_clip(spark):
    assert len(clips_of(windows.clip_positions(frames(spark, 15), 15, 15, 1).collect())) == 1


def test_history_clamps_to_first_frame(spark):
    f = frames(spark, 6).where("idx >= 3")
    got = joins.history(f, spark.createDataFrame([(1, 5)], "ep long, t0 long"), "v", 4, 2).orderBy("h").collect()
    assert [(r.target, r.value, r.valid) for r in got] == [(5, 5.0, True), (3, 3.0, True), (1, 3.0, False), (-1, 3.0, False)]


def test_delta_actions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [[3.0, 4.0, 5.0], [5.0, 6.0, 7.0]])], "state array<double>, actions array<array<double>>")
    got = df.select(normalize.delta_actions(F.col("actions"), F.col("state"), [False, True]).alias("d"), normalize.delta_actions(F.col("actions"), F.col("state"), [False, True], absolute=True).alias("a")).first()
    assert got.d == [[3, 2, 5], [5, 4, 7]] and got.a == [[3, 6, 5], [5, 8, 7]]
    assert normalize.make_bool_mask(2, -2, 2) == [True, True, False, False, True, True]


def test_rotation(spark):
    q = [F.lit(x) for x in (0.5**0.5, 0.0, 0.0, 0.5**0.5)]
    p = geometry.transform_point(geometry.quaternion_matrix(*q), tuple(map(F.lit, (1.0, 2.0, 3.0))), tuple(map(F.lit, (1.0, 0.0, 0.0))))
    assert [round(x, 9) for x in spark.range(1).select(*p).first()] == [1, 3, 3]
    with pytest.raises(Exception, match="norm"):
        spark.range(1).select(*geometry.rotate(geometry.quaternion_matrix(*[F.lit(0.0)] * 4), (F.lit(1.0),) * 3)).collect()


def test_flow_turns_points_and_keeps_repeated_ones(spark):
    points = spark.createDataFrame([(1, 7, 1.0, 0.0, 0.0)] * 2, "part long, point long, x double, y double, z double")
    poses = spark.createDataFrame([(1, 0, 1.0, 2.0, 3.0, 0.5**0.5, 0.0, 0.0, 0.5**0.5)], "part long, t long, tx double, ty double, tz double, qw double, qx double, qy double, qz double")
    assert [[round(v, 9) for v in (r.x, r.y, r.z)] for r in joins.flow(points, poses).collect()] == [[1, 3, 3]] * 2


def test_templates(spark):
    df = spark.createDataFrame([("take {A} with {a}", ["A", "a"]), ("take {A}", ["A", "a"]), ("take {B}", ["A"])], "t string, p array<string>")
    assert [r[0] for r in df.select(text.template_fits(F.col("t"), F.col("p"))).collect()] == [True, True, False]
    assert df.limit(1).select(text.substitute(F.col("t"), F.create_map(F.lit("A"), F.lit("the cup"), F.lit("a"), F.lit("the left arm")))).first()[0] == "take the cup with the left arm"


def test_assign_and_names(spark):
    dealt = sampling.assign_greedy(spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", 2.0), ("d", 2.0)], "task string, size double"), "task", "size", 2)
    assert {r.task: r.bin for r in dealt.collect()} == {"a": 0, "b": 1, "c": 0, "d": 1}
    assert episodes.csv_names("all") is None and episodes.csv_names("x, y") == ["x", "y"]
    paths = spark.createDataFrame([(f"/d/t/episode{i}.hdf5",) for i in (10, 2, 1)], "path string")
    assert [r.episode for r in episodes.discover(paths, ["t"], 2).orderBy("episode").collect()] == [1, 2]


def test_tar_shards_hold_all(spark):
    import io
    import tarfile

    samples = spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"), F.repeat(F.lit("x"), 100).cast("binary").alias("payload"))
    names = [m.name for r in episodes.tar_shards(samples, "train", 1000).collect() for m in tarfile.open(fileobj=io.BytesIO(r.content)).getmembers()]
    assert sorted(names) == sorted(f"k{i}" for i in range(50))


def test_stream_equals_batch(spark, tmp_path):
    parts = [[(1, 0, False), (1, 2, False), (2, 0, False)], [(1, 1, False), (1, 3, False), (2, 1, False)], [(1, 4, False), (1, 6, True), (1, 5, False), (2, 2, True)]]
    schema = "ep long, idx long, is_end boolean"
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream_clips(stream, 3, 2, 1).writeStream.format("memory").queryName("stream_clips").outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = spark.sql("select * from stream_clips where j is not null").collect()
    assert sorted((r.ep, r.clip, r.complete) for r in spark.sql("select * from stream_clips where j is null").collect()) == [(1, 3, True), (2, 1, True)]
    batch = windows.clip_positions(frames(spark, 6).unionByName(frames(spark, 2, 2)), 3, 2, 1).collect()
    assert sorted((r.ep, r.clip, r.j, r.idx, r.is_pad) for r in got) == sorted((r.ep, r.clip, r.j, r.idx, r.is_pad) for r in batch)


def test_rename_clash_is_an_error(spark):
    rows = spark.createDataFrame([(1, 2)], "a_x int, b_x int")
    assert rename_columns(rows, {"a_x": "y", "b_.*": None}).columns == ["y"]
    with pytest.raises(ValueError):
        rename_columns(rows, {"[ab]_(x)": r"\1"})
