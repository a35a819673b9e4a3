"""Joint trees, histograms, mixtures, streams with typed state, and files, over the test tables, each beside its SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, images
from ..operators import filters, histograms, kinematics, sampling, transforms, windows
from ..sources import episodes, files, sinks
from ..streaming import clips, processors
from .catalog import UN, _robot_frames
from .queries import FR, LEN, VEC, _clips_sql, frames, load, register, vectors


# ---- joint trees -----------------------------------------------------------------------------------------------------
#: Trees of 128 links under roots of negative numbers: a part hangs on one of the three before it, the first ones on the root.
_LINKS = "li AS (SELECT p_partkey AS link, CASE WHEN p_partkey % 128 < 1 + p_size % 3 THEN -(p_partkey // 128) - 1 ELSE p_partkey - 1 - p_size % 3 END AS parent, CASE p_size % 4 WHEN 0 THEN 'prismatic' WHEN 1 THEN 'fixed' WHEN 2 THEN 'revolute' ELSE 'continuous' END AS kind, [p_size % 5 * 0.01::DOUBLE, 0.05, p_size % 3 * -0.02::DOUBLE] AS o, [p_size % 2 + 0.0::DOUBLE, 1.0, p_size % 3 * 0.5::DOUBLE] AS a, 0.1::DOUBLE AS rx, p_size * 0.01::DOUBLE AS ry FROM part)"


def _links(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    kind = F.when(size % 4 == 0, "prismatic").when(size % 4 == 1, "fixed").when(size % 4 == 2, "revolute").otherwise("continuous")
    parent = F.when(key % 128 < 1 + size % 3, -F.floor(key / 128) - 1).otherwise(key - 1 - size % 3)
    origin = kinematics.origin_matrix((size % 5 * 0.01, F.lit(0.05), size % 3 * -0.02), (F.lit(0.1), size * 0.01, F.lit(0.0)))
    axis = F.array((size % 2).cast("double"), F.lit(1.0), size % 3 * 0.5)
    return load(spark, d, "part").select(key.alias("link"), parent.alias("parent"), key.alias("joint"), kind.alias("kind"), origin.alias("origin"), axis.alias("axis"))


_PRODUCT = "list_transform(range(16), lambda i: {0}[(i // 4 * 4 + 1)::INT] * {1}[(i % 4 + 1)::INT] + {0}[(i // 4 * 4 + 2)::INT] * {1}[(i % 4 + 5)::INT] + {0}[(i // 4 * 4 + 3)::INT] * {1}[(i % 4 + 9)::INT] + {0}[(i // 4 * 4 + 4)::INT] * {1}[(i % 4 + 13)::INT])"
_ONE = "[1.0::DOUBLE, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]"


@register(
    "g10_link_poses",
    f"""WITH RECURSIVE {_LINKS}, sa AS (SELECT n_nationkey AS sample FROM nation),
    org AS (SELECT link, parent, kind, a, [cos(ry), sin(rx) * sin(ry), cos(rx) * sin(ry), o[1], 0.0, cos(rx), -sin(rx), o[2], -sin(ry), sin(rx) * cos(ry), cos(rx) * cos(ry), o[3], 0.0, 0.0, 0.0, 1.0] AS o FROM li),
    va AS (SELECT sample, org.*, CASE WHEN link % 7 = 0 THEN 0.0 ELSE sin(sample + link) * 0.5 END AS q, sqrt(a[1] * a[1] + a[2] * a[2] + a[3] * a[3]) AS n FROM org, sa),
    un AS (SELECT *, a[1] / n AS x, a[2] / n AS y, a[3] / n AS z, cos(q) AS c, sin(q) AS s FROM va),
    lo AS (SELECT sample, link, parent, o, CASE kind WHEN 'fixed' THEN {_ONE} WHEN 'prismatic' THEN [1.0::DOUBLE, 0, 0, a[1] * q, 0, 1, 0, a[2] * q, 0, 0, 1, a[3] * q, 0, 0, 0, 1]
        ELSE [c + x * x * (1 - c), x * y * (1 - c) - z * s, x * z * (1 - c) + y * s, 0, x * y * (1 - c) + z * s, c + y * y * (1 - c), y * z * (1 - c) - x * s, 0, x * z * (1 - c) - y * s, y * z * (1 - c) + x * s, c + z * z * (1 - c), 0, 0, 0, 0, 1] END AS m FROM un),
    ma AS (SELECT sample, link, parent, {_PRODUCT.format('o', 'm')} AS m FROM lo),
    po AS (SELECT DISTINCT sample, parent AS link, {_ONE} AS pose FROM ma WHERE parent < 0
        UNION ALL SELECT ma.sample, ma.link, {_PRODUCT.format('po.pose', 'ma.m')} FROM po JOIN ma ON ma.sample = po.sample AND ma.parent = po.link)
    SELECT sample, link, round(pose[4], 4) AS x, round(pose[8], 4) AS y, round(pose[12], 4) AS z, round(pose[1], 4) AS r FROM po""",
)
def g10(spark, d):
    links = _links(spark, d)
    values = load(spark, d, "nation").select(F.col("n_nationkey").alias("sample")).join(links.where("joint % 7 <> 0").select("joint")).select("sample", "joint", (F.sin(F.col("sample") + F.col("joint")) * 0.5).alias("value"))
    at = lambda i: F.round(F.get("pose", F.lit(i)), 4)
    return kinematics.link_poses(links, values).select("sample", "link", at(3).alias("x"), at(7).alias("y"), at(11).alias("z"), at(0).alias("r"))


# ---- alignment and images --------------------------------------------------------------------------------------------
E3 = "e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"


@register(
    "g16_alignment",
    f"""WITH {E3}, v AS (SELECT vec_id, e, sqrt(e[1] * e[1] + e[2] * e[2] + e[3] * e[3]) AS na, sqrt(e[4] * e[4] + e[5] * e[5] + e[6] * e[6]) AS nb, e[1] * e[4] + e[2] * e[5] + e[3] * e[6] AS d FROM e)
    SELECT vec_id, round(e[4] / nb, 5) AS x, round(e[5] / nb, 5) AS y, round(e[6] / nb, 5) AS z, round(d / (na * na) * e[1], 5) AS p, 0.0::DOUBLE AS back FROM v""",
)
def g16(spark, d):
    e = F.col("embedding").cast("array<double>")
    a, b = (tuple(F.get(e, F.lit(i + k)) for i in range(3)) for k in (0, 3))
    rows = load(spark, d, "embeddings").select("vec_id", geometry.aligning_rotation(a, b).alias("m"), geometry.aligning_rotation(a, tuple(-c for c in a), turn_back=True).alias("w"), F.array(*geometry.unit(a)).alias("a"), geometry.projection(a, b)[0].alias("p"))
    m, w = ([[F.get(c, F.lit(3 * i + j)) for j in range(3)] for i in range(3)] for c in ("m", "w"))
    u = tuple(F.get("a", F.lit(i)) for i in range(3))
    turned, back = geometry.rotate(m, u), geometry.rotate(w, u)
    gap = sum(F.abs(p + q) for p, q in zip(back, u, strict=True))  # opposite directions meet after half a turn
    return rows.select("vec_id", *[F.round(c, 5).alias(n) for c, n in zip(turned, "xyz", strict=True)], F.round("p", 5).alias("p"), (F.round(gap, 6) + 0.0).alias("back"))


@register("g16_orbits", f"WITH {E3}, p AS (SELECT vec_id, e, vec_id % 7 * 0.3::DOUBLE AS a, vec_id % 5 * 0.2::DOUBLE AS b FROM e) SELECT vec_id, round((e[1] - 1) * cos(a) - (e[2] - 2) * sin(a) + 1, 5) AS x, round((e[1] - 1) * sin(a) + (e[2] - 2) * cos(a) + 2, 5) AS y, round(e[3], 5) AS z, round(cos(a + b), 5) AS r FROM p")
def g16_orbits(spark, d):
    e = F.col("embedding").cast("array<double>")
    a, b, zero, one = F.col("vec_id") % 7 * 0.3, F.col("vec_id") % 5 * 0.2, F.lit(0.0), F.lit(1.0)
    target = geometry.pose_matrix(tuple(F.get(e, F.lit(i)) for i in range(3)), (F.cos(b / 2), zero, zero, F.sin(b / 2)))
    center = geometry.pose_matrix((one, F.lit(2.0), F.lit(3.0)), (one, zero, zero, zero))
    moved = load(spark, d, "embeddings").select("vec_id", geometry.orbit(target, center, (zero, zero, F.lit(2.0)), a).alias("m"))
    return moved.select("vec_id", *[F.round(F.get("m", F.lit(i)), 5).alias(n) for i, n in ((3, "x"), (7, "y"), (11, "z"), (0, "r"))])


def _pixel(height: int, width: int, to_height: int, to_width: int, e: str = "e") -> str:
    """SQL of the resized pixel at (y, x)."""
    place = lambda c, n, to: f"greatest(least(({c} + 0.5) * {n / to!r}::DOUBLE - 0.5, {n - 1}.0), 0.0)"
    return f"(SELECT sum({e}[(yy * {width} + xx + 1)::INT] * greatest(0.0, 1 - abs(yy - {place('y', height, to_height)})) * greatest(0.0, 1 - abs(xx - {place('x', width, to_width)}))) FROM range({height}) a(yy), range({width}) b(xx))"


@register("g20_resized", f"WITH {E3} SELECT vec_id, y * 5 + x AS at, round({_pixel(8, 8, 3, 5)}, 5) AS pixel FROM e, range(3) g(y), range(5) h(x)")
def g20(spark, d):
    small = images.resize(F.col("embedding"), 8, 8, 3, 5)
    return load(spark, d, "embeddings").select("vec_id", F.posexplode(small).alias("at", "pixel")).select("vec_id", F.col("at").cast("long").alias("at"), F.round("pixel", 5).alias("pixel"))


@register("g20_padded", f"WITH {E3} SELECT vec_id, y * 12 + px AS at, CASE WHEN px BETWEEN 3 AND 8 THEN round({_pixel(8, 8, 6, 6).replace('(x +', '(px - 3 +')}, 5) ELSE 0.0 END AS pixel FROM e, range(6) g(y), range(12) h(px)")
def g20_padded(spark, d):
    padded = images.resize_with_pad(F.col("embedding"), 8, 8, 6, 12)
    return load(spark, d, "embeddings").select("vec_id", F.posexplode(padded).alias("at", "pixel")).select("vec_id", F.col("at").cast("long").alias("at"), F.round("pixel", 5).alias("pixel"))


@register("g20_cropped", f"WITH {E3} SELECT vec_id, y * 4 + x AS at, round(e[((y + 2) * 8 + x + 3)::INT], 6) AS pixel FROM e, range(4) g(y), range(4) h(x)")
def g20_cropped(spark, d):
    part = images.crop(F.col("embedding").cast("array<double>"), 8, 8, 2, 2, 4, 4)
    return load(spark, d, "embeddings").select("vec_id", F.posexplode(part).alias("at", "pixel")).select("vec_id", F.col("at").cast("long").alias("at"), F.round("pixel", 6).alias("pixel"))


# ---- histograms ------------------------------------------------------------------------------------------------------
def _histogram_sql(rows: str, key: str, bins: int, shares: tuple[float, ...]) -> str:
    """Quantiles to a bin's width, with the smallest power of two that covers the range in `bins` bins."""
    fits = f"floor(high / pow(2.0::DOUBLE, k)) - floor(low / pow(2.0::DOUBLE, k)) + 1 <= {bins}"
    edges = ", ".join(f"min(CASE WHEN upto >= n * {q!r}::DOUBLE THEN bin * width END) AS q{i}" for i, q in enumerate(shares))
    return f"""ra AS (SELECT {key}, min(x) AS low, max(x) AS high, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std FROM {rows} GROUP BY {key}),
    ex AS (SELECT {key}, pow(2.0::DOUBLE, min(k)) AS width FROM ra, range(-60, 60) g(k) WHERE {fits} GROUP BY {key}),
    bi AS (SELECT r.{key}, floor(x / width) AS bin, any_value(width) AS width, count(*) AS c FROM {rows} r JOIN ex USING ({key}) GROUP BY ALL),
    cu AS (SELECT *, sum(c) OVER (PARTITION BY {key} ORDER BY bin) AS upto FROM bi)
    SELECT {key}, any_value(n) AS n, round(any_value(mean), 5) AS mean, round(any_value(std), 5) AS std, any_value(cu.width) AS width, {edges} FROM cu JOIN ra USING ({key}) GROUP BY {key}"""


@register("a4_histogram_quantiles", f"WITH {VEC}, va AS (SELECT dim::INT AS dim, x FROM ve), {_histogram_sql('va', 'dim', 200, (0.01, 0.5, 0.99))}")
def a4(spark, d):
    states = histograms.histogram_states(vectors(spark, d).select(F.col("dim").cast("int").alias("dim"), "x"), "dim", "x", 200)
    got = histograms.statistics_of(histograms.merge_states(states, "dim", bins=200), "dim", shares=(0.01, 0.5, 0.99))
    return got.select("dim", "n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "width", *[F.get("quantiles", F.lit(i)).alias(f"q{i}") for i in range(3)])


@register("f5_merged_histograms", f"WITH {FR}, va AS (SELECT kind, v AS x FROM fr), {_histogram_sql('va', 'kind', 50, (0.25, 0.75))}")
def f5(spark, d):
    parts = [histograms.histogram_states(frames(spark, d).where(F.col("idx") % 3 == k), "kind", "v", 50) for k in range(3)]
    first = histograms.merge_states(parts[0].unionByName(parts[1]), "kind", bins=50)
    whole = histograms.merge_states(first.unionByName(parts[2]), "kind", bins=50)
    got = histograms.statistics_of(whole, "kind", shares=(0.25, 0.75))
    return got.select("kind", "n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"), "width", *[F.get("quantiles", F.lit(i)).alias(f"q{i}") for i in range(2)])


# ---- mixtures --------------------------------------------------------------------------------------------------------
@register(
    "t8_interleaved_rows",
    """WITH s AS (SELECT event_type AS source, count(*) AS size, CASE WHEN event_type < 'd' THEN 1.0 ELSE 0.5 END::DOUBLE AS w FROM events GROUP BY event_type),
    c AS (SELECT source, size, w, sum(size * w) OVER (ORDER BY source) AS upto, sum(size * w) OVER () AS total FROM s),
    d AS (SELECT i AS draw, (i * 0.6180339887498949::DOUBLE) % 1.0 AS u FROM range((SELECT 4 * count(*) FROM events)) g(i)),
    p AS (SELECT draw, arg_min(source, upto) AS source FROM d JOIN c ON u < upto / total GROUP BY draw),
    n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw) - 1 AS nth FROM p),
    l AS (SELECT max(draw) AS last FROM n JOIN s USING (source) WHERE w = 1.0 AND nth = size - 1),
    e AS (SELECT event_id, event_type AS source, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS place FROM events)
    SELECT draw, source, nth // size AS epoch, event_id FROM n JOIN s USING (source) JOIN e ON e.source = n.source AND e.place = nth % size, l WHERE draw <= last""",
)
def t8_rows(spark, d):
    events = load(spark, d, "events").select("event_id", F.col("event_type").alias("source"))
    weight = F.when(F.col("source") < "d", 1.0).otherwise(0.5)
    sources = events.groupBy("source").agg(F.count(F.lit(1)).alias("size")).withColumns({"weight": weight, "primary": weight == 1.0})
    return sampling.interleave(events, sampling.epoch_draws(sources), "source", ["event_id"]).select("draw", "source", "epoch", "event_id")


@register(
    "t19_apportioned",
    """WITH RECURSIVE s AS (SELECT s_suppkey AS pos, pow(greatest(s_acctbal, 0), 3) AS w FROM supplier), t AS (SELECT (3 * count(*) // 2)::BIGINT AS n, sum(w) AS total FROM s),
    o AS (SELECT pos, w, row_number() OVER (ORDER BY w, pos) AS i FROM s WHERE w > 0),
    r(k, used) AS (SELECT 0::BIGINT, 0.0::DOUBLE UNION ALL SELECT k + 1, used + w FROM r JOIN o ON i = k + 1, t WHERE w * (n - k) < total - used),
    f AS (SELECT max(k) AS k FROM r), g AS (SELECT n - k AS rest, (SELECT sum(w) FROM o WHERE i > k) AS weights FROM t, f),
    p AS (SELECT pos, w / weights * rest AS part FROM o, f, g WHERE i > k),
    q AS (SELECT pos, floor(part)::BIGINT AS whole, row_number() OVER (ORDER BY part - floor(part) DESC, pos DESC) AS nth FROM p)
    SELECT s.pos, CASE WHEN s.w = 0 THEN 0 WHEN i <= k THEN 1 ELSE whole + CASE WHEN nth <= rest - (SELECT sum(whole) FROM q) THEN 1 ELSE 0 END END::BIGINT AS share FROM s LEFT JOIN o USING (pos) LEFT JOIN q USING (pos), f, g""",
)
def t19(spark, d):
    weight = F.pow(F.greatest("s_acctbal", F.lit(0.0)), F.lit(3.0))
    sources = load(spark, d, "supplier").select(F.col("s_suppkey").alias("pos"), weight.alias("weight"))
    return sampling.apportion(sources, 3 * sources.count() // 2).select("pos", "share")


# ---- streams with typed state ----------------------------------------------------------------------------------------
def _stream_of(spark: SparkSession, rows: DataFrame, name: str, files: int | None = 4) -> tuple[DataFrame, str]:
    folder = episodes.scratch_folder(spark, name)
    rows.write.parquet(f"{folder}/in")
    reader = spark.readStream.schema(rows.schema)
    return (reader.option("maxFilesPerTrigger", clips.files_a_batch(f"{folder}/in", spark, files)) if files else reader).parquet(f"{folder}/in"), folder


@register("r10_chunk_broker", f"WITH {FR}, r AS (SELECT ep, idx AS t, v, coalesce(max(CASE WHEN kind = 'error' THEN idx END) OVER (PARTITION BY ep ORDER BY idx), 0) AS since FROM fr), a AS (SELECT ep, t, t - (t - since) % 3 AS asked FROM r) SELECT a.ep, a.t, asked, round(v + t - asked, 6) AS action FROM a JOIN fr ON fr.ep = a.ep AND fr.idx = asked")
def r10(spark, d):
    chunk = F.array(*[F.col("v") + i for i in range(4)])
    steps = frames(spark, d).select("ep", F.col("idx").cast("long").alias("t"), (F.col("kind") == "error").alias("reset"), chunk.alias("chunk"))
    stream, folder = _stream_of(spark, steps, "broker")
    with processors.rocksdb(spark):
        return clips.run_over_table(processors.broker(stream, 3), folder).withColumn("action", F.round("action", 6))


@register("r9_streamed_ring", f"WITH {FR} SELECT a.ep, a.idx AS t, string_agg(b.event_id::VARCHAR, ',' ORDER BY j DESC) AS ring FROM fr a, range(3) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = greatest(a.idx - j, 0) GROUP BY a.ep, a.idx")
def r9_stream(spark, d):
    steps = frames(spark, d).select("ep", F.col("idx").cast("long").alias("t"), F.col("event_id").alias("value"))
    stream, folder = _stream_of(spark, steps, "ring")
    with processors.rocksdb(spark):
        return clips.run_over_table(processors.keep_recent(stream, 3, filled=True), folder).select("ep", "t", F.array_join(F.transform("ring", lambda x: x.cast("string")), ",").alias("ring"))


@register("t4_online", "WITH e AS (SELECT event_type AS key, event_id AS nth, value AS score FROM events) SELECT a.key, a.nth, a.score FROM e a LEFT JOIN e b ON a.key = b.key AND b.nth < a.nth AND b.score >= a.score GROUP BY ALL HAVING count(b.nth) < 5")
def t4_online(spark, d):
    offers = load(spark, d, "events").select(F.col("event_type").alias("key"), F.col("event_id").alias("nth"), F.col("event_id").cast("string").alias("name"), F.col("value").alias("score"))
    stream, folder = _stream_of(spark, offers, "keeper", None)
    with processors.rocksdb(spark):
        return clips.run_over_table(processors.keep_best(stream, 5), folder).select("key", "nth", "score")


@register("r1_clip_frames", f"WITH {_clips_sql(8, 4, 2)} SELECT ep, clip, j, idx, is_pad, v, kind FROM po JOIN fr USING (ep, idx)")
def r1_frames(spark, d):
    rows = frames(spark, d).select("ep", F.col("idx").cast("long").alias("idx"), F.lit(False).alias("is_end"), "v", "kind")
    ends = windows.lengths(rows).select("ep", F.col("n").alias("idx"), F.lit(True).alias("is_end"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("string").alias("kind"))
    stream, folder = _stream_of(spark, rows.unionByName(ends), "cutter")
    with processors.rocksdb(spark):
        return clips.run_over_table(processors.cut_clips(stream, 8, 4, 2), folder, timers=True).where("j is not null").drop("complete")


# ---- files -----------------------------------------------------------------------------------------------------------
@register(
    "s8_tar_files",
    """WITH d AS (SELECT printf('%09d.txt', doc_id) AS key, coalesce(text, '') AS text, doc_id FROM documents),
    s AS (SELECT *, (sum(octet_length(encode(text))) OVER (ORDER BY key) - octet_length(encode(text))) // 300000 AS shard FROM d)
    SELECT printf('train-%06d.tar', shard::BIGINT) AS name, count(*) AS members, sum(octet_length(encode(text)))::BIGINT AS bytes, sha256(string_agg(text, '' ORDER BY key)) AS sha256 FROM s GROUP BY shard""",
)
def s8_files(spark, d):
    samples = load(spark, d, "documents").select(F.format_string("%09d.txt", "doc_id").alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("payload"))
    folder = episodes.scratch_folder(spark, "tars")
    sinks.write_tar_shards(sinks.number_shards(samples, ["key"], 300_000), folder)
    members = files.parse_files(files.episode_files(spark, folder, "*.tar"), lambda path, content: ({"file": path, "key": k, "text": p.decode()} for k, p in sinks.tar_members(content)), "file string, key string, text string", 500)
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "text"))), lambda m: m.text), "")
    by = members.groupBy(F.regexp_extract("file", "([^/]+)$", 1).alias("name")).agg(F.count(F.lit(1)).alias("members"), F.sum(F.octet_length("text")).alias("bytes"), whole.alias("whole"))
    return by.select("name", "members", "bytes", F.sha2("whole", 256).alias("sha256"))


@register("s21_point_clouds", f"WITH {E3} SELECT 'label' || label || '.ply' AS name, count(*) AS points, round(sum(e[1]), 5) AS x, round(sum(e[3]), 5) AS z, sum(vec_id % 256)::BIGINT AS red, arg_min(vec_id, vec_id) % 256 AS first FROM e JOIN embeddings USING (vec_id) GROUP BY label")
def s21(spark, d):
    e = F.col("embedding").cast("array<double>")
    points = load(spark, d, "embeddings").select(F.format_string("label%d", "label").alias("cloud"), "vec_id", *[F.get(e, F.lit(i)).alias(c) for i, c in enumerate("xyz")], (F.col("vec_id") % 256).cast("int").alias("red"), F.lit(0).alias("green"), F.lit(255).alias("blue"))
    folder = episodes.scratch_folder(spark, "clouds")
    sinks.write_point_clouds(points, folder, "vec_id")

    def parse(path, content):
        cloud = sinks.read_point_cloud(content)
        yield {"name": path.rsplit("/", 1)[1], "points": len(cloud), "x": float(cloud["x"].sum()), "z": float(cloud["z"].sum()), "red": int(cloud["red"].sum()), "first": int(cloud["red"][0])}

    got = files.parse_files(files.episode_files(spark, folder, "*.ply"), parse, "name string, points long, x double, z double, red long, first long")
    return got.withColumns({"x": F.round("x", 5), "z": F.round("z", 5)})


def _customer_files(spark: SparkSession, d: str) -> str:
    """A folder of files /task<nation>/episode<number>.jsonl with a customer a line; point clouds and mirrored ones among them."""
    c = load(spark, d, "customer").withColumn("part", F.col("c_custkey") % 6)
    name = F.concat(F.when(F.col("part") == 5, "pointcloud/").otherwise(""), F.lit("task"), F.col("c_nationkey").cast("string"), F.lit("/"), F.when(F.col("part") == 4, "mirror").otherwise("episode"), F.col("part").cast("string"), F.lit(".jsonl"))
    line = F.to_json(F.struct(F.col("c_custkey").alias("value"), F.round("c_acctbal", 2).alias("x")))
    lines = c.groupBy(name.alias("name")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda s: s.line), "\n").cast("binary").alias("content"))
    folder = episodes.scratch_folder(spark, "episodes")
    sinks.write_plain_files(lines, folder)
    return folder


def _json_rows(path, content):
    for idx, line in enumerate(content.splitlines()):
        yield {"path": path, "idx": idx, **json.loads(line)}


@register("s1_discovered_files", "SELECT 'task' || c_nationkey AS task, (c_custkey % 6)::BIGINT AS episode, count(*) AS rows FROM customer WHERE c_custkey % 6 < 4 GROUP BY c_nationkey, c_custkey % 6 QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 6) <= 3")
def s1_files(spark, d):
    found = files.episode_files(spark, _customer_files(spark, d), "*.jsonl")
    kept = filters.skip_files(found).transform(lambda df: df.join(episodes.discover(df, None, 3).select("path", "task", "episode"), "path"))
    rows = files.parse_files(kept, _json_rows, "path string, idx long, value long, x double").groupBy("path").count()
    return kept.select("path", "task", "episode").join(rows, "path").select("task", F.col("episode").cast("long").alias("episode"), F.col("count").alias("rows"))


@register("s15_parsed_files", "SELECT c_custkey AS value, round(c_acctbal, 2) AS x, row_number() OVER (PARTITION BY c_nationkey, c_custkey % 6 ORDER BY c_custkey) - 1 AS idx, 'task' || c_nationkey AS task FROM customer WHERE c_custkey % 6 < 4")
def s15_files(spark, d):
    found = filters.skip_files(files.episode_files(spark, _customer_files(spark, d), "*.jsonl"))
    return files.parse_files(found, _json_rows, "path string, idx long, value long, x double").select("value", "x", "idx", F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("task"))


@register("s18_skipped_on_disk", "SELECT DISTINCT 'task' || c_nationkey || '/episode' || c_custkey % 6 || '.jsonl' AS name FROM customer WHERE c_custkey % 6 < 4")
def s18_files(spark, d):
    found = filters.skip_files(files.episode_files(spark, _customer_files(spark, d)))
    return found.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("name"))


@register(
    "s14_shuffled_files",
    "WITH r AS (SELECT 'task' || c_nationkey || '/' || CASE c_custkey % 6 WHEN 4 THEN 'mirror' ELSE 'episode' END || c_custkey % 6 || '.jsonl' AS file, c_custkey FROM customer), f AS (SELECT file, row_number() OVER (ORDER BY md5('7:' || file), file) AS file_rank, min(c_custkey) AS first, count(*) AS rows FROM r GROUP BY file) SELECT file, file_rank, first, rows, true AS together FROM f",
)
def s14_files(spark, d):
    rows = spark.read.schema("value long, x double").option("recursiveFileLookup", "true").json(_customer_files(spark, d))
    named = rows.select(F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1).alias("file"), F.col("value"))
    dealt = files.shuffled_files(named, 7, "file", "value").withColumn("at", F.monotonically_increasing_id())
    by = dealt.groupBy("file", "file_rank").agg(F.min_by("value", "at").alias("first"), F.count(F.lit(1)).alias("rows"), (F.max("at") - F.min("at") + 1).alias("reach"), F.size(F.collect_set(F.shiftright("at", 33))).alias("parts"))
    return by.select("file", "file_rank", "first", "rows", ((F.col("parts") > 1) | (F.col("reach") == F.col("rows"))).alias("together"))


@register("s13_rechunked", f"WITH {FR}, {LEN} SELECT ep, ceil(n / 17.0::DOUBLE)::BIGINT AS files, least(n, 17) AS largest, n AS rows, ceil(n / 17.0::DOUBLE)::BIGINT AS groups FROM len")
def s13(spark, d):
    rows = frames(spark, d).select("ep", "idx", "event_id", "v")
    folder = episodes.scratch_folder(spark, "chunks")
    chunk = files.optimal_chunk((rows.count(), 3), 8, 400)  # 17 rows of three numbers
    files.rechunk(rows, folder, "ep", "idx", max(chunk[0], 1))
    ep = F.regexp_extract("path", "ep=(-?[0-9]+)/", 1).try_cast("long")
    return files.row_groups(spark, folder).groupBy(ep.alias("ep")).agg(F.count(F.lit(1)).alias("files"), F.max("rows").alias("largest"), F.sum("rows").alias("rows"), F.sum("groups").alias("groups"))


# ---- standards -------------------------------------------------------------------------------------------------------
@register("p16_rh20t", f"WITH {FR}, {UN} SELECT ep, idx, v + 1 AS commanded, v + 2 AS measured, round(g, 6) AS gripper, round(g / 2, 6) AS width, 4 AS size FROM un")
def p16_rh20t(spark, d):
    base = _robot_frames(spark, d).withColumn("g", F.get("state", F.lit(8)))
    vector = lambda k: F.transform("world_vector", lambda x: x + k)
    rows = base.withColumns({"action_tcp_base": vector(1), "action_gripper": F.col("g"), "tcp_base": vector(2), "gripper_width": F.col("g") / 2})
    got = transforms.named("rh20t")(rows)
    return got.select("ep", "idx", F.col("action")[0].alias("commanded"), F.col("proprio")[0].alias("measured"), F.round(F.col("action")[3], 6).alias("gripper"), F.round(F.col("proprio")[3], 6).alias("width"), F.size("action").alias("size"))


@register("p16_taco_play", f"WITH {FR}, {UN} SELECT ep, idx, v AS a0, round(g, 6) AS gripper, v * 2 AS e0, 0.7::DOUBLE AS g0, kind AS language_instruction FROM un")
def p16_taco(spark, d):
    rows = _robot_frames(spark, d).withColumns({"rel_actions_world": F.col("action"), "robot_obs": F.col("state")})
    got = transforms.named("taco_play")(rows)
    return got.select("ep", "idx", F.col("action")[0].alias("a0"), F.round(F.col("action")[6], 6).alias("gripper"), F.col("state_eef")[0].alias("e0"), F.col("state_gripper")[0].alias("g0"), "language_instruction")
