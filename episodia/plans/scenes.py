"""Scenes and geometry over the test tables, each beside its SQL.

Pixels are embeddings: a clip is a label, the first components are a position, and poses turn about the z axis.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import filters, joins, scene
from .preparation import E, rounded
from .queries import FR, Q, _quaternions, frames, load, register

MATRIX = "1-2*(y*y+z*z) AS m00, 2*(x*y-z*w) AS m01, 2*(x*z+y*w) AS m02, 2*(x*y+z*w) AS m10, 1-2*(x*x+z*z) AS m11, 2*(y*z-x*w) AS m12, 2*(x*z-y*w) AS m20, 2*(y*z+x*w) AS m21, 1-2*(x*x+y*y) AS m22"
NAMES = [f"m{i}{j}" for i in range(3) for j in range(3)]


@register("g1_quaternion_matrix", f"WITH {Q}, m AS (SELECT vec_id, {MATRIX} FROM q) SELECT vec_id, {', '.join(f'round({n}, 6) AS {n}' for n in NAMES)} FROM m")
def g1(spark, d):
    df, e = _quaternions(spark, d)
    return df.select("vec_id", *rounded([c for row in geometry.quaternion_matrix(*e[:4]) for c in row], *NAMES))


@register("g2_pose_matrix", f"WITH {Q}, m AS (SELECT vec_id, a, b, c, {MATRIX} FROM q) SELECT vec_id, round(m01, 6) AS m01, round(m12, 6) AS m12, round(a, 6) AS tx, round(c, 6) AS tz, round(m01, 6) AS other FROM m")
def g2(spark, d):
    df, e = _quaternions(spark, d)
    m = geometry.pose_matrix(tuple(e[4:7]), tuple(e[:4]))
    other = geometry.pose_matrix(tuple(e[4:7]), (*e[1:4], e[0]), order="xyzw")
    return df.select("vec_id", *rounded([m[0][1], m[1][2], m[0][3], m[2][3], other[0][1]], "m01", "m12", "tx", "tz", "other"))


@register("g3_matrix_quaternion", f"WITH {Q} SELECT vec_id, round(sign(w) * x, 5) AS qx, round(sign(w) * y, 5) AS qy, round(sign(w) * z, 5) AS qz, round(abs(w), 5) AS qw FROM q")
def g3(spark, d):
    df, e = _quaternions(spark, d)
    q = df.select("vec_id", *[c.alias(n) for c, n in zip(geometry.matrix_quaternion(geometry.quaternion_matrix(*e[:4])), "xyzw", strict=True)])
    return q.select("vec_id", *[F.round(F.signum("w") * F.col(c), 5).alias(f"q{c}") for c in "xyzw"])


@register("g6_camera_normals", """WITH p AS (SELECT vec_id, vec_id // 20 AS v, vec_id % 20 AS u, vec_id % 20 + embedding[1]::DOUBLE AS x, vec_id // 20 + embedding[2]::DOUBLE AS y, -30 + embedding[3]::DOUBLE AS z, (embedding[4] > 0.12)::INT AS actor, CASE WHEN embedding[5] > 0.25 THEN 1.0 ELSE 0.0 END AS w FROM embeddings),
    a AS (SELECT *, lag(x) OVER r AS lx, lead(x) OVER r AS rx, lag(y) OVER r AS ly, lead(y) OVER r AS ry, lag(z) OVER r AS lz, lead(z) OVER r AS rz, lag(x) OVER c AS ux, lead(x) OVER c AS dx, lag(y) OVER c AS uy, lead(y) OVER c AS dy, lag(z) OVER c AS uz, lead(z) OVER c AS dz,
      w < 1 AND coalesce(lag(w) OVER r < 1 AND lead(w) OVER r < 1 AND lag(w) OVER c < 1 AND lead(w) OVER c < 1, false) AND coalesce(lag(actor) OVER r = actor AND lead(actor) OVER r = actor AND lag(actor) OVER c = actor AND lead(actor) OVER c = actor, false) AS good FROM p WINDOW r AS (PARTITION BY v ORDER BY u), c AS (PARTITION BY u ORDER BY v)),
    n AS (SELECT *, (ry - ly) * (dz - uz) - (rz - lz) * (dy - uy) AS a, (rz - lz) * (dx - ux) - (rx - lx) * (dz - uz) AS b, (rx - lx) * (dy - uy) - (ry - ly) * (dx - ux) AS c FROM a), s AS (SELECT *, CASE WHEN a * -x + b * -y + c * -z < 0 THEN -1 ELSE 1 END / sqrt(a * a + b * b + c * c) AS s FROM n)
    SELECT vec_id, CASE WHEN good THEN round(a * s, 5) ELSE 0 END AS nx, CASE WHEN good THEN round(b * s, 5) ELSE 0 END AS ny, CASE WHEN good THEN round(c * s, 5) ELSE 0 END AS nz FROM s""")
def g6(spark, d):
    df, e = _quaternions(spark, d)
    v, u = F.floor(F.col("vec_id") / 20), F.col("vec_id") % 20
    pixels = df.select("vec_id", v.alias("v"), u.alias("u"), (u + e[0]).alias("x"), (v + e[1]).alias("y"), (e[2] - 30).alias("z"), (e[3] > 0.12).cast("int").alias("actor_id"), F.when(e[4] > 0.25, 1.0).otherwise(0.0).alias("w"))
    return scene.camera_normals(pixels).select("vec_id", *[F.round(c, 5).alias(c) for c in ("nx", "ny", "nz")])


@register("g8_camera_payload", "SELECT p_partkey, round(p_retailprice::DOUBLE * 320 / (p_size * 10), 5) AS fx, round(p_size::DOUBLE * 180 / (p_size * 5), 5) AS cy, 1.0::DOUBLE AS corner FROM part")
def g8(spark, d):
    size = F.col("p_size").cast("double")
    fx, _, _, cy = geometry.scaled_intrinsic(F.col("p_retailprice").cast("double"), size, size, size, size * 10, size * 5)
    m = geometry.homogeneous(tuple((F.lit(1.0), F.lit(0.0), F.lit(0.0), size) for _ in range(3)))
    return load(spark, d, "part").select("p_partkey", F.round(fx, 5).alias("fx"), F.round(cy, 5).alias("cy"), m[3][3].alias("corner"))


@register("g9_rebase", f"WITH {Q}, m AS (SELECT vec_id, a, b, c, {MATRIX} FROM q) SELECT vec_id, round(m00 * (a - 1) + m10 * (b - 2) + m20 * (c - 3), 5) AS tx, round(m01 * (a - 1) + m11 * (b - 2) + m21 * (c - 3), 5) AS ty, round(m00, 5) AS r00, round(m01, 5) AS r10 FROM m")
def g9(spark, d):
    df, e = _quaternions(spark, d)
    base = geometry.pose_matrix((F.lit(1.0), F.lit(2.0), F.lit(3.0)), tuple(e[:4]))
    still = geometry.pose_matrix(tuple(e[4:7]), (F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    m = geometry.rebase(base, still)
    return df.select("vec_id", *[F.round(c, 5).alias(n) for c, n in ((m[0][3], "tx"), (m[1][3], "ty"), (m[0][0], "r00"), (m[1][0], "r10"))])


@register("g11_interpolate", f"""WITH {FR}, len AS (SELECT ep, max(idx) FILTER (idx % 4 = 0) AS top FROM fr GROUP BY ep), k AS (SELECT ep, idx, v FROM fr WHERE idx % 4 = 0),
    q AS (SELECT fr.ep, idx, least(idx, top) AS pos, least(idx, top) - least(idx, top) % 4 AS low, top FROM fr JOIN len USING (ep))
    SELECT q.ep, q.idx::DOUBLE AS t, round(a.v + coalesce(b.v - a.v, 0) * (pos % 4) / 4.0, 5) AS x, round(sin(pos * 0.02), 5) AS qz, round(cos(pos * 0.02), 5) AS qw FROM q JOIN k a ON a.ep = q.ep AND a.idx = low LEFT JOIN k b ON b.ep = q.ep AND b.idx = low + 4 AND low + 4 <= top""")
def g11(spark, d):
    fr = frames(spark, d)
    half, zero = F.col("idx") * 0.02, F.lit(0.0)
    keys = fr.where("idx % 4 = 0").select("ep", F.col("idx").alias("t"), F.col("v").alias("x"), zero.alias("y"), zero.alias("z"), zero.alias("qx"), zero.alias("qy"), F.sin(half).alias("qz"), F.cos(half).alias("qw"))
    got = scene.interpolate(keys, fr.select("ep", F.col("idx").alias("t")))
    return got.select("ep", "t", *[F.round(c, 5).alias(c) for c in ("x", "qz", "qw")])


@register("g11_waypoint_times", f"WITH {FR}, l AS (SELECT ep, idx, idx::DOUBLE AS t, CASE WHEN idx = 0 THEN 0 ELSE greatest(1.0, abs(v - lag(v) OVER w) / 50) END AS leg FROM fr WINDOW w AS (PARTITION BY ep ORDER BY idx)) SELECT ep, idx, round(sum(leg) OVER (PARTITION BY ep ORDER BY idx ROWS UNBOUNDED PRECEDING), 5) AS time FROM l")
def g11_times(spark, d):
    zero, one = F.lit(0.0), F.lit(1.0)
    points = frames(spark, d).select("ep", "idx", F.col("idx").cast("double").alias("t"), F.col("v").alias("x"), *[zero.alias(c) for c in ("y", "z", "qx", "qy", "qz")], one.alias("qw"))
    return scene.waypoint_times(points, 50.0, 1.0).select("ep", "idx", F.round("time", 5).alias("time"))


COLORS = [(10, 20, 30), (40, 50, 60), (70, 80, 90)]


@register("g17_palette", "SELECT event_id, CASE event_id % 256 WHEN 0 THEN 10 WHEN 1 THEN 40 WHEN 2 THEN 70 END AS r, CASE event_id % 256 WHEN 0 THEN 30 WHEN 1 THEN 60 WHEN 2 THEN 90 END AS b FROM events")
def g17(spark, d):
    color = geometry.palette_color(F.col("event_id"), COLORS)
    return load(spark, d, "events").select("event_id", color.alias("c")).select("event_id", "c.r", "c.b")


@register("g21_six_d", f"WITH {Q}, m AS (SELECT vec_id, {MATRIX} FROM q) SELECT vec_id, {', '.join(f'round({n}, 5) AS {n}' for n in NAMES[:6])} FROM m")
def g21(spark, d):
    df, e = _quaternions(spark, d)
    rows = df.select("vec_id", geometry.convert_rotation(F.array(*e[:4]), "quaternion", "rotation_6d").alias("v"))
    return rows.select("vec_id", *[F.round(F.col("v")[k], 5).alias(n) for k, n in enumerate(NAMES[:6])])


@register("g21_round_trip", f"WITH {Q} SELECT vec_id, round(sign(w) * x, 4) AS qx, round(sign(w) * y, 4) AS qy, round(sign(w) * z, 4) AS qz, round(abs(w), 4) AS qw FROM q")
def g21_back(spark, d):
    df, e = _quaternions(spark, d)
    v, chain = F.array(*e[:4]), ("quaternion", "euler", "axis_angle", "rotation_6d", "quaternion")
    for source, target in itertools.pairwise(chain):
        v = geometry.convert_rotation(v, source, target)
    rows = df.select("vec_id", v.alias("v"))
    return rows.select("vec_id", *[F.round(F.signum(F.col("v")[0]) * F.col("v")[k], 4).alias(f"q{n}") for k, n in ((1, "x"), (2, "y"), (3, "z"), (0, "w"))])


@register("j14_circles_and_boxes", "SELECT s_suppkey AS circle, c_custkey AS box FROM supplier, customer WHERE pow(greatest(c_acctbal / 100 - s_acctbal / 100, s_acctbal / 100 - (c_acctbal / 100 + 5), 0), 2) + pow(greatest(c_custkey % 90 - s_suppkey % 100, s_suppkey % 100 - (c_custkey % 90 + 3), 0), 2) <= 4")
def j14(spark, d):
    circles = load(spark, d, "supplier").select(F.col("s_suppkey").alias("circle"), (F.col("s_acctbal") / 100).alias("x"), (F.col("s_suppkey") % 100).cast("double").alias("y"), F.lit(2.0).alias("r"))
    x, y = F.col("c_acctbal") / 100, (F.col("c_custkey") % 90).cast("double")
    boxes = load(spark, d, "customer").select(F.col("c_custkey").alias("box"), x.alias("x0"), y.alias("y0"), (x + 5).alias("x1"), (y + 3).alias("y1"))
    return joins.overlapping(circles, boxes, 8.0)


# ---- the clip composite ----------------------------------------------------------------------------------------------
def pixels(spark: SparkSession, d: str) -> DataFrame:
    df, e = _quaternions(spark, d)
    position = [c.alias(n) for c, n in zip(e[:3], "xyz", strict=True)]
    normal = [c.alias(n) for c, n in zip(e[3:6], ("nx", "ny", "nz"), strict=True)]
    w = F.when(e[6] > 0.2, 1.0).otherwise(0.0)
    return df.select(F.col("label").alias("clip"), F.floor(F.col("vec_id") / 8).alias("v"), (F.col("vec_id") % 8).alias("u"), *position, *normal, w.alias("w"), (F.col("vec_id") % 7 - 1).cast("int").alias("actor_id"), (F.col("vec_id") % 256).cast("int").alias("r"), F.lit(1).alias("g"), F.lit(2).alias("b"))


PIXELS = "px AS (SELECT label AS clip, vec_id // 8 AS v, vec_id % 8 AS u, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, CASE WHEN embedding[7] > 0.2 THEN 1 ELSE 0 END AS w, (vec_id % 7 - 1)::INT AS actor_id FROM embeddings)"


@register("p1_valid_pixels", f"WITH {PIXELS} SELECT clip, v, u, actor_id FROM px WHERE w < 1 AND actor_id IN (0, 1, 2, 3) AND actor_id <> 2")
def p1(spark, d):
    return filters.valid_pixels(pixels(spark, d), [0, 1, 2, 3], [2]).select("clip", "v", "u", "actor_id")


def turned(angle: F.Column, tx: F.Column, ty: F.Column, tz: F.Column) -> F.Column:
    return scene.as_array(geometry.pose_matrix((tx, ty, tz), (F.cos(angle / 2), F.lit(0.0), F.lit(0.0), F.sin(angle / 2))))


PARTS = [(0, 0, "cup", "cup", False), (1, 1, "lid", "cup", False), (2, 2, "link", "arm", True), (3, 2, "again", "arm", True), (4, -1, "none", "none", False)]


def scene_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    px = pixels(spark, d)
    clips = px.select("clip").distinct()
    cameras = clips.select("clip", turned(F.col("clip") * 0.3, F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("pose"))
    part = F.explode(F.array(*[F.struct(F.lit(p).alias("part_pos"), F.lit(a).alias("actor_id"), F.lit(n).alias("part_name"), F.lit(o).alias("object_name"), F.lit(r).alias("is_robot")) for p, a, n, o, r in PARTS])).alias("p")
    parts = clips.select("clip", part).select("clip", "p.*")
    times = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("t")
    poses = parts.select("clip", "part_pos", times)
    poses = poses.withColumn("pose", turned(F.col("t") * 0.5 + F.col("part_pos") * 0.2, F.col("t") * 1.0, F.col("part_pos") * 1.0, F.col("t") * 0.1))
    return px, cameras, parts, poses


SCENE = f"""{PIXELS}, wo AS (SELECT clip, v, u, actor_id, x * cos(clip * 0.3) - y * sin(clip * 0.3) + 1 AS x, x * sin(clip * 0.3) + y * cos(clip * 0.3) + 2 AS y, z + 3 AS z FROM px WHERE w < 1 AND actor_id <> 5),
    nb AS (SELECT *, row_number() OVER (PARTITION BY clip, actor_id ORDER BY v, u) - 1 AS nth, count(*) OVER (PARTITION BY clip, actor_id) AS n FROM wo),
    sb AS (SELECT clip, actor_id, i AS point, x, y, z FROM nb, generate_series(0, 4) g(i) WHERE CASE WHEN n <= 5 THEN i = nth ELSE nth = CASE WHEN i = 4 THEN n - 1 ELSE floor(i * ((n - 1) / 4.0::DOUBLE)) END END),
    nm AS (SELECT *, CASE actor_id WHEN 0 THEN 'cup' WHEN 1 THEN 'lid' WHEN 2 THEN 'robot__link' ELSE 'static_actor_' || actor_id END AS part_name FROM sb),
    lo AS (SELECT *, CASE WHEN actor_id IN (0, 1, 2) THEN x * cos(actor_id * 0.2) + (y - actor_id) * sin(actor_id * 0.2) ELSE x END AS lx, CASE WHEN actor_id IN (0, 1, 2) THEN -x * sin(actor_id * 0.2) + (y - actor_id) * cos(actor_id * 0.2) ELSE y END AS ly FROM nm)"""


@register("build_clip_flows", f"""WITH {SCENE}, fl AS (SELECT clip, part_name, point, t, actor_id IN (0, 1, 2) AS moves, t * 0.5 + actor_id * 0.2 AS a, lx, ly, z, actor_id FROM lo, generate_series(0, 2) g(t))
    SELECT clip, part_name, point, t, round(CASE WHEN moves THEN lx * cos(a) - ly * sin(a) + t ELSE lx END, 5) AS x, round(CASE WHEN moves THEN lx * sin(a) + ly * cos(a) + actor_id ELSE ly END, 5) AS y, round(CASE WHEN moves THEN z + t * 0.1 ELSE z END, 5) AS z FROM fl""")
def build_flows(spark, d):
    made = scene.build_clips(*scene_tables(spark, d), most=5, drop=[5])
    names = made["parts"].select("clip", "part", "part_name")
    return made["flows"].join(names, ["clip", "part"]).select("clip", "part_name", "point", "t", *[F.round(c, 5).alias(c) for c in "xyz"])


@register("build_clip_parts", f"WITH {PIXELS}, s AS (SELECT DISTINCT clip, actor_id FROM px WHERE w < 1 AND actor_id <> 5) SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY CASE WHEN actor_id IN (0, 1) THEN 0 WHEN actor_id = 2 THEN 1 ELSE 2 END, actor_id) - 1 AS part, CASE actor_id WHEN 0 THEN 'cup' WHEN 1 THEN 'lid' WHEN 2 THEN 'robot__link' ELSE 'static_actor_' || actor_id END AS part_name, CASE WHEN actor_id IN (0, 1) THEN 'task_object' WHEN actor_id = 2 THEN 'robot' ELSE 'static' END AS category, actor_id = 2 AS is_robot, actor_id FROM s")
def build_parts(spark, d):
    px, cameras, parts, _ = scene_tables(spark, d)
    return scene.clip_parts(filters.valid_pixels(px, None, [5]), parts, [5]).select("clip", "part", "part_name", "category", "is_robot", "actor_id")
