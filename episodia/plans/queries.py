"""The operators over the test tables, each beside its SQL.

Frames are events: an episode is a user, its frames are the events by time. Names begin with the survey's row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs, geometry, normalize, text
from ..functions.common import clip, hash_order, hash_uniform
from ..operators import filters, joins, sampling, stats, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FR = "fr AS (SELECT user_id AS ep, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS idx, value AS v, event_type AS kind, event_id, ts FROM events)"
LEN = "len AS (SELECT ep, count(*) AS n FROM fr GROUP BY ep)"
HASH = "(({0} * 2654435761) % 4294967296)"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("value").alias("v"), F.col("event_type").alias("kind"))
    return windows.number_frames(events, "user_id", "ts").select("ep", "idx", "v", "kind", "event_id", "ts")


def unit_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with a value in [0, 1): the last two digits of v."""
    return frames(spark, sf_dir).withColumn("g", F.pmod(F.round(F.col("v") * 100, 0).cast("long"), F.lit(100)) / 100.0)


UNIT = f"{FR}, un AS (SELECT *, ((round(v * 100, 0)::BIGINT % 100 + 100) % 100) / 100.0::DOUBLE AS g FROM fr)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dimensions(load(spark, sf_dir, "embeddings"), "embedding")


VEC = "ve AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)"


def joined(c: str, digits: int = 6) -> Column:
    return F.array_join(F.transform(c, lambda x: F.format_string(f"%.{digits}f", x.cast("double"))), ",")


# ---- windows ---------------------------------------------------------------------------------------------------------
def _clips_sql(length: int, stride: int, interval: int) -> str:
    reach = (length - 1) * interval + 1
    step = min(stride, reach)
    return f"""{FR}, {LEN}, cl AS (SELECT ep, n, unnest(generate_series(0, CASE WHEN n < {reach} THEN 0 ELSE (n - {reach}) // {step} + 1 END
        + CASE WHEN (CASE WHEN n < {reach} THEN 0 ELSE (n - {reach}) // {step} + 1 END) * {step} < n THEN 1 ELSE 0 END - 1)) AS clip FROM len),
        po AS (SELECT ep, clip, j, least(clip * {step} + j * {interval}, n - 1) AS idx, clip * {step} + j * {interval} > n - 1 AS is_pad FROM cl, generate_series(0, {length - 1}) g(j))"""


@register("w1_clips", f"WITH {_clips_sql(8, 4, 2)} SELECT ep, clip, j, idx, is_pad, v FROM po JOIN fr USING (ep, idx)")
def w1(spark, d):
    return windows.clips(frames(spark, d), 8, 4, 2).select("ep", "clip", "j", "idx", "is_pad", "v")


@register("w1_clips_wide_stride", f"WITH {_clips_sql(3, 50, 5)} SELECT ep, clip, count(*) AS size, count(*) FILTER (is_pad) AS pads FROM po GROUP BY ep, clip")
def w1_wide(spark, d):
    return windows.clip_positions(frames(spark, d), 3, 50, 5).groupBy("ep", "clip").agg(F.count(F.lit(1)).alias("size"), F.count_if("is_pad").alias("pads"))


@register("w2_clip_summary", f"WITH {_clips_sql(4, 2, 2)} SELECT ep, clip, string_agg(idx::VARCHAR, ',' ORDER BY j) AS frames, min(idx) AS start_frame, max(idx) AS end_frame, count(*) FILTER (is_pad) AS pads, max(v) AS top FROM po JOIN fr USING (ep, idx) GROUP BY ep, clip")
def w2(spark, d):
    return windows.clip_summary(windows.clips(frames(spark, d), 4, 2, 2), "v")


@register("w3_sequences", f"WITH {FR}, {LEN}, s AS (SELECT ep, n, unnest(generate_series(-2, n - 6 + 3)) AS start FROM len WHERE n - 6 + 3 >= -2) SELECT ep, start, j, greatest(least(start + j, n - 1), 0) AS idx FROM s, generate_series(0, 5) g(j)")
def w3(spark, d):
    return windows.sequence_positions(frames(spark, d), 6, 2, 3)


@register("w4_sequence_gather", f"WITH {FR}, {LEN}, s AS (SELECT ep, n, unnest(generate_series(-1, n - 4 + 3)) AS start FROM len), p AS (SELECT ep, start, j, greatest(least(start + j, n - 1), 0) AS idx FROM s, generate_series(0, 3) g(j)) SELECT ep, start, string_agg(event_id::VARCHAR, ',' ORDER BY j) AS ids FROM p JOIN fr USING (ep, idx) GROUP BY ep, start")
def w4(spark, d):
    got = windows.gather_sequences(frames(spark, d), "event_id", 4, 1, 3)
    return got.select("ep", "start", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("ids"))


@register("w6_forward_chunk", f"WITH {FR}, {LEN} SELECT a.ep, a.idx, string_agg(b.event_id::VARCHAR, ',' ORDER BY j) AS chunk FROM fr a JOIN len USING (ep), generate_series(0, 4) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = least(a.idx + j, n - 1) GROUP BY a.ep, a.idx")
def w6(spark, d):
    return windows.forward_chunk(frames(spark, d), "event_id", 5).select("ep", "idx", F.array_join(F.transform("chunk", lambda x: x.cast("string")), ",").alias("chunk"))


@register("w7_past_window", f"WITH {FR} SELECT a.ep, a.idx, string_agg(b.event_id::VARCHAR, ',' ORDER BY j DESC) AS past, count(*) FILTER (a.idx >= j) AS real FROM fr a, generate_series(0, 3) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = greatest(a.idx - j, 0) GROUP BY a.ep, a.idx")
def w7(spark, d):
    return windows.past_window(frames(spark, d), "event_id", 4).select("ep", "idx", F.array_join(F.transform("past", lambda x: x.cast("string")), ",").alias("past"), F.size(F.filter("mask", lambda m: m)).cast("long").alias("real"))


@register("w9_future_window", f"WITH {FR}, {LEN} SELECT a.ep, a.idx, string_agg(b.event_id::VARCHAR, ',' ORDER BY j) AS future, count(*) FILTER (a.idx + j < n) AS real FROM fr a JOIN len USING (ep), generate_series(1, 3) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = least(a.idx + j, n - 1) GROUP BY a.ep, a.idx")
def w9(spark, d):
    return windows.future_window(frames(spark, d), "event_id", 3).select("ep", "idx", F.array_join(F.transform("future", lambda x: x.cast("string")), ",").alias("future"), F.size(F.filter("mask", lambda m: m)).cast("long").alias("real"))


@register("w12_state_action", f"WITH {FR}, a AS (SELECT ep, idx, v AS state, lead(v) OVER (PARTITION BY ep ORDER BY idx) AS action FROM fr) SELECT * FROM a WHERE action IS NOT NULL")
def w12(spark, d):
    return windows.state_action(frames(spark, d), "v").select("ep", "idx", "state", "action")


@register("w13_relative_action", f"WITH {FR} SELECT ep, idx, round(coalesce(lead(v) OVER w - v, v - lag(v) OVER w), 6) AS delta FROM fr WINDOW w AS (PARTITION BY ep ORDER BY idx)")
def w13(spark, d):
    return windows.relative_action(frames(spark, d), "v").select("ep", "idx", F.round("delta", 6).alias("delta"))


@register("w15_binarize_gripper", f"WITH {UNIT}, b AS (SELECT *, CASE WHEN g > 0.95 THEN 1.0::DOUBLE WHEN g < 0.05 THEN 0.0::DOUBLE END AS b FROM un) SELECT ep, idx, coalesce(first_value(b IGNORE NULLS) OVER w, last_value(g) OVER w) AS gripper FROM b WINDOW w AS (PARTITION BY ep ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
def w15(spark, d):
    return windows.binarize_gripper(unit_frames(spark, d), "g").select("ep", "idx", "gripper")


@register("w16_relative_gripper", f"WITH {UNIT}, m AS (SELECT *, CASE WHEN g - 0.5 < -0.4 THEN 1.0::DOUBLE WHEN g - 0.5 > 0.4 THEN -1.0::DOUBLE END AS m FROM un) SELECT ep, idx, coalesce(last_value(m IGNORE NULLS) OVER (PARTITION BY ep ORDER BY idx ROWS UNBOUNDED PRECEDING), -first_value(m IGNORE NULLS) OVER (PARTITION BY ep ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1.0::DOUBLE) / 2 + 0.5::DOUBLE AS gripper FROM m")
def w16(spark, d):
    moved = unit_frames(spark, d).withColumn("g", F.col("g") - 0.5)
    return windows.relative_gripper_to_absolute(moved, "g", 0.4).select("ep", "idx", "gripper")


@register("w17_goal_relabel", f"WITH {FR}, {LEN} SELECT ep, idx, least(floor({HASH.format('event_id')} / 4294967296.0::DOUBLE * (n - idx - 1) + idx + 1)::BIGINT, n - 1) AS goal FROM fr JOIN len USING (ep)")
def w17(spark, d):
    return windows.goal_relabel(frames(spark, d), hash_uniform(F.col("event_id"))).select("ep", "idx", "goal")


@register("w18_previous_action", f"WITH {FR} SELECT ep, idx, coalesce(lag(v) OVER (PARTITION BY ep ORDER BY idx), 0.0::DOUBLE) AS state, v AS action FROM fr")
def w18(spark, d):
    return windows.previous_action(frames(spark, d), "v").select("ep", "idx", "state", "action")


@register("w20_moving_average", f"WITH {FR} SELECT ep, idx, round(sum(v) OVER (PARTITION BY ep ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 5) AS smooth FROM fr")
def w20(spark, d):
    return windows.moving_average(frames(spark, d), "v").select("ep", "idx", F.round("smooth", 5).alias("smooth"))


@register("w22_step_flags", f"WITH {FR}, {LEN} SELECT ep, idx, idx = 0 AS is_first, idx = n - 1 AS is_last, idx = n - 1 AS is_terminal, CASE WHEN idx = n - 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM fr JOIN len USING (ep)")
def w22(spark, d):
    return windows.step_flags(frames(spark, d)).select("ep", "idx", "is_first", "is_last", "is_terminal", "reward")


@register("w23_episode_ends", f"WITH {FR}, {LEN} SELECT ep, n AS length, sum(n) OVER (ORDER BY ep)::BIGINT AS episode_end FROM len")
def w23(spark, d):
    return windows.episode_ends(frames(spark, d))


@register("w26_stride", f"WITH {FR} SELECT ep, idx, event_id FROM fr WHERE idx % 5 = 0")
def w26(spark, d):
    return windows.subsample(frames(spark, d), 5).select("ep", "idx", "event_id")


@register("w27_sample_frames", f"WITH {FR}, r AS (SELECT ep, idx, row_number() OVER (PARTITION BY ep ORDER BY {HASH.format('event_id')}, idx) AS nth FROM fr) SELECT ep, idx FROM r WHERE nth <= 10")
def w27(spark, d):
    return windows.sample_frames(frames(spark, d), 10, hash_order(F.col("event_id"))).select("ep", "idx")


@register("w28_save_steps", f"WITH {FR}, {LEN} SELECT ep, idx FROM fr JOIN len USING (ep) WHERE idx % 15 = 0 OR idx = n - 1")
def w28(spark, d):
    return windows.save_steps(frames(spark, d), 15).select("ep", "idx")


# ---- joins -----------------------------------------------------------------------------------------------------------
@register("j1_history", f"""WITH {FR}, sp AS (SELECT ep, idx * 3 AS idx, v FROM fr), t AS (SELECT ep, idx AS t0, h, idx - h * 2 AS target FROM sp, generate_series(0, 4) g(h)),
    f AS (SELECT ep, min_by(v, idx) AS v0 FROM sp GROUP BY ep)
    SELECT t.ep, t0, h, target, coalesce(sp.v, v0) AS value, coalesce(sp.idx = target, false) OR h = 0 AS valid FROM t JOIN f USING (ep) ASOF LEFT JOIN sp ON t.ep = sp.ep AND t.target >= sp.idx""")
def j1(spark, d):
    sparse = frames(spark, d).select("ep", (F.col("idx") * 3).alias("idx"), "v")
    out = joins.history(sparse, sparse.select("ep", F.col("idx").alias("t0")), "v", 5, 2)
    return out.withColumn("valid", F.coalesce("valid", F.lit(False)))


@register("j1_every_frame", f"WITH {FR} SELECT a.ep, a.idx AS t0, h::INT AS h, a.idx - 2 * h AS target, b.v AS value, a.idx >= 2 * h AS valid FROM fr a, generate_series(0, 4) g(h) JOIN fr b ON b.ep = a.ep AND b.idx = greatest(a.idx - 2 * h, 0)")
def j1_every(spark, d):
    all_frames = frames(spark, d)
    return joins.history(all_frames, all_frames.select("ep", F.col("idx").alias("t0")), "v", 5, 2).withColumn("valid", F.coalesce("valid", F.lit(False)))


@register("j2_first_unpadded", f"WITH {_clips_sql(8, 4, 2)}, r AS (SELECT *, row_number() OVER (PARTITION BY ep, idx ORDER BY is_pad, CASE WHEN is_pad THEN -clip ELSE clip END, CASE WHEN is_pad THEN -j ELSE j END) AS nth FROM po) SELECT ep, idx, clip, is_pad FROM r WHERE nth = 1")
def j2(spark, d):
    at = F.when(F.col("is_pad"), -F.col("clip")).otherwise(F.col("clip"))
    within = F.when(F.col("is_pad"), -F.col("j")).otherwise(F.col("j"))
    pos = windows.clip_positions(frames(spark, d), 8, 4, 2)
    best = pos.groupBy("ep", "idx").agg(F.min_by(F.struct("clip", "is_pad"), F.struct("is_pad", at, within)).alias("b"))
    return best.select("ep", "idx", "b.clip", "b.is_pad")


@register("j3_forward_grid", """WITH b AS (SELECT user_id, floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600 + 1e-5)::BIGINT AS k, ts, event_id FROM events), f AS (SELECT user_id, k, min_by(event_id, ts) AS event_id FROM b GROUP BY user_id, k),
    g AS (SELECT user_id, unnest(generate_series(0, max(k))) AS k FROM f GROUP BY user_id)
    SELECT user_id, k, first_value(f.event_id IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM g LEFT JOIN f USING (user_id, k)""")
def j3(spark, d):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)
    events = load(spark, d, "events").select("user_id", "event_id", (micros / 1e6).alias("seconds"))
    return joins.forward_grid(events, "user_id", "seconds", "event_id", 3600.0)


@register("j7_static_parts", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def j7(spark, d):
    used = load(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return joins.static_rows(load(spark, d, "part"), used, "p_partkey").select("p_partkey", "p_name")


@register("j8_first_robot", "SELECT c_nationkey, min(c_custkey) AS c_custkey FROM customer WHERE c_acctbal >= 0 GROUP BY c_nationkey")
def j8(spark, d):
    return joins.first_of(load(spark, d, "customer").where("c_acctbal >= 0"), ["c_nationkey"], "c_custkey").select("c_nationkey", "c_custkey")


@register("j9_point_flow", "SELECT p_partkey AS part, l_suppkey AS point, t, (l_quantity + t * p_size)::DOUBLE AS x, (l_discount + t)::DOUBLE AS y, l_tax AS z FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity, l_discount, l_tax FROM lineitem) JOIN part ON l_partkey = p_partkey, generate_series(0, 2) g(t)")
def j9(spark, d):
    points = load(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("point"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.col("l_tax").alias("z")).distinct()
    t = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long")))
    poses = load(spark, d, "part").select(F.col("p_partkey").alias("part"), "p_size", t.alias("t")).select("part", "t", (F.col("t") * F.col("p_size")).cast("double").alias("tx"), F.col("t").cast("double").alias("ty"), F.lit(0.0).alias("tz"))
    return joins.flow(points, poses)


@register("j9_rigid_flow", """SELECT part, point, t, round(x * cos(a) - y * sin(a) + t, 6) AS x, round(x * sin(a) + y * cos(a) + p_size, 6) AS y, z FROM (SELECT l_partkey AS part, l_suppkey AS point, l_quantity::DOUBLE AS x, l_discount::DOUBLE AS y, l_tax::DOUBLE AS z FROM lineitem) JOIN part ON part = p_partkey,
    (SELECT t, t * pi() / 3 AS a FROM generate_series(0, 2) g(t))""")
def j9_rigid(spark, d):
    points = load(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("point"), *[F.col(c).cast("double").alias(n) for c, n in (("l_quantity", "x"), ("l_discount", "y"), ("l_tax", "z"))])
    t = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long")))
    half = F.col("t") * F.pi() / 6
    turned = {"qw": F.cos(half), "qx": F.lit(0.0), "qy": F.lit(0.0), "qz": F.sin(half)}
    poses = load(spark, d, "part").select(F.col("p_partkey").alias("part"), F.col("p_size").cast("double").alias("ty"), t.alias("t")).withColumns({"tx": F.col("t").cast("double"), "tz": F.lit(0.0), **turned})
    return joins.flow(points, poses).select("part", "point", "t", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "z")


@register("j12_global_index", f"WITH {FR}, {LEN}, e AS (SELECT ep, n, sum(n) OVER (ORDER BY ep)::BIGINT AS e FROM len) SELECT o_orderkey AS position, ep, o_orderkey - e + n AS start FROM orders JOIN e ON o_orderkey >= e - n AND o_orderkey < e")
def j12(spark, d):
    return joins.global_rows(frames(spark, d), load(spark, d, "orders").select(F.col("o_orderkey").alias("position")))


@register("j15_dataset_lookup", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j15(spark, d):
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    return joins.look_up(load(spark, d, "supplier"), (nation, "s_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")).select("s_suppkey", "n_name", "r_name")


# ---- aggregates ------------------------------------------------------------------------------------------------------
STATS = f"{VEC}, st AS (SELECT dim, avg(x) AS mean, stddev_pop(x) AS std, stddev_samp(x) AS std_samp, min(x) AS low, max(x) AS high, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99, count(x) AS n FROM ve GROUP BY dim)"


@register("a3_dataset_statistics", f"WITH {STATS} SELECT dim::INT AS dim, round(mean, 6) AS mean, round(std, 6) AS std, round(std_samp, 6) AS std_samp, low, high, round(q01, 6) AS q01, round(q99, 6) AS q99, n FROM st")
def a3(spark, d):
    s = stats.dataset_statistics(vectors(spark, d))
    return s.select("dim", *[F.round(c, 6).alias(c) for c in ("mean", "std", "std_samp")], "low", "high", F.round("q01", 6).alias("q01"), F.round("q99", 6).alias("q99"), "n")


@register("a5_nonzero_std", "SELECT p_brand, round(sqrt(greatest(sum(z * z) / greatest(count(*) FILTER (abs(z) > 1e-8), 1) - pow(sum(z) / count(*), 2) * count(*) / greatest(count(*) FILTER (abs(z) > 1e-8), 1), 0)), 6) AS std FROM (SELECT p_brand, (CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END)::DOUBLE AS z FROM part) GROUP BY p_brand")
def a5(spark, d):
    z = F.when(F.col("p_size") % 3 == 0, 0).otherwise(F.col("p_size")).cast("double")
    return stats.nonzero_std(load(spark, d, "part").select("p_brand", z.alias("z")), "p_brand", "z").withColumn("std", F.round("std", 6))


@register("a6_padded_statistics", f"WITH {FR}, {LEN}, w AS (SELECT v, CASE WHEN idx = n - 1 THEN 1 + (SELECT max(n) FROM len) - n ELSE 1 END::DOUBLE AS w FROM fr JOIN len USING (ep)) SELECT sum(w) AS n, round(sum(w * v) / sum(w), 6) AS mean, round(greatest(sqrt((sum(w * v * v) - sum(w * v) * sum(w * v) / sum(w)) / (sum(w) - 1)), 0.01), 6) AS std FROM w")
def a6(spark, d):
    return stats.padded_statistics(frames(spark, d), "v").select("n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@register("a9_episode_statistics", f"WITH {FR} SELECT ep, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(sqrt(avg(v * v)), 6) AS rms FROM fr GROUP BY ep")
def a9(spark, d):
    return stats.episode_statistics(frames(spark, d), "v").select("ep", *[F.round(c, 6).alias(c) for c in ("mean", "std", "rms")])


@register("a10_displacement", f"WITH {FR}, b AS (SELECT ep, v AS v0 FROM fr WHERE idx = 0) SELECT ep, round(max(abs(v - v0)), 6) AS max_moved, bool_or(abs(v - v0) > 1e-5) AS moving FROM fr JOIN b USING (ep) GROUP BY ep")
def a10(spark, d):
    return stats.displacement(frames(spark, d), "v").withColumn("max_moved", F.round("max_moved", 6))


@register("a11_most_moving", f"WITH {FR}, b AS (SELECT ep, max(v) - min(v) AS m FROM fr GROUP BY ep) SELECT ep, round(m, 6) AS motion FROM b ORDER BY m DESC, ep LIMIT 1")
def a11(spark, d):
    return stats.most_moving(frames(spark, d), "v").withColumn("motion", F.round("motion", 6))


@register("a13_names", "SELECT l_returnflag, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS names, count(*) AS points FROM lineitem GROUP BY l_returnflag")
def a13(spark, d):
    return stats.distinct_names(load(spark, d, "lineitem"), "l_returnflag", "l_linestatus").withColumn("names", F.array_join("names", ","))


@register("a14_manifest", "SELECT o_orderpriority AS split, count(*) AS clips, count(DISTINCT o_custkey) AS episodes, count(*) FILTER (o_orderstatus = 'F') AS complete FROM orders GROUP BY o_orderpriority")
def a14(spark, d):
    return stats.manifest(load(spark, d, "orders"), "o_orderpriority", "o_custkey", F.col("o_orderstatus") == "F")


@register("a15_running_success", "SELECT o_custkey, o_orderkey, count(*) OVER w AS trials, (sum((o_orderstatus = 'F')::INT) OVER w)::BIGINT AS successes, round(100.0::DOUBLE * sum((o_orderstatus = 'F')::INT) OVER w / count(*) OVER w, 1) AS rate FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)")
def a15(spark, d):
    trials = load(spark, d, "orders").withColumn("ok", F.col("o_orderstatus") == "F")
    return stats.running_success(trials, "o_custkey", "o_orderkey", "ok").select("o_custkey", "o_orderkey", "trials", "successes", "rate")


@register("a16_most_frequent", "SELECT event_type, n FROM (SELECT event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY event_type) ORDER BY n DESC, f LIMIT 1")
def a16(spark, d):
    return stats.most_frequent(load(spark, d, "events"), "event_type", "event_id")


@register("a18_contiguous_prefix", "WITH s AS (SELECT DISTINCT l_orderkey, l_linenumber - 1 AS i FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) - 1 AS nth FROM s) SELECT l_orderkey, count(*) FILTER (i = nth) AS prefix, count(*) FILTER (i <> nth) > 0 AS holes FROM r GROUP BY l_orderkey")
def a18(spark, d):
    return stats.contiguous_prefix(load(spark, d, "lineitem").withColumn("i", F.col("l_linenumber") - 1), "l_orderkey", "i")


@register("a20_sliding_mean", f"WITH {FR} SELECT ep, idx, round(avg(v) OVER (PARTITION BY ep ORDER BY idx ROWS 9 PRECEDING), 5) AS mean FROM fr")
def a20(spark, d):
    return windows.sliding_mean(frames(spark, d), "v", 10).select("ep", "idx", F.round("mean", 5).alias("mean"))


@register("a21_pooled_statistics", f"WITH {FR}, p AS (SELECT kind, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std FROM fr GROUP BY kind) SELECT round(sum(n * mean) / sum(n), 6) AS mean, round(sqrt(greatest(sum((n - 1) * (std * std + mean * mean)) / sum(n) - pow(sum(n * mean) / sum(n), 2), 0)), 6) AS std, sum(n)::BIGINT AS n FROM p")
def a21(spark, d):
    parts = frames(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    return stats.pooled_statistics(parts).select(F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "n")


# ---- filters ---------------------------------------------------------------------------------------------------------
@register("p3_integrity", "SELECT l_orderkey, l_partkey, l_suppkey, string_agg(issue, ';' ORDER BY issue) AS issues FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, unnest(list_filter([CASE WHEN l_quantity > 45 THEN 'quantity' END, CASE WHEN l_discount > 0.08 THEN 'discount' END], lambda x: x IS NOT NULL)) AS issue FROM lineitem) GROUP BY ALL")
def p3(spark, d):
    checks = {"quantity": F.col("l_quantity") > 45, "discount": F.col("l_discount") > 0.08}
    return filters.issues_by(load(spark, d, "lineitem").distinct(), checks, "l_orderkey", "l_partkey", "l_suppkey").withColumn("issues", F.array_join("issues", ";"))


@register("p4_min_motion", f"WITH {_clips_sql(8, 4, 2)}, m AS (SELECT ep, clip, max(v) - min(v) AS motion FROM po JOIN fr USING (ep, idx) GROUP BY ep, clip) SELECT ep, clip, row_number() OVER (PARTITION BY ep ORDER BY clip) - 1 AS ordinal FROM m WHERE motion >= 60")
def p4(spark, d):
    return filters.moving_clips(windows.clips(frames(spark, d), 8, 4, 2), "v", 60).select("ep", "clip", "ordinal")


@register("p5_labelled_episodes", "SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM conversations WHERE length(text) > 1200)")
def p5(spark, d):
    return filters.labelled_episodes(load(spark, d, "conversations"), "conv_id", F.length("text") > 1200).select("conv_id", "turn")


@register("p6_bounded_episodes", f"WITH {FR} SELECT ep, count(*) AS n FROM fr GROUP BY ep HAVING bool_and(abs(v) <= 400)")
def p6(spark, d):
    return filters.bounded_episodes(frames(spark, d), "v", 400)


@register("p8_success_path", "SELECT url FROM pages WHERE regexp_full_match(url, '.*utm_source.*')")
def p8(spark, d):
    return filters.matching_paths(load(spark, d, "pages"), "url", ".*utm_source.*").select("url")


@register("p9_frame_ranges", f"WITH {FR}, r AS (SELECT c_custkey AS ep, c_nationkey AS a, c_nationkey + 10 AS b FROM customer) SELECT ep, idx FROM fr WHERE EXISTS (SELECT 1 FROM r WHERE r.ep = fr.ep AND fr.idx >= a AND fr.idx < b)")
def p9(spark, d):
    r = load(spark, d, "customer").select(F.col("c_custkey").alias("ep"), F.col("c_nationkey").alias("begin"), (F.col("c_nationkey") + 10).alias("end"))
    return filters.in_ranges(frames(spark, d), r).select("ep", "idx")


@register("p11_episode_length", f"WITH {FR}, {LEN}, r AS (SELECT ep, idx, n, row_number() OVER (PARTITION BY ep ORDER BY {HASH.format('event_id')}, idx) AS nth FROM fr JOIN len USING (ep)) SELECT ep, idx FROM r WHERE n >= 60 AND nth <= 70")
def p11(spark, d):
    return windows.sample_frames(filters.episode_lengths(frames(spark, d), 60), 70, hash_order(F.col("event_id"))).select("ep", "idx")


@register("p12_skip_still_start", f"WITH {FR}, b AS (SELECT ep, v AS v0 FROM fr WHERE idx = 0), s AS (SELECT ep, min(idx) - 1 AS s FROM fr JOIN b USING (ep) WHERE abs(v - v0) > 20 GROUP BY ep) SELECT ep, idx FROM fr JOIN s USING (ep) WHERE idx >= s")
def p12(spark, d):
    return windows.skip_still_start(frames(spark, d), "v", 20).select("ep", "idx")


@register("p20_crop", "SELECT vec_id FROM embeddings WHERE embedding[1] BETWEEN -0.1 AND 0.1 AND embedding[2] BETWEEN -0.1 AND 0.1 AND embedding[3] BETWEEN -0.1 AND 0.1")
def p20(spark, d):
    point = tuple(F.col("embedding")[k].cast("double") for k in range(3))
    return filters.within_box(load(spark, d, "embeddings"), point, (-0.1,) * 3, (0.1,) * 3).select("vec_id")


# ---- samples and splits ----------------------------------------------------------------------------------------------
@register("t1_even_subsample", f"WITH {FR}, {LEN} SELECT ep, i, CASE WHEN n <= 12 THEN i WHEN i = 11 THEN n - 1 ELSE floor(i * ((n - 1) / 11.0::DOUBLE))::BIGINT END AS idx FROM len, generate_series(0, 11) g(i) WHERE n > 12 OR i < n")
def t1(spark, d):
    n = windows.lengths(frames(spark, d))
    return n.select("ep", F.posexplode(sampling.even_positions(F.col("n"), 12)).alias("i", "idx")).withColumn("i", F.col("i").cast("long"))


@register("t4_top_k", "SELECT * FROM (SELECT l_suppkey, l_orderkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_quantity) AS rank FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_extendedprice, l_partkey, l_quantity FROM lineitem)) WHERE rank <= 3")
def t4(spark, d):
    rows = load(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice", "l_partkey", "l_quantity").distinct().withColumn("order", F.struct("l_orderkey", "l_partkey", "l_quantity"))
    return sampling.top_k(rows, "l_suppkey", "l_extendedprice", "order", 3).select("l_suppkey", "l_orderkey", "l_extendedprice", F.col("rank").cast("long").alias("rank"))


@register("t7_weighted_source", f"SELECT event_id, CASE WHEN {HASH.format('event_id')} / 4294967296.0::DOUBLE < 0.5 THEN 'a' WHEN {HASH.format('event_id')} / 4294967296.0::DOUBLE < 0.75 THEN 'b' ELSE 'c' END AS source FROM events")
def t7(spark, d):
    return sampling.weighted_source(load(spark, d, "events").select("event_id"), {"a": 2.0, "b": 1.0, "c": 1.0}, hash_uniform(F.col("event_id")))


@register("t9_shuffled_head", f"SELECT event_id FROM events ORDER BY {HASH.format('event_id')}, event_id LIMIT 100")
def t9(spark, d):
    return sampling.shuffled_head(load(spark, d, "events").select("event_id"), hash_order(F.col("event_id")), "event_id", 100)


@register("t12_episode_split", f"WITH e AS (SELECT DISTINCT user_id AS ep FROM events) SELECT ep, row_number() OVER (ORDER BY {HASH.format('ep')}, ep) > count(*) OVER () - ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM e")
def t12(spark, d):
    return sampling.split_episodes(load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct(), "ep", 0.2, hash_order(F.col("ep")))


@register("t13_last_episode", "SELECT DISTINCT user_id AS ep, user_id = (SELECT max(user_id) FROM events) AS is_val FROM events")
def t13(spark, d):
    return sampling.last_episode(load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct(), "ep")


@register("t14_floor_split", "SELECT user_id AS ep, row_number() OVER (ORDER BY user_id) <= floor(count(*) OVER () * 0.8::DOUBLE) AS is_train FROM (SELECT DISTINCT user_id FROM events)")
def t14(spark, d):
    return sampling.floor_split(load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct(), "ep")


@register("t20_batches", "SELECT s_suppkey, ntile(7) OVER (ORDER BY s_suppkey) - 1 AS batch FROM supplier")
def t20(spark, d):
    return sampling.deal_batches(load(spark, d, "supplier"), 7, "s_suppkey").select("s_suppkey", F.col("batch").cast("long").alias("batch"))


# ---- sets ------------------------------------------------------------------------------------------------------------
@register("u1_concatenate", "SELECT 'c' AS part, c_custkey AS id FROM customer UNION ALL SELECT 's', s_suppkey FROM supplier")
def u1(spark, d):
    parts = {"c": load(spark, d, "customer").select(F.col("c_custkey").alias("id")), "s": load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))}
    return joins.concatenate(parts, "part")


@register("u2_difference", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def u2(spark, d):
    used = load(spark, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    return joins.static_rows(load(spark, d, "customer").select(F.col("c_custkey").alias("id")).distinct(), used, "id")


# ---- normalization ---------------------------------------------------------------------------------------------------
def _with_stats(spark: SparkSession, d: str) -> DataFrame:
    v = vectors(spark, d).select("vec_id", "dim", "x")
    return v.join(F.broadcast(stats.dataset_statistics(v)), "dim")  # one row per dimension


@register("n1_limits", f"WITH {STATS}, s AS (SELECT *, CASE WHEN high - low < 1e-4 THEN 1.0 ELSE 2.0::DOUBLE / (high - low) END AS sc FROM st) SELECT vec_id, dim::INT AS dim, round(x * sc + (-1.0 - sc * low), 5) AS y FROM ve JOIN s USING (dim)")
def n1(spark, d):
    scale, offset = normalize.limits_scale(F.col("low"), F.col("high"))
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.apply_scale(F.col("x"), scale, offset), 5).alias("y"))


@register("n3_gaussian", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round((x - mean) / std_samp, 5) AS y FROM ve JOIN st USING (dim)")
def n3(spark, d):
    scale, offset = normalize.gaussian_scale(F.col("mean"), F.col("std_samp"))
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.apply_scale(F.col("x"), scale, offset), 5).alias("y"))


@register("n7_masked_normal", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(CASE WHEN dim % 2 = 0 THEN (x - mean) / (std + 1e-8) ELSE x END, 5) AS y FROM ve JOIN st USING (dim)")
def n7(spark, d):
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.normal(F.col("x"), F.col("mean"), F.col("std"), F.col("dim") % 2 == 0), 5).alias("y"))


@register("n8_bounds_q99", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(CASE WHEN q01 = q99 THEN 0 WHEN dim <> 5 THEN greatest(least(2 * (x - q01) / (q99 - q01 + 1e-8) - 1, 1), -1) ELSE x END, 5) AS y FROM ve JOIN st USING (dim)")
def n8(spark, d):
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.bounds(F.col("x"), F.col("q01"), F.col("q99"), F.col("dim") != 5), 5).alias("y"))


@register("n9_quantile_round_trip", f"WITH {VEC} SELECT vec_id, dim::INT AS dim, round(x, 5) AS x FROM ve")
def n9(spark, d):
    y = normalize.quantile_range(F.col("x"), F.col("q01"), F.col("q99"))
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.quantile_range_inverse(y, F.col("q01"), F.col("q99")), 5).alias("x"))


@register("n18_quantize_normal", f"WITH {VEC} SELECT vec_id, dim::INT AS dim, round_even(greatest(least(x, 1), -1) * 127, 0)::TINYINT AS q FROM ve")
def n18(spark, d):
    return vectors(spark, d).select("vec_id", "dim", normalize.quantize_normal(F.col("x")).alias("q"))


@register("n20_action_tokens", f"WITH {VEC}, e AS (SELECT list_transform(generate_series(0, 255), lambda i: CASE WHEN i = 255 THEN 1.0::DOUBLE ELSE i * (2.0::DOUBLE / 255) - 1.0 END) AS e) SELECT vec_id, dim::INT AS dim, (32000 - len(list_filter(e, lambda b: b <= greatest(least(x, 1.0::DOUBLE), -1.0::DOUBLE))))::INT AS token FROM ve, e")
def n20(spark, d):
    return vectors(spark, d).select("vec_id", "dim", normalize.action_token(F.col("x")).alias("token"))


@register("n20_all_dims", f"WITH {VEC} SELECT vec_id, string_agg((31999 - floor((greatest(least(x, 1), -1) + 1) / (2.0::DOUBLE / 255) + 1e-9))::INT::VARCHAR, ',' ORDER BY dim) AS tokens FROM ve GROUP BY vec_id")
def n20_all(spark, d):
    tokens = codecs.even_tokens(F.col("embedding").cast("array<double>"))
    return load(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(tokens, lambda x: x.cast("string")), ",").alias("tokens"))


# ---- geometry and text -----------------------------------------------------------------------------------------------
Q = "q AS (SELECT vec_id, e[1]/n AS w, e[2]/n AS x, e[3]/n AS y, e[4]/n AS z, e[5] AS a, e[6] AS b, e[7] AS c FROM (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(embedding[1]::DOUBLE*embedding[1] + embedding[2]::DOUBLE*embedding[2] + embedding[3]::DOUBLE*embedding[3] + embedding[4]::DOUBLE*embedding[4]) AS n FROM embeddings))"


def _quaternions(spark: SparkSession, d: str) -> tuple[DataFrame, list]:
    return load(spark, d, "embeddings"), [F.col("embedding")[k].cast("double") for k in range(10)]


@register("g4_rotate", f"WITH {Q} SELECT vec_id, round((1-2*(y*y+z*z))*a + 2*(x*y-z*w)*b + 2*(x*z+y*w)*c + 1, 6) AS px, round(2*(x*y+z*w)*a + (1-2*(x*x+z*z))*b + 2*(y*z-x*w)*c + 2, 6) AS py, round(2*(x*z-y*w)*a + 2*(y*z+x*w)*b + (1-2*(x*x+y*y))*c + 3, 6) AS pz FROM q")
def g4(spark, d):
    df, e = _quaternions(spark, d)
    p = geometry.transform_point(geometry.quaternion_matrix(*e[:4]), (F.lit(1.0), F.lit(2.0), F.lit(3.0)), tuple(e[4:7]))
    return df.select("vec_id", *[F.round(c, 6).alias(n) for c, n in zip(p, ("px", "py", "pz"), strict=True)])


@register("g5_round_trip", "SELECT vec_id, round(embedding[5]::DOUBLE, 6) AS x, round(embedding[6]::DOUBLE, 6) AS y, round(embedding[7]::DOUBLE, 6) AS z FROM embeddings")
def g5(spark, d):
    df, e = _quaternions(spark, d)
    m, t = geometry.quaternion_matrix(*e[:4]), tuple(e[7:10])
    df = df.select("vec_id", "embedding", *[c.alias(n) for c, n in zip(geometry.transform_point(m, t, tuple(e[4:7])), ("wx", "wy", "wz"), strict=True)])
    p = geometry.to_local(m, t, (F.col("wx"), F.col("wy"), F.col("wz")))
    return df.select("vec_id", *[F.round(c, 6).alias(n) for c, n in zip(p, ("x", "y", "z"), strict=True)])


@register("g12_quaternion_angle", f"WITH {Q} SELECT vec_id, round(2 * acos(least(abs(w), 1)) / pi(), 6) AS angle FROM q")
def g12(spark, d):
    df, e = _quaternions(spark, d)
    norm = F.sqrt(e[0] * e[0] + e[1] * e[1] + e[2] * e[2] + e[3] * e[3])
    return df.select("vec_id", F.round(geometry.quaternion_angle(e[0] / norm), 6).alias("angle"))


@register("x5_cyclic_fill", "WITH t AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS m FROM conversations) SELECT conv_id, k, md5(text) AS text FROM t, generate_series(0, 9) g(k) WHERE k % m = i")
def x5(spark, d):
    lists = load(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda r: r.text).alias("texts"))
    return lists.select("conv_id", F.posexplode(text.fill_cyclic(F.col("texts"), 10)).alias("k", "text")).select("conv_id", F.col("k").cast("long").alias("k"), F.md5("text").alias("text"))


@register("x7_capitalize", "SELECT event_id, upper(event_type[1]) || event_type[2:] || '.' AS sentence FROM events")
def x7(spark, d):
    return load(spark, d, "events").select("event_id", text.capitalize_sentence(F.col("event_type")).alias("sentence"))


@register("x8_safe_name", "SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_brand || ' ' || p_name || '#', '[^A-Za-z0-9.-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'unnamed') AS name FROM part")
def x8(spark, d):
    return load(spark, d, "part").select("p_partkey", text.safe_name(F.concat("p_brand", F.lit(" "), "p_name", F.lit("#"))).alias("name"))


@register("x11_episode_number", "SELECT c_custkey, coalesce(try_cast(nullif(regexp_extract(c_name, '([0-9]+)$', 1), '') AS BIGINT), 1000000000000) AS number, printf('clip%06d', c_custkey) AS clip FROM customer")
def x11(spark, d):
    return load(spark, d, "customer").select("c_custkey", text.episode_number(F.col("c_name")).alias("number"), F.format_string("clip%06d", "c_custkey").alias("clip"))


@register("x13_json", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def x13(spark, d):
    return load(spark, d, "events").select("event_id", text.json_fields(F.col("props"), "k bigint").k.alias("k"))


@register("x22_condition_dropout", f"SELECT event_id, CASE WHEN {HASH.format('(event_id + 1)')} / 4294967296.0::DOUBLE < 0.1 THEN '' ELSE event_type END AS instruction, CASE WHEN {HASH.format('(event_id + 2)')} / 4294967296.0::DOUBLE < 0.1 THEN 0.0 ELSE value END::DOUBLE AS state FROM events")
def x22(spark, d):
    key, named = F.col("event_id"), F.col("event_type").alias("instruction")
    rows = load(spark, d, "events").select("event_id", named, F.col("value").alias("state"))
    return filters.drop_conditions(rows, {"instruction": (hash_uniform(key, 1), F.lit("")), "state": (hash_uniform(key, 2), F.lit(0.0))}, 0.1)


@register("n16_invert_clip", f"WITH {UNIT} SELECT ep, idx, round(1 - greatest(least(g * 2, 1), 0), 6) AS gripper FROM un")
def n16(spark, d):
    return unit_frames(spark, d).select("ep", "idx", F.round(normalize.invert_gripper(clip(F.col("g") * 2, 0.0, 1.0)), 6).alias("gripper"))
