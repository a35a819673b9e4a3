"""More operators over the test tables, each beside its SQL: aligned lookups, action codecs, geometry, collation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, normalize, text
from ..functions.common import hash_uniform
from ..operators import filters, joins, sampling, schema, stats, transforms, windows
from ..sources import episodes
from .queries import FR, HASH, LEN, STATS, UNIT, VEC, _quaternions, _with_stats, frames, load, register, unit_frames, vectors


def as_text(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def rounded(columns, *names: str) -> list:
    return [F.round(c, 6).alias(n) for c, n in zip(columns, names, strict=True)]


# ---- sources ---------------------------------------------------------------------------------------------------------
@register("s5_contiguous_frames", "SELECT l_orderkey AS episode, max(l_linenumber) = count(DISTINCT l_linenumber) AND min(l_linenumber) = 1 AS contiguous FROM lineitem GROUP BY l_orderkey")
def s5(spark, d):
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("ep"), (F.col("l_linenumber") - 1).alias("idx"))
    return episodes.contiguous(rows).withColumnRenamed("ep", "episode")


@register("s19_log_lines", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events WHERE contains(props, '\"k\": 6') OR contains(props, '\"k\": 7')")
def s19(spark, d):
    found = episodes.parse_lines(load(spark, d, "events"), "props", ['"k": 6', '"k": 7'], "k bigint")
    return found.select("event_id", "row.k")


@register("s23_next_states", f"""WITH {FR}, {LEN} SELECT a.ep, a.idx, '{{"id":"' || a.ep || '_' || a.idx || '","states":"' || string_agg(b.kind, ' ' ORDER BY j) || '"}}' AS line
    FROM fr a JOIN len USING (ep), generate_series(0, 3) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = least(a.idx + j, n - 1) GROUP BY a.ep, a.idx""")
def s23(spark, d):
    rows = windows.forward_chunk(frames(spark, d), "kind", 4)
    line = F.to_json(F.struct(F.concat_ws("_", F.col("ep").cast("string"), F.col("idx").cast("string")).alias("id"), F.array_join("chunk", " ").alias("states")))
    return rows.select("ep", "idx", line.alias("line"))


# ---- projections -----------------------------------------------------------------------------------------------------
@register("p10_success_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def p10(spark, d):
    return filters.successful(load(spark, d, "orders"), F.col("o_orderstatus") == "F", F.col("o_totalprice") > 1000).select("o_orderkey")


@register("p13_rename", "SELECT c_custkey AS episode, c_name AS attr_name, c_nationkey AS attr_nationkey, c_acctbal AS attr_acctbal FROM customer")
def p13(spark, d):
    return schema.rename_columns(load(spark, d, "customer"), {"c_custkey": "episode", "c_mkt.*": None, "c_(.*)": r"attr_\1"})


@register("p14_repack", "SELECT c_custkey, c_nationkey + c_acctbal AS total FROM customer")
def p14(spark, d):
    packed = transforms.repack(load(spark, d, "customer"), {"c_custkey": "c_custkey", "state": {"a": "c_nationkey", "b": {"c": "c_acctbal"}}})
    return packed.select("c_custkey", (F.col("state.a") + F.col("state.b.c")).alias("total"))


@register("p17_default_prompt", "SELECT conv_id, turn, md5(coalesce(nullif(text, ''), 'be good')) AS prompt FROM conversations")
def p17(spark, d):
    return load(spark, d, "conversations").select("conv_id", "turn", F.md5(text.default_text(F.col("text"), "be good")).alias("prompt"))


@register("p19_drop_episode", "SELECT event_id, CASE WHEN user_id = (SELECT max(user_id) FROM events) THEN 3 ELSE user_id END AS ep FROM events WHERE user_id <> 3")
def p19(spark, d):
    return filters.swap_in_last(load(spark, d, "events"), "user_id", 3).select("event_id", F.col("user_id").alias("ep"))


@register("x14_flatten", "SELECT event_id AS \"id\", user_id AS \"who/user\", event_type AS \"who/what/kind\" FROM events")
def x14(spark, d):
    nested = load(spark, d, "events").select(F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("kind")).alias("what")).alias("who"))
    return schema.flatten_structs(nested)


# ---- lookups ---------------------------------------------------------------------------------------------------------
@register("j4_aligned_grid", """WITH b AS (SELECT user_id, floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600 + 1e-5)::BIGINT AS k, ts, event_id FROM events), f AS (SELECT user_id, k, min_by(event_id, ts) AS event_id FROM b GROUP BY user_id, k),
    g AS (SELECT user_id, unnest(generate_series(0, max(k))) AS k FROM f GROUP BY user_id),
    v AS (SELECT user_id, k, first_value(f.event_id IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM g LEFT JOIN f USING (user_id, k)),
    t AS (SELECT user_id, max(k) AS top FROM v GROUP BY user_id)
    SELECT t.user_id, s.k, v.value FROM t, generate_series(0, 799) s(k) JOIN v ON v.user_id = t.user_id AND v.k = least(s.k, top)""")
def j4(spark, d):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)
    events = load(spark, d, "events").select("user_id", "event_id", (micros / 1e6).alias("seconds"))
    return joins.aligned_grid(events, "user_id", "seconds", "event_id", 3600.0, 800)


@register("j5_latest_wins", "SELECT user_id, date_trunc('hour', ts) AS slot, max_by(value, event_id) AS value, count(*) AS writes FROM events GROUP BY user_id, date_trunc('hour', ts)")
def j5(spark, d):
    slots = load(spark, d, "events").withColumn("slot", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return joins.latest_wins(slots, ["user_id", "slot"], "value", "event_id")


@register("j6_visible_points", "SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25")
def j6(spark, d):
    visible = load(spark, d, "part").where("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.visible_points(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), visible, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@register("j10_metadata_issues", "SELECT l_partkey AS part, points, CASE WHEN p_size IS NULL THEN 'missing' WHEN points <> p_size THEN 'count' ELSE '' END AS issue FROM (SELECT l_partkey, count(*) AS points FROM lineitem GROUP BY l_partkey) LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey")
def j10(spark, d):
    found = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.count(F.lit(1)).alias("points"))
    metadata = load(spark, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("part"), "p_size")
    return joins.metadata_issues(found, metadata, "part", "points", "p_size").select("part", "points", "issue")


@register("j13_unused_models", "SELECT p_partkey FROM part WHERE (p_brand, p_size) NOT IN (SELECT (p_brand, p_size) FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_quantity >= 50 AND l_discount > 0.09)")
def j13(spark, d):
    used = load(spark, d, "lineitem").where("l_quantity >= 50 and l_discount > 0.09").select(F.col("l_partkey").alias("p_partkey"))
    return joins.unused_models(load(spark, d, "part"), used, "p_partkey", "p_brand", "p_size").select("p_partkey")


# ---- aggregates ------------------------------------------------------------------------------------------------------
@register("a4_histogram_quantiles", f"""WITH {VEC}, e AS (SELECT dim, min(x) AS low, max(x) AS high, count(x) AS n FROM ve GROUP BY dim), w AS (SELECT *, CASE WHEN high > low THEN high - low ELSE 1.0::DOUBLE END AS wide FROM e),
    c AS (SELECT dim, low, wide, n, least(floor((x - low) / wide * 5000), 4999) AS bin, count(*) AS size FROM ve JOIN w USING (dim) GROUP BY ALL),
    u AS (SELECT *, sum(size) OVER (PARTITION BY dim ORDER BY bin) AS upto FROM c) SELECT dim::INT AS dim, round(min(low + bin * wide / 5000), 6) AS quantile FROM u WHERE upto >= n * 0.99::DOUBLE GROUP BY dim""")
def a4(spark, d):
    return stats.histogram_quantiles(vectors(spark, d).select("dim", "x"), 0.99).withColumn("quantile", F.round("quantile", 6))


@register("a7_bounds", f"WITH {STATS} SELECT dim::INT AS dim, round(low - 1e-4, 6) AS low, round(high + 1e-4, 6) AS high FROM st")
def a7(spark, d):
    return stats.widened_bounds(vectors(spark, d)).select("dim", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@register("a8_bucket_statistics", "SELECT CASE WHEN contains(url, 'utm_') THEN 'tracked' WHEN contains(url, '?') THEN 'query' ELSE 'plain' END AS bucket, count(*) AS n, round(avg(length(html)), 5) AS mean, round(stddev_pop(length(html)), 5) AS std FROM pages GROUP BY ALL")
def a8(spark, d):
    got = stats.bucket_statistics(load(spark, d, "pages"), "url", F.length("html"), {"utm_": "tracked", "?": "query"}, "plain")
    return got.select("bucket", "n", F.round("mean", 5).alias("mean"), F.round("std", 5).alias("std"))


@register("a12_point_counts", "SELECT l_partkey AS part, count(*) AS points FROM lineitem GROUP BY l_partkey")
def a12(spark, d):
    return stats.point_counts(load(spark, d, "lineitem").withColumnRenamed("l_partkey", "part"), "part")


@register("a17_plan_totals", "SELECT count(DISTINCT o_custkey) AS tasks, count(*) AS episodes, count(*) FILTER (o_orderstatus <> 'F') AS pending FROM orders")
def a17(spark, d):
    return stats.plan_totals(load(spark, d, "orders"), "o_custkey", F.col("o_orderstatus") != "F")


@register("a19_mean_of_fields", "SELECT event_type, round(avg((props->>'$.k')::BIGINT), 6) AS k, round(avg(value), 6) AS value FROM events GROUP BY event_type")
def a19(spark, d):
    fields = {"k": text.json_fields(F.col("props"), "k bigint").k, "value": F.col("value")}
    return stats.mean_of_fields(load(spark, d, "events"), "event_type", fields).select("event_type", F.round("k", 6).alias("k"), F.round("value", 6).alias("value"))


# ---- sequences -------------------------------------------------------------------------------------------------------
@register("w10_future_actions", f"WITH {FR}, {LEN} SELECT a.ep, a.idx, string_agg(b.kind, ',' ORDER BY j) AS actions FROM fr a JOIN len USING (ep), generate_series(1, 4) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = least(a.idx + j, n - 1) GROUP BY a.ep, a.idx")
def w10(spark, d):
    return windows.future_window(frames(spark, d), "kind", 4).select("ep", "idx", F.array_join("future", ",").alias("actions"))


@register("w14_step_difference", f"WITH {UNIT}, s AS (SELECT ep, idx, lead(v) OVER (PARTITION BY ep ORDER BY idx) - v AS delta, g FROM un) SELECT ep, idx, round(delta, 6) AS delta, g AS gripper FROM s WHERE delta IS NOT NULL")
def w14(spark, d):
    return windows.step_difference(unit_frames(spark, d), "v").select("ep", "idx", F.round("delta", 6).alias("delta"), F.col("g").alias("gripper"))


@register("w24_episode_slice", f"WITH {FR} SELECT ep, idx - 5 AS idx, event_id FROM fr WHERE ep < (SELECT max(user_id) FROM events) AND idx BETWEEN 5 AND 24")
def w24(spark, d):
    return windows.slice_episodes(windows.drop_last_episode(frames(spark, d)), 5, 25).select("ep", "idx", "event_id")


@register("w25_unsettled", f"WITH {FR}, f AS (SELECT ep, count(*) AS n, max_by(v, idx) AS f FROM fr GROUP BY ep) SELECT ep, bool_or(abs(v - f) > 150) AS unsettled FROM fr JOIN f USING (ep) WHERE idx >= n - 20 GROUP BY ep")
def w25(spark, d):
    return windows.unsettled(frames(spark, d), "v", 20, 150.0)


@register("r5_ring", f"WITH {FR} SELECT a.ep, a.idx, string_agg(b.event_id::VARCHAR, ',' ORDER BY b.idx) AS ring FROM fr a JOIN fr b ON b.ep = a.ep AND b.idx BETWEEN a.idx - 3 AND a.idx GROUP BY a.ep, a.idx")
def r5(spark, d):
    return windows.recent(frames(spark, d), "event_id", 4).select("ep", "idx", as_text("ring").alias("ring"))


@register("x19_collate", f"""WITH {FR}, r AS (SELECT ep % 8 AS batch, ep, least(count(*), 70) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY idx) FILTER (idx < 70) AS ids FROM fr GROUP BY ep), m AS (SELECT batch, max(n) AS longest FROM r GROUP BY batch)
    SELECT batch, ep, ids || repeat(',0', (longest - n)::INT) AS values, n AS real FROM r JOIN m USING (batch)""")
def x19(spark, d):
    return windows.collate(frames(spark, d), F.col("ep") % 8, "event_id", 70).select("batch", "ep", as_text("values").alias("values"), "real")


# ---- samples ---------------------------------------------------------------------------------------------------------
@register("t2_budgeted_sample", """WITH r AS (SELECT p_brand, p_partkey, p_size > 25 AS robot FROM part), c AS (SELECT p_brand, count(*) FILTER (robot) AS a, count(*) FILTER (NOT robot) AS b FROM r GROUP BY p_brand),
    o AS (SELECT *, least(b, 12 - least(a, 3)) AS kb FROM c), p AS (SELECT *, least(a, 12 - kb) AS ka FROM o),
    n AS (SELECT *, row_number() OVER (PARTITION BY p_brand, robot ORDER BY p_partkey) - 1 AS nth FROM r),
    z AS (SELECT p_brand, robot, p_partkey, nth, CASE WHEN robot THEN a ELSE b END AS size, CASE WHEN robot THEN ka ELSE kb END AS k FROM n JOIN p USING (p_brand))
    SELECT p_brand, robot, p_partkey FROM z WHERE nth IN (SELECT CASE WHEN k = 1 THEN 0 WHEN i = k - 1 THEN size - 1 ELSE floor(i * ((size - 1) / (k - 1)::DOUBLE))::BIGINT END FROM generate_series(0, 11) g(i) WHERE i < k)""")
def t2(spark, d):
    rows = load(spark, d, "part").select("p_brand", (F.col("p_size") > 25).alias("robot"), "p_partkey")
    return sampling.budgeted_sample(rows, "p_brand", "robot", "p_partkey", 12)


@register("t8_interleave", "WITH s AS (SELECT event_type, count(*)::DOUBLE AS size, CASE WHEN event_type < 'd' THEN 1.0 ELSE 0.5 END::DOUBLE AS weight FROM events GROUP BY event_type), t AS (SELECT sum(size * weight) AS total FROM s) SELECT event_type, round(size * weight / total, 6) AS share, floor(total)::BIGINT AS length FROM s, t")
def t8(spark, d):
    sizes = load(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).cast("double").alias("size"))
    sizes = sizes.withColumn("weight", F.when(F.col("event_type") < "d", 1.0).otherwise(0.5))
    return sampling.effective_length(sizes, "size", "weight").select("event_type", F.round("share", 6).alias("share"), "length")


@register("u4_first_entries", "SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY l_partkey")
def u4(spark, d):
    return joins.first_of(load(spark, d, "lineitem").select("l_partkey", "l_orderkey"), ["l_partkey"], "l_orderkey")


# ---- normalization ---------------------------------------------------------------------------------------------------
@register("n2_limits_without_offset", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(x / greatest(abs(low), abs(high)), 5) AS y FROM ve JOIN st USING (dim)")
def n2(spark, d):
    return _with_stats(spark, d).select("vec_id", "dim", F.round(F.col("x") * normalize.limits_without_offset(F.col("low"), F.col("high")), 5).alias("y"))


@register("n4_round_trip", f"WITH {VEC} SELECT vec_id, dim::INT AS dim, round(x, 5) AS x FROM ve")
def n4(spark, d):
    scale, offset = normalize.limits_scale(F.col("low"), F.col("high"))
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.invert_scale(normalize.apply_scale(F.col("x"), scale, offset), scale, offset), 5).alias("x"))


@register("n10_narrow_statistics", f"WITH {STATS} SELECT vec_id, ve.dim::INT AS dim, round(x * (coalesce(std, 1) + 1e-6) + coalesce(mean, 0), 5) AS y FROM ve LEFT JOIN st ON ve.dim = st.dim AND st.dim < 48")
def n10(spark, d):
    v = vectors(spark, d).select("vec_id", "dim", "x")
    narrow = stats.dataset_statistics(v.where("dim < 48"))
    return v.join(F.broadcast(narrow), "dim", "left").select("vec_id", "dim", F.round(normalize.mean_std_inverse(F.col("x"), F.col("mean"), F.col("std")), 5).alias("y"))


@register("n11_min_max", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round((x - (low - 1e-4)) / ((high + 1e-4) - (low - 1e-4)) * 2 - 1, 5) AS action, round((x - mean) / std_samp, 5) AS state FROM ve JOIN st USING (dim)")
def n11(spark, d):
    x = F.col("x")
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.min_max(x, F.col("low"), F.col("high")), 5).alias("action"), F.round((x - F.col("mean")) / F.col("std_samp"), 5).alias("state"))


@register("n12_delta_actions", "SELECT vec_id, round(e[4], 6) AS a0, round(e[5] - e[2], 6) AS a1, round(e[6], 6) AS a2, round(e[7], 6) AS b0, round(e[8] - e[2], 6) AS b1 FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)")
def n12(spark, d):
    df, e = _quaternions(spark, d)
    moved = normalize.delta_actions(F.array(F.array(*e[3:6]), F.array(*e[6:9])), F.array(*e[:3]), [False, True])
    return df.select("vec_id", moved.alias("m")).select("vec_id", *rounded([F.col("m")[0][0], F.col("m")[0][1], F.col("m")[0][2], F.col("m")[1][0], F.col("m")[1][1]], "a0", "a1", "a2", "b0", "b1"))


@register("n14_pad", "SELECT vec_id, len(embedding)::INT + 6 AS size, round(embedding[64]::DOUBLE, 6) AS last_real, 0.0::DOUBLE AS last FROM embeddings")
def n14(spark, d):
    padded = load(spark, d, "embeddings").select("vec_id", normalize.pad_to(F.col("embedding").cast("array<double>"), 70).alias("p"))
    return padded.select("vec_id", F.size("p").alias("size"), F.round(F.col("p")[63], 6).alias("last_real"), F.col("p")[69].alias("last"))


@register("n15_scatter", "SELECT vec_id, 0.0::DOUBLE AS s0, round(embedding[2]::DOUBLE, 6) AS s2, round(embedding[1]::DOUBLE, 6) AS s5, round(embedding[3]::DOUBLE, 6) AS s9 FROM embeddings")
def n15(spark, d):
    df, e = _quaternions(spark, d)
    slots = df.select("vec_id", normalize.scatter_slots(F.array(*e[:3]), [5, 2, 9], 12).alias("s"))
    return slots.select("vec_id", *rounded([F.col("s")[k] for k in (0, 2, 5, 9)], "s0", "s2", "s5", "s9"))


@register("n17_noise_scale", f"WITH {STATS} SELECT dim::INT AS dim, round(std / sqrt(pow(10, 4.0::DOUBLE)), 6) AS sigma FROM st")
def n17(spark, d):
    return vectors(spark, d).groupBy("dim").agg(F.stddev_pop("x").alias("std")).select("dim", F.round(normalize.noise_scale(F.col("std"), 40.0), 6).alias("sigma"))


@register("n19_depth", "WITH d AS (SELECT p_partkey, p_retailprice / 100 AS m, max(p_retailprice / 100) OVER (PARTITION BY p_brand) AS top FROM part) SELECT p_partkey, trunc(greatest(least(CASE WHEN top > 20 THEN m ELSE m * 1000 END, 65535), 0))::INT AS mm FROM d")
def n19(spark, d):
    parts = load(spark, d, "part").withColumn("m", F.col("p_retailprice") / 100)
    top = parts.groupBy("p_brand").agg(F.max("m").alias("top"))
    return parts.join(top, "p_brand").select("p_partkey", normalize.depth_to_mm(F.col("m"), F.col("top")).alias("mm"))


# ---- geometry --------------------------------------------------------------------------------------------------------
E = "e AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"


@register("g7_facing", f"WITH {E}, n AS (SELECT *, sqrt(e[1]*e[1] + e[2]*e[2] + e[3]*e[3]) AS l, e[1]*(0 - e[4]) + e[2]*(0 - e[5]) + e[3]*(1 - e[6]) AS t FROM e) SELECT vec_id, round(sign(CASE WHEN t < 0 THEN -1 ELSE 1 END) * e[1] / l, 6) AS x, round((CASE WHEN t < 0 THEN -1 ELSE 1 END) * e[2] / l, 6) AS y, round((CASE WHEN t < 0 THEN -1 ELSE 1 END) * e[3] / l, 6) AS z FROM n")
def g7(spark, d):
    df, e = _quaternions(spark, d)
    n = geometry.facing(tuple(e[:3]), tuple(e[3:6]), (F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    return df.select("vec_id", *rounded(n, "x", "y", "z"))


@register("g13_rotation_distance", f"WITH {E}, n AS (SELECT *, sqrt(e[1]*e[1]+e[2]*e[2]+e[3]*e[3]+e[4]*e[4]) AS a, sqrt(e[5]*e[5]+e[6]*e[6]+e[7]*e[7]+e[8]*e[8]) AS b FROM e) SELECT vec_id, round(2 * acos(least(abs((e[1]*e[5]+e[2]*e[6]+e[3]*e[7]+e[4]*e[8]) / a / b), 1)), 5) AS angle FROM n")
def g13(spark, d):
    df, e = _quaternions(spark, d)
    p, q = ([c / F.sqrt(sum((x * x for x in v[1:]), v[0] * v[0])) for c in v] for v in (e[:4], e[4:8]))
    return df.select("vec_id", F.round(geometry.rotation_distance(tuple(p), tuple(q)), 5).alias("angle"))


@register("g14_six_d", f"WITH {E}, a AS (SELECT *, sqrt(e[1]*e[1]+e[2]*e[2]+e[3]*e[3]) AS l FROM e), x AS (SELECT vec_id, e, e[1]/l AS x0, e[2]/l AS x1, e[3]/l AS x2 FROM a), b AS (SELECT *, x0*e[4]+x1*e[5]+x2*e[6] AS t FROM x), y AS (SELECT *, e[4]-t*x0 AS u0, e[5]-t*x1 AS u1, e[6]-t*x2 AS u2 FROM b), z AS (SELECT *, sqrt(u0*u0+u1*u1+u2*u2) AS m FROM y) SELECT vec_id, round(x0, 5) AS x0, round(u0/m, 5) AS y0, round(x1*u2/m - x2*u1/m, 5) AS z0 FROM z")
def g14(spark, d):
    df, e = _quaternions(spark, d)
    x, y, z = geometry.six_d_rotation(tuple(e[:3]), tuple(e[3:6]))
    return df.select("vec_id", F.round(x[0], 5).alias("x0"), F.round(y[0], 5).alias("y0"), F.round(z[0], 5).alias("z0"))


@register("g15_wrist_velocity", f"WITH {E}, q AS (SELECT vec_id, e, e[1]/n AS w, e[2]/n AS x, e[3]/n AS y, e[4]/n AS z FROM (SELECT *, sqrt(e[1]*e[1]+e[2]*e[2]+e[3]*e[3]+e[4]*e[4]) AS n FROM e)) SELECT vec_id, round((1-2*(y*y+z*z))*e[5] + 2*(x*y+z*w)*e[6] + 2*(x*z-y*w)*e[7], 6) AS vx, round(2*(x*y-z*w)*e[5] + (1-2*(x*x+z*z))*e[6] + 2*(y*z+x*w)*e[7], 6) AS vy FROM q")
def g15(spark, d):
    df, e = _quaternions(spark, d)
    v = geometry.to_wrist(geometry.quaternion_matrix(*e[:4]), tuple(e[4:7]))
    return df.select("vec_id", *rounded(v[:2], "vx", "vy"))


@register("g18_bytes", "SELECT vec_id, trunc(greatest(least(embedding[1]::DOUBLE, 1), 0) * 255)::INT AS r, trunc(greatest(least(embedding[2]::DOUBLE, 1), 0) * 255)::INT AS g FROM embeddings")
def g18(spark, d):
    df, e = _quaternions(spark, d)
    return df.select("vec_id", geometry.to_byte(e[0]).alias("r"), geometry.to_byte(e[1]).alias("g"))


@register("g19_full_range", f"WITH {VEC}, t AS (SELECT label, max(x) AS top FROM ve GROUP BY label) SELECT vec_id, dim::INT AS dim, round(CASE WHEN top <= 1 THEN x * 255 ELSE x END, 4) AS c FROM ve JOIN t USING (label)")
def g19(spark, d):
    v = vectors(spark, d).select("vec_id", "label", "dim", "x")
    top = v.groupBy("label").agg(F.max("x").alias("top"))
    return v.join(top, "label").select("vec_id", "dim", F.round(geometry.full_range(F.col("x"), F.col("top")), 4).alias("c"))


# ---- text ------------------------------------------------------------------------------------------------------------
TEMPLATE = "CASE p_size % 3 WHEN 0 THEN 'Put {A} on {B}.' WHEN 1 THEN 'Lift {A} with {a}.' ELSE 'Push {A}.' END"


def _templates(spark: SparkSession, d: str) -> DataFrame:
    params = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("A"), F.lit("a"))).otherwise(F.array(F.lit("A"), F.lit("B")))
    return load(spark, d, "part").withColumn("template", F.expr(TEMPLATE)).withColumn("params", params)


@register("x1_placeholders", f"SELECT p_partkey, array_to_string(regexp_extract_all({TEMPLATE}, '\\{{([^}}]+)\\}}', 1), ',') AS names FROM part".replace("{{", "{").replace("}}", "}"))
def x1(spark, d):
    return _templates(spark, d).select("p_partkey", F.array_join(text.placeholders(F.col("template")), ",").alias("names"))


@register("x2_template_filter", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size % 3 <> 0 ELSE p_size % 3 = 0 END AS fits FROM part")
def x2(spark, d):
    return _templates(spark, d).select("p_partkey", text.template_fits(F.col("template"), F.col("params")).alias("fits"))


@register("x3_substitute", f"SELECT p_partkey, replace(replace(replace({TEMPLATE}, '{{A}}', 'the ' || p_name), '{{B}}', p_type), '{{a}}', 'the left arm') AS instruction FROM part".replace("{{", "{").replace("}}", "}"))
def x3(spark, d):
    values = F.create_map(F.lit("A"), F.concat(F.lit("the "), "p_name"), F.lit("B"), F.col("p_type"), F.lit("a"), F.lit("the left arm"))
    return _templates(spark, d).select("p_partkey", text.substitute(F.col("template"), values).alias("instruction"))


@register("x10_camera_key", "SELECT event_id, 'camera_' || event_type AS key FROM events")
def x10(spark, d):
    return load(spark, d, "events").select("event_id", text.camera_key(F.concat("event_type", F.lit("_camera"))).alias("key"))


@register("x12_prefix", "SELECT p_partkey, starts_with(p_name, 'red') OR starts_with(p_name, 'small') AS is_robot FROM part")
def x12(spark, d):
    return load(spark, d, "part").select("p_partkey", text.has_prefix(F.col("p_name"), "red", "small").alias("is_robot"))


@register("x15_padding_mask", "SELECT conv_id, turn, coalesce(length(text) <> 0, false) AS mask FROM conversations")
def x15(spark, d):
    return load(spark, d, "conversations").select("conv_id", "turn", text.padding_mask(F.col("text")).alias("mask"))


@register("x16_keep_one_condition", f"SELECT event_id, CASE WHEN {HASH.format('(event_id + 3)')} / 4294967296.0::DOUBLE < 0.5 OR event_type = 'error' THEN value END AS image, CASE WHEN {HASH.format('(event_id + 3)')} / 4294967296.0::DOUBLE < 0.5 OR event_type = 'error' THEN '' ELSE event_type END AS instruction FROM events")
def x16(spark, d):
    rows = load(spark, d, "events").select("event_id", F.col("value").alias("image"), F.col("event_type").alias("instruction"))
    return filters.keep_one(rows, "image", "instruction", hash_uniform(F.col("event_id"), 3), F.col("instruction") == "error")


@register("x17_path_names", "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '/([^/]*)/[^/]*$', 1) AS parent FROM pages")
def x17(spark, d):
    return load(spark, d, "pages").select("page_id", text.base_name(F.col("url")).alias("base"), text.parent_name(F.col("url")).alias("parent"))


@register("x24_spec_check", "SELECT p_partkey, CASE WHEN p_name IS NULL THEN 'null;' ELSE '' END || CASE WHEN p_size NOT BETWEEN 1 AND 45 THEN 'range;' ELSE '' END || CASE WHEN len(string_split(p_name, ' ')) <> 2 THEN 'shape;' ELSE '' END AS issues FROM part")
def x24(spark, d):
    checks = {"null;": F.col("p_name").isNull(), "range;": ~F.col("p_size").between(1, 45), "shape;": F.size(F.split("p_name", " ")) != 2}
    return filters.list_issues(load(spark, d, "part"), checks).select("p_partkey", F.array_join("issues", "").alias("issues"))