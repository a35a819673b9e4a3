"""Windows, action codecs and normalizers that policies read, over the test tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codecs, normalize
from ..operators import filters, windows
from .preparation import E, as_text, rounded
from .queries import FR, LEN, STATS, UNIT, VEC, _quaternions, _with_stats, frames, load, register, unit_frames, vectors

IN_ORDER = "WINDOW w AS (PARTITION BY ep ORDER BY idx)"


def _real(mask: str) -> F.Column:
    return F.size(F.filter(mask, lambda m: m)).cast("long")


# ---- windows ---------------------------------------------------------------------------------------------------------
@register("w5_batched_gather", f"WITH {FR}, {LEN}, s AS (SELECT ep, n, unnest(generate_series(-2, n - 5 + 2)) AS start FROM len WHERE n >= 1), p AS (SELECT ep, start, j, greatest(least(start + j, n - 1), 0) AS idx FROM s, generate_series(0, 4) g(j)) SELECT ep, start, string_agg(CASE WHEN j < 3 THEN event_id::VARCHAR ELSE '-' END, ',' ORDER BY j) AS ids FROM p JOIN fr USING (ep, idx) GROUP BY ep, start")
def w5(spark, d):
    got = windows.keep_first(windows.gather_sequences(frames(spark, d), "event_id", 5, 2, 2), "values", 3)
    return got.select("ep", "start", F.array_join("values", ",", "-").alias("ids"))


@register("w8_flat_windows", f"""WITH {FR}, {LEN} SELECT ep, idx, coalesce(lag(event_id, 2) OVER w, first_value(event_id) OVER w) || ',' || coalesce(lag(event_id) OVER w, event_id) || ',' || event_id AS past,
    coalesce(lead(event_id) OVER w, event_id) || ',' || coalesce(lead(event_id, 2) OVER w, lead(event_id) OVER w, event_id) AS future, least(idx + 1, 3) AS real_past, least(n - 1 - idx, 2) AS real_future FROM fr JOIN len USING (ep) {IN_ORDER}""")
def w8(spark, d):
    got = windows.flat_windows(frames(spark, d), "event_id", 3, 2)
    return got.select("ep", "idx", as_text("past").alias("past"), as_text("future").alias("future"), _real("past_mask").alias("real_past"), _real("future_mask").alias("real_future"))


@register("w11_chunk_with_history", f"""WITH {FR}, b AS (SELECT *, first_value(v) OVER w AS v0 FROM fr {IN_ORDER}), s AS (SELECT ep, min(idx) AS f FROM b WHERE abs(v - v0) > 20 GROUP BY ep),
    c AS (SELECT ep, idx, v AS c0, coalesce(lead(v) OVER w, v) AS c1, coalesce(lead(v, 2) OVER w, lead(v) OVER w, v) AS c2, coalesce(lag(v, 2) OVER w, first_value(v) OVER w) AS h0, coalesce(lag(v) OVER w, v) AS h1 FROM fr {IN_ORDER})
    SELECT ep, idx, c0, c1, c2, h0, h1, least(idx - f + 2, 3) AS real FROM c JOIN s USING (ep) WHERE idx >= f - 1""")
def w11(spark, d):
    got = windows.chunk_with_history(frames(spark, d), "v", 3, 3, 20.0)
    return got.select("ep", "idx", *[F.col("chunk")[k].alias(f"c{k}") for k in range(3)], *[F.col("past")[k].alias(f"h{k}") for k in range(2)], _real("mask").alias("real"))


@register("w19_stack_last", f"WITH {FR} SELECT ep, idx, coalesce(lag(event_id, 2) OVER w, first_value(event_id) OVER w) || ',' || coalesce(lag(event_id) OVER w, event_id) || ',' || event_id AS stack FROM fr {IN_ORDER}")
def w19(spark, d):
    return windows.stack_last(frames(spark, d), "event_id", 3).select("ep", "idx", as_text("stack").alias("stack"))


@register("w21_zero_padded_suffix", f"""WITH {FR}, {LEN}, s AS (SELECT ep, idx, n, CASE WHEN idx = 0 THEN v ELSE lag(v) OVER w END AS a0, CASE WHEN idx = 0 THEN lead(v) OVER w ELSE v END AS a1, CASE WHEN idx = 0 THEN lead(v, 2) OVER w ELSE lead(v) OVER w END AS a2, CASE WHEN idx = 0 THEN lead(v, 3) OVER w ELSE lead(v, 2) OVER w END AS a3 FROM fr JOIN len USING (ep) {IN_ORDER})
    SELECT ep, idx, coalesce(a0, 0) AS a0, coalesce(a1, 0) AS a1, coalesce(a2, 0) AS a2, coalesce(a3, 0) AS a3, greatest(4 - (n - greatest(idx - 1, 0)), 0) AS pads FROM s""")
def w21(spark, d):
    got = windows.zero_padded_suffix(frames(spark, d), "v", 4)
    return got.select("ep", "idx", *[F.col("actions")[k].alias(f"a{k}") for k in range(4)], _real("is_pad").alias("pads"))


@register("w29_temporal_ensemble", f"WITH {FR}, p AS (SELECT ep, idx + i AS t, v + i AS a, row_number() OVER (PARTITION BY ep, idx + i ORDER BY idx) - 1 AS age FROM fr, generate_series(0, 3) g(i)) SELECT ep, t, round(sum(exp(-0.01 * age) * a) / sum(exp(-0.01 * age)), 6) AS action FROM p GROUP BY ep, t")
def w29(spark, d):
    chunks = frames(spark, d).select("ep", F.col("idx").alias("q"), F.array(*[F.col("v") + k for k in range(4)]).alias("actions"))
    return windows.temporal_ensemble(chunks).select("ep", "t", F.round("action", 6).alias("action"))


@register("w30_chunk_replay", f"WITH {FR} SELECT a.ep, a.idx AS t, b.v + a.idx % 4 AS action FROM fr a JOIN fr b ON a.ep = b.ep AND b.idx = a.idx - a.idx % 4")
def w30(spark, d):
    fr = frames(spark, d)
    chunks = fr.select("ep", F.col("idx").alias("q"), F.array(*[F.col("v") + k for k in range(5)]).alias("actions"))
    return windows.replay_chunks(chunks, fr.select("ep", F.col("idx").alias("t")), 4)


@register("w28_held_streams", """WITH z AS (SELECT user_id AS ep, event_id % 3 AS stream, row_number() OVER (PARTITION BY user_id, event_id % 3 ORDER BY ts) - 1 AS idx, value AS v FROM events),
    g AS (SELECT ep, idx, max(v) FILTER (stream = 0) AS a, max(v) FILTER (stream = 1) AS b, max(v) FILTER (stream = 2) AS c FROM z GROUP BY ep, idx)
    SELECT ep, idx, last_value(a IGNORE NULLS) OVER w AS s0, last_value(b IGNORE NULLS) OVER w AS s1, last_value(c IGNORE NULLS) OVER w AS s2 FROM g WINDOW w AS (PARTITION BY ep ORDER BY idx ROWS UNBOUNDED PRECEDING)""")
def w28_streams(spark, d):
    events = load(spark, d, "events").select(F.col("user_id").alias("user"), (F.col("event_id") % 3).alias("stream"), "ts", F.col("value").alias("v"))
    keyed = windows.number_frames(events.withColumn("both", F.struct("user", "stream")), "both", "ts")
    return windows.held_streams(keyed.select(F.col("user").alias("ep"), "stream", "idx", "v"), 3)


# ---- normalization ---------------------------------------------------------------------------------------------------
@register("n5_range_and_image", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(x * (2 / (high - low)) + (-1 - 2 / (high - low) * low), 5) AS y, round(x * 2 - 1, 5) AS image, round(x, 5) AS same FROM ve JOIN st USING (dim)")
def n5(spark, d):
    x, scale = F.col("x"), normalize.limits_scale(F.col("low"), F.col("high"), eps=1e-7)
    named = {"y": scale, "image": normalize.image_scale(), "same": normalize.identity_scale()}
    return _with_stats(spark, d).select("vec_id", "dim", *[F.round(normalize.apply_scale(x, *s), 5).alias(n) for n, s in named.items()])


@register("n6_two_arm_actions", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(CASE WHEN dim % 10 < 3 AND dim < 20 THEN x * (2 / (high - low)) + (-1 - 2 / (high - low) * low) ELSE x END, 5) AS y FROM ve JOIN st USING (dim)")
def n6(spark, d):
    scale = normalize.action_scale(F.col("dim"), F.col("low"), F.col("high"), arms=2)
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.apply_scale(F.col("x"), *scale), 5).alias("y"))


@register("n13_bool_mask", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(CASE WHEN dim <> 6 THEN (x - mean) / (std + 1e-8) ELSE x END, 5) AS y FROM ve JOIN st USING (dim)")
def n13(spark, d):
    mask = F.array(*[F.lit(b) for b in normalize.make_bool_mask(6, -1, 57)])
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.normal(F.col("x"), F.col("mean"), F.col("std"), F.get(mask, F.col("dim"))), 5).alias("y"))


@register("n27_signed_gripper", f"WITH {UNIT} SELECT ep, idx, round(2 * g - 1, 6) AS gripper, CASE WHEN g > 0.5 THEN -1.0 WHEN g < 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS flipped FROM un")
def n27(spark, d):
    g = F.col("g")
    return unit_frames(spark, d).select("ep", "idx", F.round(normalize.signed_gripper(g), 6).alias("gripper"), (normalize.signed_gripper(g, binarize=True, flip=True) + F.lit(0.0)).alias("flipped"))


@register("n28_evaluation_bounds", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round(greatest(least(CASE WHEN dim < 32 THEN 2 * (x - q01) / (q99 - q01 + 1e-8) - 1 ELSE x * 20 END, 1), -1), 5) AS y FROM ve JOIN st USING (dim)")
def n28(spark, d):
    x = F.when(F.col("dim") < 32, F.col("x")).otherwise(F.col("x") * 20)
    return _with_stats(spark, d).select("vec_id", "dim", F.round(normalize.evaluation_bounds(x, F.col("q01"), F.col("q99"), F.col("dim") < 32), 5).alias("y"))


@register("n29_zscore_round_trip", f"WITH {STATS} SELECT vec_id, dim::INT AS dim, round((x - mean) / std, 5) AS z, round(x, 5) AS x FROM ve JOIN st USING (dim)")
def n29(spark, d):
    z = normalize.zscore(F.col("x"), F.col("mean"), F.col("std"))
    return _with_stats(spark, d).select("vec_id", "dim", F.round(z, 5).alias("z"), F.round(normalize.zscore_inverse(z, F.col("mean"), F.col("std")), 5).alias("x"))


# ---- codecs ----------------------------------------------------------------------------------------------------------
def _edges_sql() -> str:
    return " || ".join(f"list_transform(generate_series(0, {n - 1}), lambda i: {a}::DOUBLE + i * {(b - a) / (n - 1 if closed else n)!r}::DOUBLE)" for a, b, n, closed in codecs.SEGMENTS)


@register("n21_uneven_bins", f"WITH {VEC}, e AS (SELECT {_edges_sql()} AS e) SELECT vec_id, dim::INT AS dim, len(list_filter(e, lambda b: b <= greatest(least(x * 3, 1), -1) + 1e-12))::INT AS bin FROM ve, e")
def n21(spark, d):
    return vectors(spark, d).select("vec_id", "dim", codecs.uneven_bin(F.col("x") * 3).alias("bin"))


@register("n22_text_tokens", "SELECT p_partkey, (31999 - floor((greatest(least((p_size - 25) / (14 + 1e-5) / 3, 1), -1) + 1) / (2.0::DOUBLE / 255) + 1e-9)) || ',' || (31999 - floor((greatest(least((p_retailprice - 1500) / (290 + 1e-5) / 3, 1), -1) + 1) / (2.0::DOUBLE / 255) + 1e-9)) AS tokens FROM (SELECT p_partkey, p_size, p_retailprice::DOUBLE AS p_retailprice FROM part)".replace("(31999 -", "(31999 -").replace(") || ','", ")::INT || ','").replace("+ 1e-9)) AS tokens", "+ 1e-9))::INT AS tokens"))
def n22(spark, d):
    text = F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_retailprice").cast("string"))
    scored = codecs.three_sigma(codecs.parse_numbers(text), [25.0, 1500.0], [14.0, 290.0])
    return load(spark, d, "part").select("p_partkey", as_text(codecs.even_tokens(scored)).alias("tokens"))


@register("n23_codec_variants", f"WITH {E} SELECT vec_id, round((e[1] + 0.5) / 1.0 * 2 - 1, 6) AS plain, round((e[2] + 0.6) / (1.2 + 1e-5) * 2 - 1, 6) AS padded, round((e[3] - 0.1) / (0.2 + 1e-5) / 3, 6) AS scored, round(e[1], 6) AS back, round(e[3], 6) AS back_scored FROM e")
def n23(spark, d):
    df, e = _quaternions(spark, d)
    values, low, high = F.array(*e[:4]), [-0.5, -0.6], [0.5, 0.6]
    plain, padded, scored = codecs.bounded(values, low, high), codecs.bounded(values, low, high, 1e-5), codecs.three_sigma(values, [0.1, 0.2], [0.2, 0.3])
    back, back_scored = codecs.bounded_inverse(plain, low, high), codecs.three_sigma_inverse(scored, [0.1, 0.2], [0.2, 0.3])
    columns = {"plain": (plain, 0), "padded": (padded, 1), "scored": (scored, 2), "back": (back, 0), "back_scored": (back_scored, 2)}
    return df.select("vec_id", *[F.round(F.get(c, F.lit(k)), 6).alias(n) for n, (c, k) in columns.items()])


@register("n24_state_prompt", "WITH b AS (SELECT vec_id, label, list_transform(embedding[1:3], lambda x: least(greatest(floor((x::DOUBLE * 4 + 1) / (2.0::DOUBLE / 256)), -1), 255)::INT) AS b FROM embeddings) SELECT vec_id, 'Task: put  label ' || label || ', State: ' || array_to_string(b, ' ') || ';' AS prompt FROM b")
def n24(spark, d):
    task = F.concat(F.lit("  Put _LABEL_"), F.col("label").cast("string"), F.lit(" "))
    state = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double") * 4)
    return load(spark, d, "embeddings").select("vec_id", codecs.state_prompt(task, state).alias("prompt"))


@register("n25_token_masks", "WITH t AS (SELECT p_partkey, generate_series(1, p_size % 5 + 1) AS a, generate_series(100, 100 + p_size % 3) AS b FROM part), z AS (SELECT *, (a || b || [0, 0, 0, 0, 0, 0])[1:6] AS t FROM t) SELECT p_partkey, array_to_string(t, ',') AS tokens, least(len(a) + len(b), 6)::BIGINT AS real, greatest(least(len(a) + len(b), 6) - len(a), 0)::BIGINT AS trained FROM z")
def n25(spark, d):
    series = lambda a, more: F.sequence(F.lit(a).cast("long"), F.lit(a).cast("long") + more)
    tokens, mask, _, loss = codecs.token_masks(series(1, F.col("p_size") % 5), series(100, F.col("p_size") % 3), 6)
    return load(spark, d, "part").select("p_partkey", tokens.alias("t"), mask.alias("m"), loss.alias("l")).select("p_partkey", as_text("t").alias("tokens"), _real("m").alias("real"), _real("l").alias("trained"))


@register("n26_joint_space", f"""WITH {E}, u AS (SELECT vec_id, e, greatest(least(e[7] * 2 + 0.5, 1), 0) AS g FROM e), l AS (SELECT *, g * (0.05800 - 0.01844) + 0.01844 AS l FROM u)
    SELECT vec_id, round(e[1], 6) AS j0, round(-e[2], 6) AS j1, round((asin(greatest(least((0.022 * 0.022 + l * l - 0.036 * 0.036) / (2 * 0.022 * l), 1), -1)) - 0.4) / 1.1, 5) AS gripper, round(((g * 1.1 + 0.4) + 0.6213) / (1.4910 + 0.6213), 5) AS back, round(g, 5) AS again FROM l""")
def n26(spark, d):
    df, _ = _quaternions(spark, d)
    joints = F.transform(F.slice("embedding", 1, 14), lambda x, i: F.when(i.isin(*codecs.GRIPPER_DIMS), F.greatest(F.least(x.cast("double") * 2 + 0.5, F.lit(1.0)), F.lit(0.0))).otherwise(x.cast("double")))
    j = df.select("vec_id", joints.alias("j"))
    there = codecs.from_model_joints(F.col("j"))
    j = j.select("vec_id", codecs.to_model_joints(F.col("j")).alias("m"), there.alias("b"), codecs.from_model_joints(there, inverse=True).alias("a"))
    return j.select("vec_id", F.round(F.col("m")[0], 6).alias("j0"), F.round(F.col("m")[1], 6).alias("j1"), F.round(F.col("m")[6], 5).alias("gripper"), F.round(F.col("b")[6], 5).alias("back"), F.round(F.col("a")[6], 5).alias("again"))


# ---- filters and projections -----------------------------------------------------------------------------------------
@register("p7_zero_actions", f"WITH {E} SELECT vec_id, abs(e[1] - 0.02) <= 0.15 AND abs(e[2]) <= 0.15 AND abs(e[3] + 0.01) <= 0.15 AS is_zero FROM e")
def p7(spark, d):
    df, e = _quaternions(spark, d)
    return df.select("vec_id", normalize.is_zero_action(F.array(*e[:3]), F.array(F.lit(0.02), F.lit(0.0), F.lit(-0.01)), eps=0.15).alias("is_zero"))


@register("p21_camera_slots", "SELECT event_id, CASE WHEN value > 100 THEN event_type ELSE 'black' END AS base, value > 100 AS base_mask, event_type || '2' AS wrist, true AS wrist_mask, 'black' AS side, false AS side_mask FROM events")
def p21(spark, d):
    images = F.when(F.col("value") > 100, F.create_map(F.lit("base"), F.col("event_type"), F.lit("wrist"), F.concat("event_type", F.lit("2")))).otherwise(F.create_map(F.lit("wrist"), F.concat("event_type", F.lit("2"))))
    got = load(spark, d, "events").select("event_id", filters.camera_slots(images, ["base", "wrist", "side"], F.lit("black")).alias("s"))
    return got.select("event_id", *[F.col(f"s.{s}.{f}").alias(s if f == "image" else f"{s}_mask") for s in ("base", "wrist", "side") for f in ("image", "mask")])


@register("p22_first_dims", f"WITH {E} SELECT vec_id, round(e[1], 6) AS first, round(e[14], 6) AS last, 14 AS size FROM e")
def p22(spark, d):
    df, _ = _quaternions(spark, d)
    cut = df.select("vec_id", normalize.first_dims(F.col("embedding").cast("array<double>"), 14).alias("a"))
    return cut.select("vec_id", *rounded([F.get("a", F.lit(0)), F.get("a", F.lit(13))], "first", "last"), F.size("a").alias("size"))
