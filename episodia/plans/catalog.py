"""Sources, samples, nested columns, transforms and streams over the test tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.common import hash_order, hash_uniform
from ..operators import filters, joins, sampling, schema, stats, statscache, structs, transforms, windows
from ..sources import episodes
from ..streaming import clips, processors
from .preparation import E, as_text
from .queries import FR, HASH, LEN, VEC, _clips_sql, _quaternions, frames, joined, load, register, unit_frames, vectors


# ---- sources ---------------------------------------------------------------------------------------------------------
def _paths(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    return c.select(F.concat(F.lit("/d/"), F.when(F.col("c_custkey") % 5 == 0, "pointcloud/").otherwise(""), F.lit("task"), F.col("c_nationkey").cast("string"), F.lit("/"), F.when(F.col("c_custkey") % 7 == 0, "mirror").otherwise("episode"), F.col("c_custkey").cast("string"), F.lit(".hdf5")).alias("path"))


PATHS = "pa AS (SELECT '/d/' || CASE WHEN c_custkey % 5 = 0 THEN 'pointcloud/' ELSE '' END || 'task' || c_nationkey || '/' || CASE WHEN c_custkey % 7 = 0 THEN 'mirror' ELSE 'episode' END || c_custkey || '.hdf5' AS path, 'task' || c_nationkey AS task, c_custkey::BIGINT AS episode FROM customer)"


@register("s1_episode_discovery", f"WITH {PATHS}, r AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY episode, path) AS nth FROM pa WHERE task IN ('task1', 'task2', 'task3')) SELECT task, episode, path FROM r WHERE nth <= 4")
def s1(spark, d):
    return episodes.discover(_paths(spark, d), episodes.csv_names("task1, task2,task3"), 4).select("task", "episode", "path")


@register("s2_no_filter", f"WITH {PATHS} SELECT task, count(*) AS n FROM pa GROUP BY task")
def s2(spark, d):
    return episodes.discover(_paths(spark, d), episodes.csv_names("all")).groupBy("task").agg(F.count(F.lit(1)).alias("n"))


@register("s8_tar_shards")
def s8(spark, d):
    samples = load(spark, d, "documents").select(F.format_string("%09d.txt", "doc_id").alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("payload"))
    return episodes.tar_shards(samples, "train", 1_000_000).select("name", F.length("content").alias("bytes"), F.sha2("content", 256).alias("sha256"))


@register("s9_manifest", """SELECT '{"split":"' || o_orderpriority || '","clips":' || count(*) || ',"episodes":' || count(DISTINCT o_custkey) || ',"complete":' || count(*) FILTER (o_orderstatus = 'F') || '}' AS line FROM orders GROUP BY o_orderpriority""")
def s9(spark, d):
    return episodes.manifest_lines(stats.manifest(load(spark, d, "orders"), "o_orderpriority", "o_custkey", F.col("o_orderstatus") == "F"))


@register("s10_written_frames", f"WITH {FR} SELECT ep, idx, v, kind FROM fr")
def s10(spark, d):
    folder = episodes.scratch_folder(spark, "episodes")
    episodes.write_episodes(frames(spark, d).select("ep", "idx", "v", "kind"), folder, "kind")
    return spark.read.parquet(folder).select("ep", "idx", "v", "kind")


@register("s6_leaf_columns", f"WITH {FR} SELECT ep, idx, v AS \"obs/value\", kind AS \"obs/meta/kind\" FROM fr")
def s6(spark, d):
    nested = frames(spark, d).select("ep", "idx", F.struct(F.col("v").alias("value"), F.struct("kind").alias("meta")).alias("obs"))
    folder = episodes.scratch_folder(spark, "leaves")
    episodes.write_episodes(schema.flatten_structs(nested).withColumn("task", F.lit("t")), folder, "task")
    return spark.read.parquet(folder).drop("task")


@register("s7_clip_sink", f"WITH {_clips_sql(8, 8, 1)} SELECT ep, clip, j, idx, is_pad, v, 'demo' AS config FROM po JOIN fr USING (ep, idx)")
def s7(spark, d):
    clipped = windows.clips(frames(spark, d), 8, 8, 1).select("ep", "clip", "j", "idx", "is_pad", "v").withColumn("config", F.lit("demo"))
    folder = episodes.scratch_folder(spark, "clips")
    episodes.write_episodes(clipped, folder, "config")
    return spark.read.parquet(folder)


@register("s14_read_split", f"SELECT DISTINCT user_id AS ep, {HASH.format('(user_id + 1)')} AS shuffle FROM events WHERE {HASH.format('user_id')} / 4294967296.0::DOUBLE < 0.7")
def s14(spark, d):
    users = load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct()
    return episodes.read_split(users, "ep", "train", 0.7).select("ep", "shuffle")


@register("s15_built_rows", "SELECT c_custkey AS episode, k AS idx, c_custkey * 10 + k AS value FROM customer, generate_series(0, 2) g(k)")
def s15(spark, d):
    def parse(path):
        n = int(path.rsplit("/", 1)[1].split(".")[0].lstrip("episodemirror"))
        return ({"episode": n, "idx": k, "value": n * 10 + k} for k in range(3))

    return episodes.build_table(_paths(spark, d), parse, "episode long, idx long, value long")


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    by = load(spark, d, "events").groupBy(F.col("user_id").alias("ep")).agg(F.sort_array(F.collect_set("event_type")).alias("texts"))
    return by


TASKS = "ta AS (SELECT user_id AS ep, list_sort(list(DISTINCT event_type)) AS texts FROM events GROUP BY user_id)"


@register("s16_frame_tables", f"WITH {FR}, {LEN}, {TASKS}, e AS (SELECT ep, n AS length, texts[({HASH.format('ep')} % len(texts))::INT + 1] AS task FROM len JOIN ta USING (ep)), k AS (SELECT task, row_number() OVER (ORDER BY task) - 1 AS task_index FROM (SELECT DISTINCT task FROM e)) SELECT ep, idx, round(idx / 50.0::DOUBLE, 6) AS timestamp, length, task, task_index::INT AS task_index FROM fr JOIN e USING (ep) JOIN k USING (task)")
def s16(spark, d):
    made = episodes.frame_tables(frames(spark, d), _tasks(spark, d))
    return made["frames"].join(made["episodes"], "ep").join(made["tasks"], "task").select("ep", "idx", F.round("timestamp", 6).alias("timestamp"), "length", "task", "task_index")


@register("s17_delta_windows", f"WITH {FR}, {LEN} SELECT a.ep, a.idx, string_agg(b.event_id::VARCHAR, ',' ORDER BY j) AS chunk, 0.06::DOUBLE AS last_delta FROM fr a JOIN len USING (ep), generate_series(0, 3) g(j) JOIN fr b ON b.ep = a.ep AND b.idx = least(a.idx + j, n - 1) GROUP BY a.ep, a.idx")
def s17(spark, d):
    return episodes.delta_windows(frames(spark, d), "event_id", 4, 50).select("ep", "idx", as_text("chunk").alias("chunk"), F.round(F.col("delta_timestamps")[3], 6).alias("last_delta"))


@register("s18_skipped_files", f"WITH {PATHS} SELECT path FROM pa WHERE NOT contains(path, 'pointcloud/') AND NOT contains(path, 'mirror')")
def s18(spark, d):
    return filters.skip_files(_paths(spark, d))


@register("s20_numeric_lines", """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS line FROM events WHERE event_id % 2 = 0""")
def s20(spark, d):
    lines = episodes.numeric_lines(load(spark, d, "events").select("event_id", "user_id", "event_type"))
    cut = F.when(F.get_json_object("line", "$.event_id").cast("long") % 2 == 0, F.col("line")).otherwise(F.expr("substr(line, 1, length(line) - 3)"))
    return episodes.complete_lines(lines.withColumn("line", cut))


# ---- filters and aggregates ------------------------------------------------------------------------------------------
@register("p2_of_tasks", "SELECT event_id FROM events WHERE event_type IN ('click', 'view')")
def p2(spark, d):
    return filters.of_tasks(load(spark, d, "events"), ["click", "view"], "event_type").select("event_id")


@register("p18_without_strings", "SELECT event_id, user_id, value FROM events")
def p18(spark, d):
    return filters.drop_strings(load(spark, d, "events").drop("ts"))


@register("f8_success_predicates", "SELECT o_orderkey FROM orders WHERE (o_orderpriority = '1-URGENT' AND o_totalprice > 100000) OR (o_orderpriority <> '1-URGENT' AND o_orderstatus = 'F')")
def f8(spark, d):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return filters.successful(load(spark, d, "orders"), (urgent & (F.col("o_totalprice") > 100000)) | (~urgent & (F.col("o_orderstatus") == "F"))).select("o_orderkey")


@register("a1_population_statistics", f"WITH {VEC} SELECT dim::INT AS dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, min(x) AS low, max(x) AS high FROM ve GROUP BY dim")
def a1(spark, d):
    return stats.dataset_statistics(vectors(spark, d)).select("dim", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "low", "high")


@register("a2_sample_statistics", f"WITH {VEC} SELECT dim::INT AS dim, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM ve GROUP BY dim")
def a2(spark, d):
    return stats.dataset_statistics(vectors(spark, d)).select("dim", F.round("mean", 6).alias("mean"), F.round("std_samp", 6).alias("std"))


@register("stats_cache", f"WITH {VEC} SELECT dim::BIGINT AS dim, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.01), 6) AS q01, count(x) AS n FROM ve GROUP BY dim")
def stats_cache(spark, d):
    folder = episodes.scratch_folder(spark, "statistics")
    compute = lambda: stats.dataset_statistics(vectors(spark, d))
    statscache.cached_statistics(spark, folder, [d, "embeddings"], compute)
    kept = statscache.require_statistics(spark, folder, statscache.cache_key([d, "embeddings"]))
    return kept.select("dim", F.round("mean", 6).alias("mean"), F.round("q01", 6).alias("q01"), "n")


# ---- samples ---------------------------------------------------------------------------------------------------------
@register(
    "t3_farthest_points",
    """WITH RECURSIVE cl AS (SELECT label, list(vec_id ORDER BY vec_id) AS ids, list(embedding[1]::DOUBLE ORDER BY vec_id) AS xs, list(embedding[2]::DOUBLE ORDER BY vec_id) AS ys, list(embedding[3]::DOUBLE ORDER BY vec_id) AS zs, count(*) AS n FROM embeddings GROUP BY label),
    st AS (SELECT label, 0::BIGINT AS nth, 1::BIGINT AS pos, list_transform(ids, lambda i: 1e300::DOUBLE) AS far FROM cl
        UNION ALL SELECT label, nth + 1, list_position(f, list_max(f))::BIGINT, f FROM (SELECT st.label, nth, list_transform(range(1, n + 1), lambda i: CASE WHEN i = pos OR far[i] < 0 THEN -1.0 ELSE least(far[i], (xs[i] - xs[pos]) * (xs[i] - xs[pos]) + (ys[i] - ys[pos]) * (ys[i] - ys[pos]) + (zs[i] - zs[pos]) * (zs[i] - zs[pos])) END) AS f FROM st JOIN cl ON cl.label = st.label WHERE nth + 1 < least(64, n)))
    SELECT st.label, nth, ids[pos] AS id, xs[pos] AS x, ys[pos] AS y, zs[pos] AS z FROM st JOIN cl ON cl.label = st.label UNION ALL SELECT label, k, NULL, 0.0, 0.0, 0.0 FROM cl, range(64) g(k) WHERE k >= n""",
)
def t3(spark, d):
    df, e = _quaternions(spark, d)
    return sampling.farthest_points(df.select("label", F.col("vec_id").alias("id"), *[c.alias(n) for c, n in zip(e[:3], "xyz", strict=True)]), "label", 64)


@register("t5_split_lists", "SELECT o_orderpriority, array_to_string(list_sort(list(o_custkey)), ',') AS keys FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) AS nth FROM (SELECT DISTINCT o_orderpriority, o_custkey FROM orders)) WHERE nth <= 20 GROUP BY o_orderpriority")
def t5(spark, d):
    return sampling.split_lists(load(spark, d, "orders"), "o_orderpriority", "o_custkey", 20).select("o_orderpriority", as_text("keys").alias("keys"))


@register("t6_closest_axis", f"WITH {E} SELECT label, arg_max(vec_id, p) AS pos, round(max(p), 6) AS product FROM (SELECT label, e.vec_id, e[1] * 0.6 + e[3] * 0.8 AS p FROM e JOIN embeddings USING (vec_id)) GROUP BY label")
def t6(spark, d):
    df, e = _quaternions(spark, d)
    got = sampling.closest_axis(df.withColumn("pos", F.col("vec_id")), "label", F.array(*e[:3]), F.array(F.lit(0.6), F.lit(0.0), F.lit(0.8)))
    return got.select("label", "pos", F.round("product", 6).alias("product"))


@register("t10_by_length", f"WITH {FR}, {LEN}, e AS (SELECT ep, n, (sum(n) OVER (ORDER BY ep))::BIGINT AS e FROM len), t AS (SELECT sum(n) AS total FROM len), q AS (SELECT o_orderkey AS draw, least(floor({HASH.format('o_orderkey')} / 4294967296.0::DOUBLE * total)::BIGINT, total::BIGINT - 1) AS p FROM orders, t) SELECT draw, ep, p - e + n AS start FROM q JOIN e ON p >= e - n AND p < e")
def t10(spark, d):
    draws = load(spark, d, "orders").select(F.col("o_orderkey").alias("draw"), hash_uniform(F.col("o_orderkey")).alias("uniform"))
    return sampling.by_length(windows.lengths(frames(spark, d)), draws)


@register("t11_downsample", f"WITH e AS (SELECT DISTINCT user_id AS ep FROM events), r AS (SELECT ep FROM e WHERE ep % 3 = 0 ORDER BY {HASH.format('ep')}, ep LIMIT 12) SELECT ep, ep IN (SELECT ep FROM r) AS kept FROM e")
def t11(spark, d):
    users = load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct()
    return sampling.downsample(users, "ep", F.col("ep") % 3 == 0, 12, hash_order(F.col("ep")))


@register("t15_shuffled_split", f"WITH e AS (SELECT DISTINCT user_id AS ep FROM events) SELECT ep, row_number() OVER (ORDER BY {HASH.format('ep')}, ep) > count(*) OVER () - floor(count(*) OVER () * 0.05::DOUBLE) AS is_val FROM e")
def t15(spark, d):
    users = load(spark, d, "events").select(F.col("user_id").alias("ep")).distinct()
    return sampling.shuffled_split(users, "ep", 0.05, hash_order(F.col("ep")))


@register("t16_greedy_assignment", """WITH RECURSIVE s AS (SELECT c_nationkey::VARCHAR AS task, count(*)::DOUBLE AS size FROM customer GROUP BY c_nationkey), t AS (SELECT *, row_number() OVER (ORDER BY size DESC, task) AS i FROM s),
    r(i, load, task, size, bin) AS (SELECT 0::BIGINT, [0.0::DOUBLE, 0.0, 0.0, 0.0], NULL::VARCHAR, NULL::DOUBLE, NULL::INT
    UNION ALL SELECT t.i, list_transform(r.load, lambda x, j: CASE WHEN j = list_position(r.load, list_min(r.load)) THEN x + t.size ELSE x END), t.task, t.size, (list_position(r.load, list_min(r.load)) - 1)::INT FROM r JOIN t ON t.i = r.i + 1)
    SELECT task, size, bin FROM r WHERE task IS NOT NULL""")
def t16(spark, d):
    tasks = load(spark, d, "customer").groupBy(F.col("c_nationkey").cast("string").alias("task")).agg(F.count(F.lit(1)).cast("double").alias("size"))
    return sampling.assign_greedy(tasks, "task", "size", 4)


def _batches_sql(rows: str, size: int, ranks: int) -> str:
    """SQL of modality_batches() for rows (id, modality, length): a greedy step for each place of all batches at once."""
    free = f"list_transform(load, lambda x, i: CASE WHEN held[i] < {size // ranks} THEN x ELSE 4611686018427387904 END)"
    return f"""RECURSIVE ro AS ({rows}), nu AS (SELECT *, row_number() OVER (PARTITION BY modality ORDER BY {HASH.format('id')}, id) - 1 AS nth, count(*) OVER (PARTITION BY modality) AS n FROM ro),
    ba AS (SELECT modality, nth // {size} AS own, id, length, nth FROM nu UNION ALL SELECT modality, (n - 1) // {size}, id, length, nth + n FROM nu WHERE nth < least({size}, ((n - 1) // {size} + 1) * {size} - n) AND n > {size}),
    it AS (SELECT *, row_number() OVER (PARTITION BY modality, own ORDER BY length DESC, nth, id) AS k FROM ba),
    pl AS (SELECT DISTINCT modality, own, 0::BIGINT AS k, list_transform(range({ranks}), lambda x: 0::BIGINT) AS load, list_transform(range({ranks}), lambda x: 0) AS held, 0::INT AS pos FROM it
        UNION ALL SELECT modality, own, k, list_transform(load, lambda x, i: CASE WHEN i = best THEN x + length ELSE x END), list_transform(held, lambda x, i: CASE WHEN i = best THEN x + 1 ELSE x END), best FROM
        (SELECT pl.modality, pl.own, it.k, load, held, length, list_position({free}, list_min({free}))::INT AS best FROM pl JOIN it ON it.modality = pl.modality AND it.own = pl.own AND it.k = pl.k + 1)),
    bn AS (SELECT modality, own, max(length) AS longest, row_number() OVER (ORDER BY substr(md5(modality || ':' || own), 1, 12), modality, own) - 1 AS number FROM it GROUP BY modality, own),
    tp AS (SELECT number AS top FROM bn ORDER BY longest DESC, number LIMIT 1),
    dealt AS (SELECT CASE WHEN number = top THEN 0 WHEN number = 0 THEN top ELSE number END AS batch, pos - 1 AS rank, id, it.modality, length FROM it JOIN pl ON pl.modality = it.modality AND pl.own = it.own AND pl.k = it.k JOIN bn ON bn.modality = it.modality AND bn.own = it.own, tp)"""


_TURNS = "SELECT conv_id * 1000 + turn AS id, role AS modality, coalesce(length(text), 0)::BIGINT AS length FROM conversations"
_TEXTS = "SELECT doc_id AS id, coalesce(lang, 'none') AS modality, coalesce(length(text), 0)::BIGINT AS length FROM documents"


@register("t18_modality_batches", f"WITH {_batches_sql(_TURNS, 16, 4)} SELECT batch, rank, id, modality, length FROM dealt")
def t18(spark, d):
    rows = load(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("role").alias("modality"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("length"))
    return sampling.modality_batches(rows, 16, 4, hash_order(F.col("id")))


@register("t17_rank_loads", f"WITH {_batches_sql(_TEXTS, 32, 8)} SELECT batch, rank, sum(length)::BIGINT AS load, count(*) AS rows FROM dealt GROUP BY batch, rank")
def t17(spark, d):
    rows = load(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("none")).alias("modality"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("length"))
    dealt = sampling.modality_batches(rows, 32, 8, hash_order(F.col("id")))
    return dealt.groupBy("batch", "rank").agg(F.sum("length").alias("load"), F.count(F.lit(1)).alias("rows"))


# ---- text and nested columns -----------------------------------------------------------------------------------------
@register("j11_descriptions", "WITH d AS (SELECT p_brand AS obj, list_sort(list(DISTINCT p_container) FILTER (p_size <= 40)) AS s, list_sort(list(DISTINCT p_container) FILTER (p_size > 40)) AS u FROM (SELECT p_brand, p_size, p_type AS p_container FROM part) GROUP BY p_brand) SELECT p_partkey AS episode, placeholder, array_to_string(CASE placeholder WHEN 'A' THEN s WHEN 'B' THEN [p_name] ELSE ['the left arm'] END, '|') AS seen, array_to_string(CASE placeholder WHEN 'A' THEN CASE WHEN len(coalesce(u, [])) > 0 THEN u ELSE s END WHEN 'B' THEN [p_name] ELSE ['the left arm'] END, '|') AS unseen FROM part JOIN d ON obj = p_brand, (VALUES ('A'), ('B'), ('a')) v(placeholder)")
def j11(spark, d):
    part = load(spark, d, "part")
    entries = F.explode(F.array(*[F.struct(F.lit(p).alias("placeholder"), c.alias("value")) for p, c in (("A", F.col("p_brand")), ("B", F.col("p_name")), ("a", F.lit("left")))])).alias("e")
    params = part.select(F.col("p_partkey").alias("episode"), entries).select("episode", "e.*")
    split = F.when(F.col("p_size") > 40, "unseen").otherwise("seen")
    descriptions = part.groupBy(F.col("p_brand").alias("obj"), split.alias("split")).agg(F.sort_array(F.collect_set("p_type")).alias("texts"))
    got = joins.describe(params, descriptions)
    return got.select("episode", "placeholder", F.array_join("seen", "|").alias("seen"), F.array_join("unseen", "|").alias("unseen"))


@register("x4_unseen_or_seen", "WITH d AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'F')) AS s, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O')) AS u FROM orders GROUP BY o_custkey) SELECT o_custkey, array_to_string(CASE WHEN len(coalesce(u, [])) > 0 THEN u ELSE s END, '|') AS unseen FROM d WHERE len(coalesce(s, [])) > 0 OR len(coalesce(u, [])) > 0")
def x4(spark, d):
    orders = load(spark, d, "orders").where("o_orderstatus in ('F', 'O')")
    split = F.when(F.col("o_orderstatus") == "O", "unseen").otherwise("seen")
    descriptions = orders.groupBy(F.concat(F.lit("o/"), F.col("o_custkey").cast("string")).alias("obj"), split.alias("split")).agg(F.sort_array(F.collect_set("o_orderpriority")).alias("texts"))
    params = orders.select("o_custkey").distinct().select(F.col("o_custkey").alias("episode"), F.lit("AB").alias("placeholder"), F.concat(F.lit("o/"), F.col("o_custkey").cast("string")).alias("value"))
    return joins.describe(params, descriptions).select(F.col("episode").alias("o_custkey"), F.array_join("unseen", "|").alias("unseen"))


@register("x6_clean_instruction", "SELECT p_partkey, trim(regexp_replace(regexp_replace(' ' || p_name || ' ', 'e+', 'E', 'g'), ' +', ' ', 'g')) AS name FROM part")
def x6(spark, d):
    c = text.clean_instruction(F.concat(F.lit(" "), "p_name", F.lit(" ")), {"e+": "E", " +": " "})
    return load(spark, d, "part").select("p_partkey", c.alias("name"))


@register("x9_clip_keys", "SELECT c_custkey, c_name || printf(':clip%06d', c_custkey % 40) AS key FROM customer")
def x9(spark, d):
    return load(spark, d, "customer").select("c_custkey", text.clip_key(F.col("c_name"), F.col("c_custkey") % 40).alias("key"))


@register("x18_padding", "SELECT event_id * 0 AS event_id, '' AS event_type, value * 0 AS value FROM events")
def x18(spark, d):
    return structs.as_padding(load(spark, d, "events").select("event_id", "event_type", "value"))


@register("x20_prompts", "SELECT p_partkey, 'What action should the robot take to ' || lower(p_name) || '?' AS prompt FROM part")
def x20(spark, d):
    return load(spark, d, "part").select("p_partkey", text.question(F.upper("p_name")).alias("prompt"))


@register("x21_task_prompts", f"WITH {FR} SELECT ep, idx, CASE kind WHEN 'click' THEN 'press it' WHEN 'view' THEN 'look at it' END AS prompt FROM fr")
def x21(spark, d):
    prompts = spark.createDataFrame([("click", "press it"), ("view", "look at it")], "task string, prompt string")
    return joins.look_up(frames(spark, d), (F.broadcast(prompts), "kind", "task")).select("ep", "idx", "prompt")


@register("x23_collate_tokens", f"""WITH {FR}, r AS (SELECT ep % 5 AS batch, ep, least(count(*), 80) AS n, string_agg((event_id % 100)::VARCHAR, ',' ORDER BY idx) FILTER (idx < 80) AS ids FROM fr GROUP BY ep), m AS (SELECT batch, max(n) AS longest FROM r GROUP BY batch)
    SELECT batch, ep, ids || repeat(',7', (longest - n)::INT) AS values, n AS real FROM r JOIN m USING (batch)""")
def x23(spark, d):
    return windows.collate(frames(spark, d).withColumn("token", F.col("event_id") % 100), F.col("ep") % 5, "token", 80, 7).select("batch", "ep", as_text("values").alias("values"), "real")


@register("u3_name_sets", "WITH n AS (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS a, list_distinct(string_split(CASE WHEN p_size > 25 THEN p_name ELSE lower(p_type) || ' rod' END, ' ')) AS b FROM part) SELECT p_partkey, list_sort(a) = list_sort(b) AS same, len(list_intersect(a, b)) = 0 AS apart FROM n")
def u3(spark, d):
    a = F.split("p_name", " ")
    b = F.when(F.col("p_size") > 25, F.concat(F.reverse(F.split("p_name", " ")), F.split("p_name", " "))).otherwise(F.array(F.lower("p_type"), F.lit("rod")))
    return load(spark, d, "part").select("p_partkey", text.same_names(a, b).alias("same"), text.disjoint(a, b).alias("apart"))


@register("u5_deep_merge", "SELECT event_id, user_id AS a, coalesce(CASE WHEN event_id % 2 = 0 THEN value END, 0.5)::DOUBLE AS x, event_type AS y, 1 AS z, event_id % 3 AS k FROM events")
def u5(spark, d):
    left = F.struct(F.col("user_id").alias("a"), F.struct(F.lit(0.5).alias("x"), F.lit("old").alias("y")).alias("in"))
    right = F.struct(F.struct(F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("x"), F.col("event_type").alias("y"), F.lit(1).alias("z")).alias("in"))
    rows = load(spark, d, "events").select("event_id", left.alias("l"), right.alias("r"), structs.merge_maps(F.create_map(F.lit("k"), F.lit(9).cast("long")), F.create_map(F.lit("k"), F.col("event_id") % 3))["k"].alias("k"))
    merged = structs.merge_structs(F.col("l"), rows.schema["l"].dataType, F.col("r"), rows.schema["r"].dataType)
    return rows.select("event_id", merged.alias("m"), "k").select("event_id", "m.a", "m.in.x", "m.in.y", "m.in.z", "k")


@register("tu1_mapped_leaves", "SELECT event_id + 1 AS event_id, upper(event_type) AS kind, round(value / 2, 6) AS half, user_id + 1 AS user FROM events")
def tu1(spark, d):
    nested = load(spark, d, "events").select("event_id", F.struct(F.col("event_type").alias("kind"), F.array("value").alias("values")).alias("a"), F.create_map(F.lit("u"), F.col("user_id")).alias("m"))
    got = structs.map_columns(nested, {"bigint": lambda x: x + 1, "string": F.upper, "double": lambda x: x / 2})
    return got.select("event_id", "a.kind", F.round(F.col("a.values")[0], 6).alias("half"), F.col("m")["u"].alias("user"))


@register("tu2_gathered", "SELECT vec_id, round(embedding[vec_id % 64 + 1]::DOUBLE, 6) AS x, CAST(NULL AS DOUBLE) AS beyond FROM embeddings")
def tu2(spark, d):
    e = F.col("embedding").cast("array<double>")
    return load(spark, d, "embeddings").select("vec_id", F.round(structs.gather(e, F.col("vec_id") % 64), 6).alias("x"), structs.gather(e, F.lit(64)).alias("beyond"))


@register("tu3_padded", "WITH e AS (SELECT vec_id, list_transform(embedding[1:vec_id % 5 + 1], lambda x: printf('%.4f', x::DOUBLE)) AS e FROM embeddings) SELECT vec_id, array_to_string(list_concat([e[1], e[1]], e, [e[len(e)]]), ',') AS edge, array_to_string(list_concat(['0.0000'], e, ['0.0000', '0.0000']), ',') AS constant FROM e")
def tu3(spark, d):
    e = F.slice(F.col("embedding").cast("array<double>"), F.lit(1), (F.col("vec_id") % 5 + 1).cast("int"))
    rows = load(spark, d, "embeddings").select("vec_id", structs.pad_sequence(e, 2, 1).alias("e"), structs.pad_sequence(e, 1, 2, F.lit(0.0)).alias("c"))
    return rows.select("vec_id", joined("e", 4).alias("edge"), joined("c", 4).alias("constant"))


@register("tu4_reduced", "SELECT vec_id, round(list_sum(e), 5) AS sum, round(list_max(e), 6) AS max, round(list_avg(e), 6) AS mean, 128 AS flat FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)")
def tu4(spark, d):
    e = F.col("embedding").cast("array<double>")
    return load(spark, d, "embeddings").select("vec_id", *[F.round(structs.reduce_sequence(e, how), k).alias(how) for how, k in (("sum", 5), ("max", 6), ("mean", 6))], F.size(structs.reduce_sequence(F.array(e, e), "flatten")).alias("flat"))


@register("tu5_one_hot", "SELECT vec_id, label, list_reduce(list_transform(generate_series(0, 9), lambda i: CASE WHEN i = label THEN '1' ELSE '0' END), lambda a, b: a || b) AS hot FROM embeddings")
def tu5(spark, d):
    return load(spark, d, "embeddings").select("vec_id", "label", F.array_join(F.transform(structs.one_hot(F.col("label"), 10), lambda x: x.cast("string")), "").alias("hot"))


@register("tu6_reshaped", "SELECT vec_id, 8 AS rows, round(embedding[19]::DOUBLE, 6) AS x, 3 AS copies FROM embeddings")
def tu6(spark, d):
    grid = structs.reshape(F.col("embedding").cast("array<double>"), 8)
    return load(spark, d, "embeddings").select("vec_id", F.size(grid).alias("rows"), F.round(grid[2][2], 6).alias("x"), F.size(structs.expand(grid, 3)).alias("copies"))


@register("tu7_rows_and_columns", "SELECT conv_id, turn, role FROM conversations")
def tu7(spark, d):
    return structs.to_rows(structs.to_columns(load(spark, d, "conversations"), "conv_id", "turn", "role"), "conv_id", "turn", "role")


@register("tu8_split", "SELECT vec_id, round(embedding[3]::DOUBLE, 6) AS pos, round(embedding[8]::DOUBLE, 6) AS rest FROM embeddings")
def tu8(spark, d):
    split = structs.split_struct(load(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e")), "e", {"pos": [0, 1, 2], "rest": list(range(3, 10))})
    return split.select("vec_id", F.round(F.col("pos")[2], 6).alias("pos"), F.round(F.col("rest")[4], 6).alias("rest"))


# ---- transforms ------------------------------------------------------------------------------------------------------
def _robot_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames with an action of 8 and a state of 9 numbers, their last one g or from it, and parts of them by name."""
    base = [F.col("v") + k for k in range(6)]
    quaternion = [F.lit(0.0), F.lit(0.0), F.sin(F.col("idx") * 0.01), F.cos(F.col("idx") * 0.01)]
    return unit_frames(spark, d).select(
        "ep", "idx", F.array(*base[:3], *quaternion, F.col("g")).alias("action"), F.array(*[c * 2 for c in base], F.lit(0.5), F.lit(0.7), F.col("g")).alias("state"),
        F.array(*base[:3]).alias("world_vector"), F.array(*base[3:]).alias("rotation_delta"), (F.col("g") - 0.5).alias("gripper_closedness_action"), F.col("kind").alias("natural_language_instruction"),
    )


UN = "un AS (SELECT *, ((round(v * 100, 0)::BIGINT % 100 + 100) % 100) / 100.0::DOUBLE AS g FROM fr)"


@register("p16_libero", f"WITH {FR}, {UN} SELECT ep, idx, v AS a0, round(1 - g, 6) AS gripper, 7 AS size, v * 2 + 10 AS e5, 0.7::DOUBLE AS g0, g AS g1 FROM un")
def p16(spark, d):
    got = transforms.named("libero")(_robot_frames(spark, d))
    return got.select("ep", "idx", F.col("action")[0].alias("a0"), F.round(F.col("action")[6], 6).alias("gripper"), F.size("action").alias("size"), F.col("eef_state")[5].alias("e5"), F.col("gripper_state")[0].alias("g0"), F.col("gripper_state")[1].alias("g1"))


@register("p16_bridge_orig", f"WITH {FR}, {UN}, b AS (SELECT ep, idx - 1 AS idx, v, g, CASE WHEN g > 0.95 THEN 1.0::DOUBLE WHEN g < 0.05 THEN 0.0::DOUBLE END AS b FROM un WHERE idx > 0), c AS (SELECT ep, idx, round(2 * (lead(v) OVER o - v), 5) AS a0, coalesce(first_value(b IGNORE NULLS) OVER w, last_value(g) OVER w) AS gripper, g AS gripper_state FROM b WINDOW o AS (PARTITION BY ep ORDER BY idx), w AS (PARTITION BY ep ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT * FROM c WHERE a0 IS NOT NULL")
def p16_bridge(spark, d):
    got = transforms.named("bridge_orig")(_robot_frames(spark, d))
    return got.select("ep", "idx", F.round(F.col("action")[0], 5).alias("a0"), F.col("action")[6].alias("gripper"), F.col("gripper_state")[0].alias("gripper_state"))


@register("p16_rt1", f"WITH {FR}, {UN}, m AS (SELECT *, CASE WHEN g - 0.5 < -0.1 THEN 1.0::DOUBLE WHEN g - 0.5 > 0.1 THEN -1.0::DOUBLE END AS m FROM un) SELECT ep, idx, v + 5 AS a5, coalesce(last_value(m IGNORE NULLS) OVER (PARTITION BY ep ORDER BY idx ROWS UNBOUNDED PRECEDING), -first_value(m IGNORE NULLS) OVER (PARTITION BY ep ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 1.0::DOUBLE) / 2 + 0.5::DOUBLE AS gripper, kind AS language_instruction FROM m")
def p16_rt1(spark, d):
    got = transforms.named("rt1")(_robot_frames(spark, d))
    return got.select("ep", "idx", F.col("action")[5].alias("a5"), F.col("action")[6].alias("gripper"), "language_instruction")


@register("p16_gnm", f"WITH {FR} SELECT ep, idx, 25 AS size, v + 2 AS a2, 0.0::DOUBLE AS last, 10 AS states, v + 3 AS yaw FROM fr")
def p16_gnm(spark, d):
    rows = _robot_frames(spark, d).withColumns({"position": F.col("world_vector"), "yaw": F.concat("rotation_delta", F.array(F.lit(0.0)))})
    got = transforms.named("gnm")(rows)
    return got.select("ep", "idx", F.size("action").alias("size"), F.col("action")[2].alias("a2"), F.col("action")[24].alias("last"), F.size("state").alias("states"), F.col("state")[6].alias("yaw"))


@register("p16_furniture_bench", f"WITH {FR}, {UN} SELECT ep, idx, round(atan2(sin(idx * 0.02), cos(idx * 0.02)), 5) AS rz, round(1 - g, 6) AS gripper, 8 AS states FROM un")
def p16_furniture(spark, d):
    got = transforms.named("furniture_bench")(_robot_frames(spark, d))
    return got.select("ep", "idx", F.round(F.col("action")[5], 5).alias("rz"), F.round(F.col("action")[6], 6).alias("gripper"), F.size("state").alias("states"))


@register("p15_restructured", f"WITH {FR} SELECT ep, idx, kind AS image_primary, '' AS image_wrist, 12 AS size, v * 2 AS s0, idx AS timestep, kind AS instruction, 'demo' AS dataset_name FROM fr")
def p15(spark, d):
    got = transforms.restructure(_robot_frames(spark, d), {"primary": "natural_language_instruction", "wrist": None}, {"state": 9, None: 3}, "natural_language_instruction", "demo")
    return got.select("ep", "idx", "image_primary", "image_wrist", F.size("proprio").alias("size"), F.col("proprio")[0].alias("s0"), "timestep", "instruction", "dataset_name")


@register("f1_standardized", f"WITH {FR}, {UN} SELECT ep, idx, 7 AS size, 0.7::DOUBLE AS state_last FROM un")
def f1(spark, d):
    got = _robot_frames(spark, d).transform(transforms.REGISTRY["ucsd_kitchen"]).transform(transforms.REGISTRY["maniskill"])
    return got.select("ep", "idx", F.size("action").alias("size"), F.col("gripper_state")[0].alias("state_last"))


@register("f3_frame_filter", f"WITH {FR} SELECT ep, idx FROM fr WHERE v > 50 AND kind <> 'error'")
def f3(spark, d):
    return filters.successful(frames(spark, d), F.col("v") > 50, F.col("kind") != "error").select("ep", "idx")


@register("f4_named_strategy", f"WITH {FR}, {UN}, b AS (SELECT ep, idx, v, g, CASE WHEN g > 0.95 THEN 1.0::DOUBLE WHEN g < 0.05 THEN 0.0::DOUBLE END AS b FROM un) SELECT ep, idx, coalesce(first_value(b IGNORE NULLS) OVER w, last_value(g) OVER w) AS gripper, v AS e0 FROM b WINDOW w AS (PARTITION BY ep ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
def f4(spark, d):
    rows = _robot_frames(spark, d).withColumns({"cartesian_position": F.col("world_vector"), "gripper_position": F.array("gripper_closedness_action")})
    return transforms.named("tdroid")(rows).select("ep", "idx", F.col("action")[6].alias("gripper"), F.col("eef_state")[0].alias("e0"))


@register("f6_flattened_episodes", f"WITH {FR}, {LEN} SELECT ep, n AS steps, n - 1 AS with_future FROM len")
def f6(spark, d):
    flat = windows.flat_windows(frames(spark, d), "v", 2, 1)
    return flat.groupBy("ep").agg(F.count(F.lit(1)).alias("steps"), F.count_if(F.col("future_mask")[0]).alias("with_future"))


@register("f2_transform_groups", f"WITH {FR} SELECT ep, idx, v * 2 + 1 AS v FROM fr")
def f2(spark, d):
    double, add = (lambda df: df.withColumn("v", F.col("v") * 2)), (lambda df: df.withColumn("v", F.col("v") + 1))
    undo, halve = (lambda df: df.withColumn("v", F.col("v") - 1)), (lambda df: df.withColumn("v", F.col("v") / 2))
    group = transforms.Group().push([double], [halve]).push([add], [undo])
    there_and_back = transforms.compose((*group.inputs, *group.outputs, *group.inputs))
    return frames(spark, d).transform(there_and_back).select("ep", "idx", "v")


@register("f5_merged_statistics", f"WITH {FR} SELECT ep, count(v) AS n, round(avg(v), 8) AS mean, round(stddev_pop(v), 8) AS std, min(v) AS low, max(v) AS high FROM fr GROUP BY ep")
def f5(spark, d):
    parts = clips.running_statistics(frames(spark, d).withColumn("ep", F.struct("ep", (F.col("idx") % 3).alias("part"))), "v").withColumn("ep", F.col("ep.ep"))
    return clips.merge_statistics(parts, "ep").select("ep", "n", F.round("mean", 8).alias("mean"), F.round("std", 8).alias("std"), "low", "high")


# ---- streams ---------------------------------------------------------------------------------------------------------
def _streamed(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """Frames and the ends of their episodes as a file stream, and a folder for its results."""
    folder = episodes.scratch_folder(spark, "stream")
    fr = frames(spark, d).select("ep", "idx", F.lit(False).alias("is_end"))
    ends = windows.lengths(fr).select("ep", F.col("n").alias("idx"), F.lit(True).alias("is_end"))
    fr.unionByName(ends).write.parquet(f"{folder}/in")
    batch = clips.files_a_batch(f"{folder}/in", spark)
    return spark.readStream.schema("ep long, idx long, is_end boolean").option("maxFilesPerTrigger", batch).parquet(f"{folder}/in"), folder


@register("r1_streamed_clips", f"WITH {_clips_sql(8, 4, 2)} SELECT ep, clip, j, idx, is_pad FROM po")
def r1(spark, d):
    stream, folder = _streamed(spark, d)
    return clips.run_over_table(clips.stream_clips(stream, 8, 4, 2), folder).where("j is not null").drop("complete")


@register("r2_completeness", f"WITH {_clips_sql(4, 4, 1)} SELECT ep, count(DISTINCT clip) AS num_clips, true AS episode_complete FROM po GROUP BY ep")
def r2(spark, d):
    stream, folder = _streamed(spark, d)
    with processors.rocksdb(spark):
        ended = clips.run_over_table(processors.cut_clips(stream, 4, 4, 1), folder, timers=True).where("j is null")
    return ended.select("ep", F.col("clip").alias("num_clips"), F.col("complete").alias("episode_complete"))


@register("r7_continued_grid", """WITH b AS (SELECT user_id, floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600 + 1e-5)::BIGINT AS k, ts, event_id FROM events), f AS (SELECT user_id, k, min_by(event_id, ts) AS event_id FROM b GROUP BY user_id, k),
    g AS (SELECT user_id, unnest(generate_series(0, max(k))) AS k FROM f GROUP BY user_id)
    SELECT user_id, k AS step, first_value(f.event_id IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value FROM g LEFT JOIN f USING (user_id, k)""")
def r7(spark, d):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)
    events = load(spark, d, "events").select("user_id", "event_id", (micros / 1e6).alias("seconds"))
    state = spark.createDataFrame([], "user_id long, next_step long")
    first, state = clips.continued_grid(events.where("seconds < 1000000"), state, "user_id", "seconds", "event_id", 3600.0)
    second, _ = clips.continued_grid(events.where("seconds >= 1000000"), state, "user_id", "seconds", "event_id", 3600.0)
    return first.unionByName(second)


@register("r8_running_statistics", f"WITH {FR} SELECT ep, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, min(v) AS low, max(v) AS high FROM fr GROUP BY ep")
def r8(spark, d):
    return clips.running_statistics(frames(spark, d), "v").withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("r9_observation_window", f"WITH {FR} SELECT ep, idx, event_id || ',' || coalesce(lag(event_id) OVER w, event_id) AS recent FROM fr WINDOW w AS (PARTITION BY ep ORDER BY idx)")
def r9(spark, d):
    return windows.stack_last(frames(spark, d), "event_id", 2).select("ep", "idx", as_text("stack").alias("stack")).select("ep", "idx", F.concat(F.substring_index("stack", ",", -1), F.lit(","), F.substring_index("stack", ",", 1)).alias("recent"))
