"""The operators on awkward rows, against brute force, SQL and held-out rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from episodia.llm import chat, common, language, maxscore, mixing, nearest, neardup, packing, registry, substrings, toxicity, urls

from ..compare import DATA, same

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, score string, spans int"


def passage(k, n=70):
    return " ".join(f"p{k}q{i}" for i in range(n))


ROWS = [
    (1, passage(1), "en", "a", 1, 9, "x", 1),
    (2, passage(1), "en", None, 1, 9, "x", 1),
    (2, passage(1), "en", None, 1, 9, "x", 1),
    (3, "", None, "b", 0, None, None, None),
    (4, None, None, None, None, None, None, None),
    (5, LONG, "de", "b", 1, 1, "y", 2),
    (6, "head " + LONG, "de", "b", 1, 1, "y", 2),
    (7, " \t\n", "fr", "c", 1, 1, "y", 2),
    (8, f"{passage(2, 30)} {passage(1)} {passage(3, 30)}", "en", "c", 1, 1, "z", 3),
    (9, "one", "en", "c", 1, 1, "z", 3),
    (10, "One", "en", "c", 1, 1, "z", 3),
    (None, passage(1), "en", "c", 1, 1, "z", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    same(registry.QUERIES[name](spark, DATA), registry.SQL[name])


def test_chat_awkward(spark):
    schema = "conv_id long, turn long, role string, text string, n int, head string"
    rows = [(1, 0, "user", "a]b[c</s>&lt;", 1, ""), (1, 1, "assistant", None, 1, ""), (1, 1, "assistant", "x", 1, ""), (1, 1, "assistant", "x", 1, ""), (None, None, None, "<s>[", 1, "")]
    out = chat.format_conversations(spark.createDataFrame(rows, schema))
    read = {r.conv_id: [(t.role, t.text) for t in r.t] for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert read == {1: [("user", "a]b[c</s>&lt;"), ("assistant", ""), ("assistant", "x"), ("assistant", "x")], None: [("", "<s>[")]}
    examples = chat.expand(out).orderBy("target_turn").collect()
    assert [e.text[e.loss_start - 1 : e.loss_start - 1 + e.loss_chars] for e in examples] == ["", "x", "x"]
    assert all(e.text.endswith("</s>") and e.text.count("</s>") == e.target_turn + 1 for e in examples)
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_url_rules_and_trees(spark):
    rows = [(i, f"https://{'bad' if i % 2 else 'good'}{i}.example.{'net' if i % 2 else 'org'}/p/{i}", "h") for i in range(200)] + [(900, None, ""), (901, "no scheme", ""), (902, "x://A.Net/en/?q", ""), (902, "x://A.Net/en/?q", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    labelled = pages.where("page_id < 200").select("url", (F.col("page_id") % 2).cast("int").alias("label"))
    got = urls.judge_urls(pages, labelled, urls.RULES[:1]).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 204 and by[902].rule == "net/" and by[902].host == "a.net" and by[902].path == "/en/"
    assert (by[900].host, by[900].path, by[901].host) == ("", "", "")
    plain = urls.judge_urls(pages.where("page_id < 200"), labelled).collect()
    assert np.mean([(r.verdict == "block") == (r.page_id % 2 == 1) for r in plain]) > 0.95
    assert urls.judge_urls(pages.limit(3), labelled.limit(0)).where("score <> 0").count() == 0


def test_url_suffixes_count_all_labels(spark, monkeypatch):
    rows = [(i, f"https://h{i}.example.{'bad' if i % 2 else 'good'}{i % 40}/p") for i in range(2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labelled = pages.select("url", (F.col("page_id") % 2).cast("int").alias("label"))
    seen, real = [], urls.suffix_sums
    monkeypatch.setattr(urls, "suffix_sums", lambda rows: seen.append(real(rows)) or seen[-1])
    assert urls.judge_urls(pages, labelled, max_training_rows=100).count() == 2000
    got = {r.suffix: (r.n, r.bad) for r in seen[0].groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).collect()}
    assert got == {f"{'bad' if k % 2 else 'good'}{k}": (50, 50 * (k % 2)) for k in range(40)}


def url_auc(spark, data):
    """Of the trees on ruled pages, trained on four fifths of them and judged on the others."""
    pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url")
    ruled = urls.split_url(pages).withColumn("found", urls.matching_rule(urls.RULES, F.col("host"), F.col("path"))).where("found is not null")
    ruled = ruled.select("page_id", "url", (F.col("found.verdict") == "block").cast("int").alias("label"))
    held = F.crc32("url") % 5 == 0
    scored = urls.judge_urls(ruled.where(held), ruled.where(~held)).select("page_id", "score").join(ruled, "page_id").select("score", "label").collect()
    score, label = np.array([r.score for r in scored]), np.array([r.label for r in scored])
    better = (score[label == 1][:, None] > score[label == 0]).mean() + (score[label == 1][:, None] == score[label == 0]).mean() / 2
    return float(better)


def test_url_trees_on_held_out_urls(spark):
    """The rules' labels hang on a path's first word, which no lexical feature shows, so the trees can only do better than chance."""
    assert url_auc(spark, DATA.replace("sf0.001", "sf0.1")) > 0.6
    rng = np.random.default_rng(8)
    rows = []
    for i in range(3000):
        bad = i % 3 == 0
        host = f"h{rng.integers(50)}.{rng.choice(['xyz', 'top', 'com'] if bad else ['com', 'org', 'de'])}"
        rows.append((i, f"http://{host}/" + ("/".join(f"{rng.integers(10**6)}" for _ in range(4)) if bad and rng.random() < 0.9 else "/".join(["about", "us", "page"][: rng.integers(1, 4)])), int(bad)))
    df = spark.createDataFrame(rows, "page_id long, url string, label int")
    got = urls.judge_urls(df.where("page_id % 5 = 0"), df.where("page_id % 5 <> 0").select("url", "label")).select("page_id", "verdict").join(df, "page_id").collect()
    assert np.mean([(r.verdict == "block") == bool(r.label) for r in got]) > 0.95


def test_url_rules_match_sql(spark):
    same(urls.query(spark, DATA).select("page_id", "host", "path", "rule"), urls.URL_SQL)


def test_urls_awkward(spark):
    schema = "page_id long, url string"
    long = "https://a.example.org/" + "x/1?" * 50_000
    rows = [(1, long), (1, long), (2, ""), (3, None), (None, "http://b.net"), (4, "://"), (5, "a://B?q"), (6, "https://Ünï.net/ä")]
    labelled = spark.createDataFrame([(f"https://h{i}.x{i % 3}/{i}", i % 2) for i in range(60)], "url string, label int")
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, schema), labelled, urls.RULES).collect()}
    assert (got[1].host, len(got[1].path), got[None].rule, got[5].host, got[6].host) == ("a.example.org", 4, None, "b", "Ünï.net")
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert urls.judge_urls(spark.createDataFrame([], schema), labelled, urls.RULES).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(900, 16)))]
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(2000, None), (2001, []), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [0.0] * 16), (2100, [1.0, 2.0]), (2200, [2.0, 1.0]), (None, rows[1][1]), (7, rows[7][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1)), rows


def test_nearest_recall_and_scores(vectors):
    df, rows = vectors
    clean = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    got = defaultdict(list)
    for r in nearest.nearest(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    hits = total = 0
    for q in (i for i in clean if i % 100 == 0):
        want = sorted((float(np.sqrt(((v - clean[q]) ** 2).sum())), i) for i, v in clean.items() if i != q and len(v) == len(clean[q]))[:10]
        total += len(want)
        hits += len({i for _, i in want} & {i for _, i in got[q]})
        assert got[q] == sorted(got[q]) and len(got[q]) == len(want)
        assert all(abs(s - np.sqrt(((clean[i] - clean[q]) ** 2).sum())) < 1e-9 for s, i in got[q])
    assert hits >= 0.95 * total
    assert nearest.nearest(df.limit(0)).count() == 0


def test_maxscore_is_exact(vectors):
    df, rows = vectors
    clean = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in maxscore.top_products(df, 50, 5, 256).collect()]
    want = [(q, k + 1, i, -s) for q in clean if q % 50 == 0 for k, (s, i) in enumerate(sorted((-int(v @ clean[q]), i) for i, v in clean.items() if i != q and len(v) == len(clean[q]))[:5])]
    assert sorted(got) == sorted(want)


def test_nearest_verifies_a_part_and_finds_nine_tenths(spark):
    data = spark.read.parquet(DATA.replace("sf0.001", "sf0.1") + "/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, rows = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], float)
    asked = ids % 100 == 0
    far = np.sqrt(((rows[asked][:, None] - rows) ** 2).sum(axis=2))
    far[ids[asked][:, None] == ids] = np.inf
    kth = np.sort(far, axis=1)[:, 9]
    first = np.sort(far[:, ::2], axis=1)[:, 9]  # thresholds from half of the rows
    verified = []
    got = nearest.CollisionIndex().search(ids, rows, ids[asked], rows[asked], first, 10, verified)
    assert np.mean([(own <= k + 1e-12).sum() for (_, own), k in zip(got, kth, strict=True)]) >= 9
    assert np.mean(verified) < 0.35 * len(ids)
    whole = np.floor(256 * rows)
    asked = ids % 50 == 0
    score = whole[asked] @ whole.T
    score[ids[asked][:, None] == ids] = -np.inf
    read = []
    got = maxscore.maxscore(ids, whole, ids[asked], whole[asked], -np.sort(score[:, ::2], axis=1)[:, -5], 5, read)
    assert all(sorted(own.tolist()) == sorted(np.sort(row)[-5:].tolist()) for (_, own), row in zip(got, score, strict=True))
    assert np.mean(read) < 0.6 * whole.size


def test_nearest_query_finds_nine_tenths(spark):
    data = DATA.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, whole = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = defaultdict(list)
    for r in nearest.query(spark, data).collect():
        found[r.query_id].append(r.vec_id)
    assert sorted(found) == sorted(ids[ids % 100 == 0].tolist())
    hits = 0
    for q in found:
        far = np.sqrt(((whole - whole[ids == q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, far))[:10]].tolist()) & set(found[q]))
    assert hits >= 0.95 * 10 * len(found)


def test_samples_of_any_share(spark):
    rows = spark.range(2_000_000_000)
    assert 1 <= rows.where(common.hash_below(F.col("id"), 5e-9)).count() <= 40  # about 10
    few = spark.range(10_000)
    assert 40 <= few.where(common.hash_below(F.col("id"), 0.01)).count() <= 200
    assert few.where(common.hash_below(F.col("id"), 1.0)).count() == 10_000
    # a table that claims 1e11 rows: the share of 20,000 rows among them
    assert spark.range(500_000_000).where(common.hash_below(F.col("id"), 20_000 / 1e11)).count() > 20


def test_models_from_tiny_samples(spark):
    urls_of = spark.createDataFrame([(f"http://h{i}.x/{i}", i % 2) for i in range(400)], "url string, label int")
    pages = urls_of.selectExpr("cast(hash(url) as long) AS page_id", "url")
    scores = {r.score for r in urls.judge_urls(pages, urls_of, max_training_rows=1).collect()}
    assert scores == {0.5} or len(scores) > 1  # one kind in the sample: the share of label 1
    texts = [(i, ("schlimm " if i % 3 == 0 else "gut ") * 40) for i in range(90)]
    docs = spark.createDataFrame([(i, f"{t} {i}", "de") for i, t in texts], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels, max_training_words=1200, thresholds=False)
    got = {r.doc_id: r.toxic_score for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([got[i] for i in got if i % 3 == 0]) > np.mean([got[i] for i in got if i % 3])


def test_queries_in_several_chunks_and_blocks(vectors):
    df, _ = vectors
    clean = maxscore.clean_vectors(df, "vec_id", "embedding", nonzero=True)
    one, many = (sorted(map(tuple, maxscore.search_blocks(clean, 20, 3, nearest.CollisionIndex(margin=5.0).search, nearest.distances, "double", True, **kw).collect())) for kw in ({}, {"block_rows": 100, "chunk_queries": 16, "sample_rows": 200}))
    assert [r[:3] for r in one] == [r[:3] for r in many] and len(one) > 100


def components(rows, width):
    sets = {}
    for i, t in rows:
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = set(zip(*[w[j:] for j in range(width)], strict=False)) if len(w) >= width else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in where[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_against_brute_force(spark, docs, none, width):
    got = neardup.near_duplicates(docs, width).collect()
    want = components([(r[0], r[1]) for r in ROWS if r[0] is not None], width)
    assert len(got) == len(ROWS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert neardup.near_duplicates(none, width).count() == 0


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(w if rng.random() > 0.03 else f"n{rng.integers(10**6)}" for w in base)) for i in range(600)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == components(rows, 2)


def test_star_of_copies_around_a_middle_id(spark):
    rng = np.random.default_rng(4)
    base, rows = [f"b{i}" for i in range(181)], []
    for i in range(3000):
        words = list(base)
        for at in rng.choice(np.arange(1, 180, 2), 9, replace=False) if i != 1500 else ():
            words[at] = f"n{i}x{at}"
        rows.append((i, " ".join(words)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 3000


def test_dense_regions_are_compared_in_full(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(181)]
    rows = [(i, " ".join(w if i in (70, 140) or rng.random() > 0.045 else f"n{rng.integers(10**6)}" for w in (base if i < 100 else [*base[:90], *(f"c{j}" for j in range(91))]))) for i in range(200)]
    monkeypatch.setattr(neardup, "CELL_ROWS", 16)
    monkeypatch.setattr(neardup.Forest, "pairs", lambda self, tree, keys, ids, sketches: (ids[:0], ids[:0], np.zeros(0, np.int64)))
    forest = neardup.Forest(region=1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, forest=forest).collect()}
    assert got == components(rows, 2)


def exact_links(rows, width):
    """All pairs with 100 * shared >= 80 * union among different sets, by rare shingles: equal pairs share one of the rarest fifth."""
    sets, number = {}, {}
    for i, t in rows:
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        own = set(zip(*[w[j:] for j in range(width)], strict=False)) if len(w) >= width else {tuple(w)} - {()}
        if own:
            sets.setdefault(frozenset(number.setdefault(x, len(number)) for x in own), []).append(i)
    often = Counter(x for s in sets for x in s)
    where, links = defaultdict(list), [(min(ids), i) for ids in sets.values() for i in ids if i != min(ids)]
    for s in sorted(sets, key=len):
        rare = sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-len(s) * 4 // 5) + 1]
        for other in {o for x in rare for o in where[x]}:
            n = len(s & other)
            if 100 * n >= 80 * (len(s) + len(other) - n):
                links.append((min(sets[s]), min(sets[other])))
        for x in rare:
            where[x].append(s)
    return links


def test_near_duplicates_lose_no_link_of_a_whole_table(spark):
    data = spark.read.parquet(DATA.replace("sf0.001", "sf0.1") + "/documents.parquet")
    links = exact_links([(r.doc_id, r.text) for r in data.select("doc_id", "text").collect()], 2)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(data, 2).collect()}
    assert len(links) > 1000 and all(got[a] == got[b] for a, b in links)
    root = {i: i for i in got}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert got == {i: find(i) for i in root}


def test_regions_across_partitions_are_stitched(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(60):
        base = [f"b{k}x{i}" for i in range(60)]
        rows += [(20 * k + i, " ".join(w if rng.random() > 0.03 else f"n{rng.integers(10**6)}" for w in base)) for i in range(20)]
    monkeypatch.setattr(neardup, "ORDER_ROWS", 300)
    monkeypatch.setattr(neardup, "_dense", lambda *a: None)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == components(rows, 2)


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    rng = np.random.default_rng(2)
    x, y = ([np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.int32) for _ in range(n)] for n in (9, 5))
    shared, total = neardup.shared_counts(x, y)
    assert all(shared[i, j] == len(set(a) & set(b)) and total[i, j] == len(a) + len(b) for i, a in enumerate(x) for j, b in enumerate(y))
    assert neardup.shared_counts([np.array([1], np.int32)], [np.array([2], np.int32)])[0].tolist() == [[0]]


def test_ids_repeated_with_different_texts(spark):
    rows = [(1, passage(1)), (5, passage(1)), (5, passage(2)), (6, passage(2)), (7, passage(3)), (7, "")]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect())
    assert got == [(1, 66, 1), (5, 66, 1), (5, 66, 1), (6, 66, 1), (7, 0, 7), (7, 66, 7)]


def repeats(rows, width=50):
    first, out = {}, []
    for i, t in sorted(r for r in rows if r[0] is not None):
        w = WORDS.findall(t or "")
        for k in range(len(w) - width + 1):
            first.setdefault(hash(tuple(w[k : k + width])), i)
    for i, t in rows:
        w, gone = WORDS.findall(t or ""), set()
        for k in range(len(w) - width + 1 if i is not None else 0):
            if first[hash(tuple(w[k : k + width]))] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), [x for k, x in enumerate(w) if k not in gone]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(500, 5000, 100_000, 1000), (3, 100, 300, 0)])
def test_repeats_against_brute_force(spark, docs, none, sizes, monkeypatch):
    for name, size in zip(("SHARD_ANCHORS", "SHARD_WORDS", "STREAM_WORDS", "KEY_ROWS"), sizes, strict=True):
        monkeypatch.setattr(substrings, name, size)
    got = [(r.doc_id, r.n_words, r.n_removed, WORDS.findall(r.text or "")) for r in substrings.remove_repeats(docs).collect()]
    assert sorted(got, key=str) == repeats([(r[0], r[1]) for r in ROWS])
    assert substrings.remove_repeats(none).count() == 0


def test_repeats_of_one_passage_in_a_third_of_all_documents(spark):
    rng = np.random.default_rng(11)
    words = lambda n: [f"w{x}" for x in rng.integers(400, size=n)]
    hot, base = passage(7, 80), words(150)
    rows = []
    for i in range(900):
        if i % 3 == 0:
            rows.append((i, " ".join([*words(rng.integers(0, 60)), hot, *words(rng.integers(0, 60))])))
        elif i % 3 == 1:
            rows.append((i, " ".join(w if rng.random() > 0.03 else f"n{rng.integers(50)}" for w in base)))
        else:
            rows.append((i, " ".join(words(rng.integers(0, 120)))))
    rows += [(2000 + i, rows[0][1]) for i in range(100)]
    got = [(r.doc_id, r.n_words, r.n_removed, WORDS.findall(r.text or "")) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()]
    assert sorted(got, key=str) == repeats(rows)
    assert substrings.grams(50, 12) == [12, 41, 48, 50] and substrings.grams(10, 10) == [10]


def test_suffix_automaton_windows():
    rng = np.random.default_rng(0)
    texts = [[b"%d" % x for x in rng.integers(3, size=60)] for _ in range(8)]
    a = substrings.SuffixAutomaton()
    for i, t in enumerate(texts):
        a.add(t, i)
    a.close()
    for t in [*texts, [b"%d" % x for x in rng.integers(3, size=60)]]:
        want = [next((i for i, o in enumerate(texts) if any(o[m : m + 5] == t[k : k + 5] for m in range(56))), None) for k in range(56)]
        assert a.windows(t, 5) == want


def test_packing_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.word_bpe())
    odd = [(20, "<|endoftext|>. I'LL go, ΣΑΣ İ. x². dogs'. a\tb\r\nc"), (21, "é́, ﬁ. ①!")]
    df = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit("x")))
    got = packing.pack_documents(df, packing.word_bpe()).collect()
    want = Counter()
    for key, text in [(r[0], r[1]) for r in ROWS] + odd:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[key, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert packing.pack_documents(none, packing.word_bpe()).count() == 0
    bins, _ = packing.best_fit(np.array([5] * 9), (10, 10, 25))
    assert len(set(bins.tolist())) == 9  # attention cost binds
    bins, _ = packing.best_fit(np.array([1] * 9), (10, 3, 100))
    assert len(set(bins.tolist())) == 3  # documents bind


def test_packing_leaves_little_room(spark):
    rng = np.random.default_rng(12)
    lengths = np.minimum(rng.lognormal(4, 1.3, 9000).astype(int) + 1, 2048)
    df = spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    got = packing.pack_pieces(common.materialize(df, "pieces"), group_rows=500).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert sorted(r.id for r in got) == list(range(9000)) and len(by) <= 1.003 * lengths.sum() / 2048 + 1
    for own in by.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0 and sum(own[-1]) <= 2048


def test_mixing_awkward(docs, none):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    totals = {r.source: (r.target, r.source_size) for r in got}
    assert set(totals) == {"a", "b", "c", None}
    assert abs(sum(t for t, _ in totals.values()) - 1.5 * sum(s for _, s in totals.values())) < 1e-6
    assert mixing.mix_sources(none).count() == 0


def test_mixing_comes_near_targets_with_repeated_and_null_ids(spark):
    rows = [(7, " ".join(["w"] * 100), "a")] * 50 + [(None, f"n{i} x y z", "b") for i in range(400)] + [(i % 3, f"t{i} " * 5, "c") for i in range(300)] + [(None, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    for weights in ((5, 2, 1), (1, 3, 1)):
        got = defaultdict(list)
        for r in mixing.mix_sources(df, weights).collect():
            got[r.source].append(r)
        assert sum(map(len, got.values())) == len(rows)
        for own in got.values():
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 + 1e-6
            assert all(r.taken <= 2 * r.size for r in own)
        again = Counter((r.doc_id, r.source, r.size, r.taken) for r in mixing.mix_sources(df, weights).collect())
        assert again == Counter((r.doc_id, r.source, r.size, r.taken) for own in got.values() for r in own)
    carried = mixing.mix_sources(df, carry=["text", "source"]).where("copies > 0").select("row.*")
    assert carried.columns == ["text", "source"] and carried.count() > 0


def test_samples_are_bounded_by_rows(spark):
    rows = [(7, f"word{i % 40} bad", "en", 1) for i in range(3000)] + [(i, f"word{i} fine", "de", 0) for i in range(100, 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = df.select("doc_id", "toxic").distinct()
    model = toxicity.fit_toxicity(df, labels, max_training_rows=1000)
    assert not isinstance(model, float)
    assert language.fit_languages(df.unionByName(df.withColumn("doc_id", F.lit(1).cast("long"))), max_training_rows=100).languages == ["de", "en"]
    assert isinstance(toxicity.fit_toxicity(df.where("doc_id = 7"), labels), float)


def test_chat_long_turn_and_many_examples(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", ("<s>[&]" * 20_000) if i == 5 else f"t{i}") for i in range(40)]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    losses = [r.loss for r in chat.explode_examples(out).orderBy("target_turn").select(chat.loss_text(F.col("formatted")).alias("loss")).collect()]
    assert losses == [r[3] for r in rows if r[2] == "assistant"]


def test_toxicity_held_out(spark, docs, none):
    data = DATA.replace("sf0.001", "sf0.1")
    rows = toxicity.query(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = [(r.predicted, r.toxic) for r in rows]
    assert np.mean([a == b for a, b in hit]) > 0.95
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([(1, None), (8, 1), (9, 0), (9, 0)], "doc_id long, toxic int"))
    out = toxicity.score_toxicity(docs.withColumn("toxic_score", F.lit("clash")), model)
    assert out.count() == len(ROWS) and out.where("toxic_score is null or toxic_score < 0 or toxic_score > 1").count() == 0
    assert toxicity.score_toxicity(none, toxicity.fit_toxicity(none, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_toxicity_thresholds_cover_all_labels(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(3000):
        bad = i % 10 == 0
        words = [f"w{rng.integers(300)}" for _ in range(20)] + ["vile"] * (bad and rng.random() < 0.8)
        rows.append((i, " ".join(words), "de" if i % 3 == 0 else "en", int(bad)))
    rows += [(5000 + i, "w1 vile", "xx", 1) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit_toxicity(df, df.select("doc_id", "toxic"), max_training_rows=400)
    assert set(model.thresholds) == {None, "de", "en"}
    own = toxicity.fit_thresholds(model, df.withColumnRenamed("toxic", "label")).thresholds
    scores, y = toxicity.Scorer(model).scores([r[1] for r in rows]), np.array([r[3] for r in rows])
    for name in (None, "de", "en"):
        of = np.array([name in (None, r[2]) for r in rows])
        f1 = lambda cut: 2 * ((scores >= cut) & (y > 0) & of).sum() / (((scores >= cut) & of).sum() + y[of].sum())
        assert f1(own[name]) > max(map(f1, scores[of & (scores >= 0.2) & (scores <= 0.8)][:300]), default=0) - 0.005


def test_language_held_out(spark, docs, none):
    data = DATA.replace("sf0.001", "sf0.1")
    rows = language.query(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    got = language.identify_languages(docs, language.fit_languages(docs)).collect()
    assert len(got) == len(ROWS) and all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (3, 4, 7))
    assert all(r.lang_pred == "und" for r in language.identify_languages(docs, language.fit_languages(none)).collect())


def mixed(rows):
    """Copies of each row by sorting whole sources by place; rows: (doc_id, text, lang, source, n_chars)."""
    sizes = [len(WORDS.findall(r[1] or "")) for r in rows]
    by = defaultdict(list)
    for k, r in enumerate(rows):
        by[r[3]].append(k)
    order = sorted(by, key=lambda x: (x is None, x or ""))
    weight = {x: (5.0, 2.0, 1.0)[i % 3] for i, x in enumerate(order)}
    total = {x: sum(sizes[k] for k in by[x]) for x in order}
    target, free, left = {}, set(order), 1.5 * sum(sizes)
    while free:
        level = left / sum(weight[x] for x in free)
        full = {x for x in free if weight[x] * level >= 2 * total[x]}
        for x in full or free:
            target[x] = 2.0 * total[x] if full else weight[x] * level
        left -= sum(target[x] for x in full)
        free = free - full if full else set()
    out = Counter()
    for x in order:
        whole = int(target[x] // total[x]) if total[x] else 0
        budget, upto = target[x] - whole * total[x], 0
        for k in sorted(by[x], key=lambda k: (int(hashlib.md5(f"{'' if rows[k][0] is None else rows[k][0]}:{rows[k][1] or ''}".encode()).hexdigest()[:12], 16), sizes[k])):
            before, upto = upto, upto + sizes[k]
            out[rows[k]] += whole + (budget > 0 and (upto <= budget or (before <= budget and upto - budget < budget - before)))
    return Counter({r: n for r, n in out.items() if n})


def pieces_of(rows):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(packing.word_bpe()), Counter()
    for r in rows:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            out[r[0], k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    return out


def check_stage(spark, name, before, out, data=DATA):
    """A stage's rows against what its rule, followed row by row, makes of the rows before."""
    columns = corpus_pipeline.COLUMNS
    if name == "packing":
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces_of(before)
        by = defaultdict(list)
        for r in out:
            by[r.sequence_id].append((r.offset, r.length))
        for own in by.values():
            own.sort()
            assert all(o == sum(n for _, n in own[:k]) for k, (o, _) in enumerate(own)) and sum(n for _, n in own) <= 2048
        return
    got = [tuple(r[c] for c in columns) for r in out]
    if name == "toxicity":
        df = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
        model = toxicity.fit_toxicity(df, spark.read.parquet(f"{data}/labels.parquet"))
        score = [model] * len(before) if isinstance(model, float) else toxicity.Scorer(model).scores([r[1] for r in before])
        cuts = {None: 0.5} if isinstance(model, float) else model.thresholds
        want = [r for r, s in zip(before, score, strict=True) if s < cuts.get(r[2], cuts[None])]
    elif name == "near_duplicates":
        roots = components([(r[0], r[1]) for r in before if r[0] is not None], 5)
        want = [r for r in before if r[0] is None or roots[r[0]][1] == r[0]]
    elif name == "repeated_passages":
        kept = defaultdict(list)
        for i, n, gone, words in repeats([(r[0], r[1]) for r in before]):
            if not gone or gone < n:
                kept[i].append((gone, words))
        assert sorted(((r[0], WORDS.findall(r[1] or "")) for r in got), key=str) == sorted(((i, w) for i, own in kept.items() for _, w in own), key=str)
        same = {r for r in got if any(not gone and WORDS.findall(r[1] or "") == w for gone, w in kept[r[0]])}
        assert same <= set(before) and all(r[4] == len(r[1]) for r in set(got) - same)
        return
    else:
        assert Counter(got) == mixed(before)
        return
    assert Counter(got) == Counter(want)


def test_pipeline_stages_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    rows += [(r[0] and r[0] + 100_000, *r[1:5]) for r in ROWS if r[0] != 2]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        df = common.materialize(stage(spark, df, DATA), name)
        out = df.collect()
        check_stage(spark, name, rows, out)
        rows = [tuple(r) for r in out]


def test_pipeline_on_no_documents(spark, none):
    df = none.select(*corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, DATA)
        assert df.count() == 0, name
        df = common.materialize(df, name)


def test_pipeline_runs_all_stages(spark):
    docs = corpus_pipeline.table(spark, DATA, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, DATA), "stage")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, DATA).select(columns).collect())) == pieces_of([tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()])


def test_pipeline_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == list(corpus_pipeline.COLUMNS), name
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, DATA).select("doc_id").collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 1, 3, 4, 5, 7, 8, 9]
    cut = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, DATA).collect()}
    assert 2 not in cut and cut[1] == passage(1) and cut[8] == f"{passage(2, 30)} {passage(3, 30)}" and hashlib.md5(cut[5].encode()).digest() == hashlib.md5(LONG.encode()).digest()
