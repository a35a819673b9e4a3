"""Spelling variants: words one edit apart by pairs of numbered trie nodes, and the form that each variant belongs to."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialize, table, trimmed

#: What words are made of.
LETTERS = r"A-Za-zÀ-ÿ"
#: Node numbers of one partition of the sorted words lie below this; the partition's own number is what stands above.
_PER_PARTITION = 1 << 40


def count_words(docs: DataFrame, least_chars: int = 6, least: int = 5, slip: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least `least_chars` code points with n >= `least` occurrences in all texts.

    A word is a maximal run of LETTERS, A-Z lower-cased. With slip, the occurrence whose crc32 of "id:run" is a multiple
    of it loses the code point at crc32 % length first, as a typist would. Null text has no words; a null id is empty.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("word"))
    if slip:
        code = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        runs = runs.withColumn("at", F.when(code % slip == 0, (code % F.length("word")).cast("int")))
        cut = F.concat(F.substring(F.col("word"), F.lit(1), F.col("at")), F.substring(F.col("word"), F.col("at") + 2, F.length("word")))
        runs = runs.withColumn("word", F.when(F.col("at").isNull(), F.col("word")).otherwise(cut))
    return runs.where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _shared(a: str, b: str) -> int:
    """How many leading characters two words share, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def _number_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words -> (key, part, nodes): the numbers of the nodes on a word's way through the partition's own trie, the root (0) first."""
    part = TaskContext.get().partitionId()
    last, nodes, used = "", [0], part * _PER_PARTITION
    for batch in batches:
        keys, out = batch.column(0).to_pylist(), []
        for key in keys:
            kept = _shared(last, key)
            nodes = nodes[: kept + 1] + list(range(used + 1, used + len(key) - kept + 1))
            used += len(key) - kept
            last = key
            out.append(nodes)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([part] * len(keys), pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["key", "part", "nodes"])


def _stitched(bounds: list[tuple[int, str, str]]) -> dict[int, tuple[str, list[int], str, list[int]]]:
    """Of each partition (part, first, last word; in order): its first word with the numbers of those of its nodes that the partition before has too, its last word and those that the next one has."""
    starts: list[list[int]] = []
    for i, (part, first, _) in enumerate(bounds):
        own = [-(part * _PER_PARTITION + d) for d in range(1, _shared(bounds[i - 1][2], first) + 1)] if i else []
        if i > 1:  # nodes that reach over all of the partition before keep their numbers
            kept = min(len(starts[-1]), len(own), _shared(bounds[i - 1][1], first))
            own[:kept] = starts[-1][:kept]
        starts.append(own)
    ends = [*starts[1:], []] if bounds else []
    return {part: (first, start, last, end) for (part, first, last), start, end in zip(bounds, starts, ends, strict=True)}


def number_nodes(words: DataFrame, backwards: bool = False) -> DataFrame:
    """(word, nodes): every word's way through the trie of all words, or of all words read backwards: the numbers of its nodes by depth, the root's 0 first.

    Two words have the same number at depth d if and only if they share their first (last) d code points. The words
    are sorted in ranges, and each range numbers the nodes of its own trie, in memory for one word. Nodes that several
    ranges have are prefixes of the ranges' first words; those words alone, two a range, go to the driver, which gives
    these nodes numbers of their own.
    """
    key = F.reverse("word") if backwards else F.col("word")
    sorted_words = words.select(key.alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    own = materialize(sorted_words.mapInArrow(trimmed(_number_sorted), "key string, part long, nodes array<long>"), "nodes")
    bounds = sorted((r.part, r.first, r.last) for r in own.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).collect())
    stitches = words.sparkSession.sparkContext.broadcast(_stitched(bounds))

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, ways = (c.to_pylist() for c in batch.columns)
            for key, part, nodes in zip(keys, parts, ways, strict=True):
                first, start, last, end = stitches.value[part]
                for word, numbers in ((first, start), (last, end)):
                    if numbers:
                        d = min(len(numbers), _shared(key, word))
                        nodes[1 : d + 1] = numbers[:d]
            words = [key[::-1] for key in keys] if backwards else keys
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(ways, pa.list_(pa.int64()))], ["word", "nodes"])

    return own.mapInArrow(trimmed(stitch), "word string, nodes array<long>")


def node_pairs(words: DataFrame) -> DataFrame:
    """(word, n, prefix, suffix, skip, run): the pair dictionary of words (word, n).

    A word has a pair for each place between its code points (skip false: what stands before, what stands after) and
    one for each code point that is left out (skip true); run is whether that code point begins a run of equal ones.
    A pair names two nodes and thereby a string and a place in it.
    """
    ahead = number_nodes(words).withColumnRenamed("nodes", "prefixes")
    back = number_nodes(words, backwards=True).select("word", F.reverse("nodes").alias("suffixes"))
    both = words.join(ahead, "word").join(back, "word")
    pair = lambda i, j, skip, run: F.struct(F.get("prefixes", i).alias("prefix"), F.get("suffixes", j).alias("suffix"), F.lit(skip).alias("skip"), run.alias("run"))
    size = F.size("prefixes") - 1
    chars = F.split("word", "")
    both = both.withColumn("chars", chars)
    begins = lambda i: (i == 0) | (F.get("chars", i) != F.get("chars", i - 1))
    between = F.transform(F.sequence(F.lit(0), size), lambda i: pair(i, i, False, F.lit(False)))
    left_out = F.transform(F.sequence(F.lit(0), size - 1), lambda i: pair(i, i + 1, True, begins(i)))
    return both.select("word", "n", F.explode(F.concat(between, left_out)).alias("pair")).select("word", "n", "pair.*")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of words (word, n; each word once): how many words are exactly one inserted, deleted or replaced code point away, and of these the one of the largest n (ties: the smallest word).

    Equal pairs meet. Two words that leave a code point out of the same pair differ in that code point: one is
    replaced. A word that leaves one out of a pair that another word has whole is one code point longer; of a run of
    equal code points the first alone counts, so that every such two meet once. All members of a pair are thus near to
    one another, and no two are listed: each row reads its pair's counts and best words from one sorted window. A
    pair has as many rows as there are code points at most.

    Words without a near one have n_near 0 and null form. Words of one code point meet in the empty string, which is
    none of them. Words of no code points take no part. No words give no rows.
    """
    pairs = node_pairs(words.where("word <> ''"))
    group = Window.partitionBy("prefix", "suffix")
    in_order = group.orderBy(F.col("skip").desc(), F.col("n").desc(), "word")
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct((-F.col("n")).alias("down"), F.col("word").alias("near"))
    longer = F.col("skip") & F.col("run")
    seen = pairs.select(
        "word",
        "skip",
        "run",
        F.row_number().over(in_order).alias("nth"),
        F.count(F.when(F.col("skip"), 1)).over(whole).alias("skips"),
        F.count(F.when(longer, 1)).over(whole).alias("longer"),
        F.min(F.when(longer, own)).over(whole).alias("best_longer"),
        F.min(F.when(~F.col("skip"), own)).over(whole).alias("shorter"),
        F.first(own).over(whole).alias("first"),
        F.nth_value(own, 2).over(whole).alias("second"),
    )
    replaced = F.when(F.col("skips") > 1, F.when(F.col("nth") == 1, F.col("second")).otherwise(F.col("first")))
    cut = F.when(F.col("run"), F.col("shorter"))
    near = F.when(F.col("skip"), F.col("skips") - 1 + cut.isNotNull().cast("long")).otherwise(F.col("longer"))
    best = F.when(F.col("skip"), F.least(replaced, cut)).otherwise(F.col("best_longer"))
    summed = seen.select("word", near.alias("near"), best.alias("best")).where("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return words.join(summed, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("form"), (-F.col("best.down")).alias("form_n"))


def variant_groups(words: DataFrame, times: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (word, n; each word once).

    form is a word's near word of the largest n, if that is at least `times` its own, else null (form_n likewise); root
    is where the forms lead from it, the word itself without one. n grows by `times` at each step, so there are no circles
    and ways are short: a few rounds in which every word skips to its form's form find all roots.
    """
    near = near_words(words)
    follows = F.col("form_n") >= F.col("n") * times
    rows = materialize(near.withColumn("form", F.when(follows, F.col("form"))).withColumn("form_n", F.when(F.col("form").isNotNull(), F.col("form_n"))), "forms")
    leads = materialize(rows.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = leads.select(F.col("word").alias("root"), F.col("root").alias("further"))
        leads = materialize(leads.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if leads.where("moved").isEmpty():
            break
        leads = leads.select("word", "root")
    return rows.join(leads.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(materialize(count_words(table(spark, sf_dir, "documents").select("doc_id", "text")), "words"))


_BYTES = "flatten(list_transform(string_split(doc || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c)::BIGINT >> 6), 128 + (ord(c)::BIGINT & 63)] END))"
#: Near words by their strings with one code point left out.
SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (SELECT run, k, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) AS h FROM counted, crc),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM coded),
words AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cuts AS MATERIALIZED (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near FROM cuts AS a JOIN cuts AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT c.word, w.word FROM cuts AS c JOIN words AS w ON c.rest = w.word
          UNION SELECT w.word, c.word FROM cuts AS c JOIN words AS w ON c.rest = w.word),
ranked AS (SELECT p.word, p.near, w.n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS nth FROM pairs AS p JOIN words AS w ON w.word = p.near),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN near END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n FROM words AS w LEFT JOIN ranked AS r ON r.word = w.word AND nth = 1),
ways AS (SELECT word, word AS at, form AS next FROM forms UNION ALL SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON forms.word = ways.next)
SELECT f.word, f.form, ways.at AS root, f.n, f.n_near, f.form_n FROM forms AS f JOIN ways ON ways.word = f.word AND ways.next IS NULL
"""
