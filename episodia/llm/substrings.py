"""Substring dedup: passages that a document with a smaller id has too, found by suffix automata of reference shards."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KEY_ROWS, WORD, join_counted, lasting, materialize, scratch, small, table, trimmed
from .words import gram_hashes, split_words, word_hashes

#: Shared anchors of one reference shard; an anchor stands for some tens of words.
SHARD_ANCHORS = 500
#: Words of one reference document in one shard.
SHARD_WORDS = 5_000
#: Words that one task streams against a shard's automaton.
STREAM_WORDS = 100_000
#: Pieces left by a round that one task takes up.
PIECE_ROWS = 5_000


class SuffixAutomaton:
    """All substrings of some word sequences; every state knows the smallest document id in which it ends."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.low = [-1], [0], [None]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.low.append(None)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """q itself if it is p's direct successor, else a copy of it that is."""
        length = self.length[p] + 1
        if self.length[q] == length:
            return q
        clone = self._state(length, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes], doc: int) -> None:
        last, following, link = 0, self.next, self.link
        for word in words:
            q = following[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
            else:
                new, p = self._state(self.length[last] + 1, 0, {}), last
                while p >= 0 and word not in following[p]:
                    following[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, word, following[p][word])
                last = new
            if self.low[last] is None or doc < self.low[last]:
                self.low[last] = doc

    def close(self) -> None:
        """Hand the smallest ids to the suffixes, longest states first."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if self.low[s] is not None and (self.low[up] is None or self.low[s] < self.low[up]):
                self.low[up] = self.low[s]

    def windows(self, words: list[bytes], width: int) -> list[int | None]:
        """For each window of `width` words: the smallest id of a reference that has it, None if none has.

        Matching statistics: state and length of the longest match that ends at each word; where it spans the window,
        the state that holds the window itself lies up the suffix links.
        """
        state, matched, out = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if i + 1 >= width:
                s = state
                if matched >= width:
                    while self.length[self.link[s]] >= width:
                        s = self.link[s]
                out.append(self.low[s] if matched >= width else None)
        return out


def window_anchors(words: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The smallest gram hash of every window of `width` words: equal windows have equal anchors."""
    low = gram_hashes(words, gram)
    span, have = width - gram + 1, 1
    if len(low) < span:
        return low[:0]
    while have < span:
        step = min(have, span - have)
        low, have = np.minimum(low[:-step], low[step:]), have + step
    return low


def grams(width: int, gram: int) -> list[int]:
    """Gram lengths of the rounds: what a window has beyond a gram shrinks to a quarter each time, at last to nothing."""
    out = [gram]
    while out[-1] < width:
        out.append(width - (width - out[-1]) // 4)
    return out


def runs(labels: np.ndarray) -> list[tuple[int, int]]:
    """(first, past last) of the longest stretches of equal labels."""
    cuts = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)]
    return list(itertools.pairwise(cuts)) if len(labels) else []


def only(rows: DataFrame, table: DataFrame, key: list[str], n: int) -> DataFrame:
    """rows without those whose key is not among table's n, if the keys can be broadcast; so fewer texts move. Else all rows."""
    return rows.join(F.broadcast(table.select(*key)), key, "left_semi") if n <= KEY_ROWS else rows


KEY = ["id", "mark", "start"]
NONE = np.iinfo(np.int64).max
SPANS = "array<struct<begin:int,end:int>>"


def _sketch(pieces: DataFrame, width: int, gram: int) -> DataFrame:
    """Of each piece with a window: its number of words, a 128-bit hash of them, and its different anchors.

    An anchor comes with the part of the document, of SHARD_WORDS words, in which it first stands.
    """

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for frame in frames:
            out = []
            for key, mark, start, text in zip(*(frame[c].tolist() for c in (*KEY, "text")), strict=True):
                words = split_words(text)
                if len(words) >= width:
                    of = hashes.of(words)
                    anchors, first = np.unique(window_anchors(of, width, gram), return_index=True)
                    whole = np.frombuffer(xxhash.xxh3_128_digest(of.tobytes()), np.int64).tolist()
                    out.append((key, mark, start, len(words), *whole, anchors.astype(np.int64), ((start + first) // SHARD_WORDS).astype(np.int32)))
            yield pd.DataFrame(out, columns=[*KEY, "words", "hash_a", "hash_b", "anchors", "parts"])

    return pieces.select(*KEY, "text").mapInPandas(trimmed(sketch), "id long, mark long, start int, words int, hash_a long, hash_b long, anchors array<long>, parts array<int>")


def _segments(pieces: DataFrame, live: DataFrame, shared: DataFrame, n_anchors: int, width: int, gram: int) -> DataFrame:
    """(shard, role, id, mark, start, words, text): the longest stretches of windows of shared anchors that meet in one shard.

    Role 0 is reference: windows whose anchor no smaller id has. Role 1 is to be streamed against the reference.
    """
    anchors = live.select(*KEY, F.explode("anchors").alias("anchor"))
    met = join_counted(anchors, shared, ["anchor"], n_anchors).where("shard is not null")
    lists = met.groupBy(*KEY).agg(F.collect_set(F.struct("anchor", (F.col("first") == F.col("id")).alias("is_first"), "shard")).alias("met"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for frame in frames:
            out = []
            for key, mark, start, text, anchors, is_first, shards in zip(*(frame[c].tolist() for c in (*KEY, "text", "anchors", "is_first", "shards")), strict=True):
                words, order = split_words(text), np.argsort(anchors)
                own = window_anchors(hashes.of(words), width, gram).astype(np.int64)
                at = np.minimum(np.searchsorted(anchors[order], own), len(order) - 1)
                label = np.where(anchors[order][at] == own, 2 * shards[order][at] + ~is_first[order][at], -1)
                for begin, end in runs(label):
                    if label[begin] >= 0:
                        out.append((label[begin] // 2, label[begin] % 2, key, mark, start + begin, end - begin - 1 + width, b" ".join(words[begin : end - 1 + width]).decode()))
            yield pd.DataFrame(out, columns=["shard", "role", *KEY, "words", "text"])

    lists = materialize(lists, "lists")
    joined = only(pieces, lists, KEY, lists.count()).join(lists, KEY).select(*KEY, "text", F.col("met.anchor").alias("anchors"), F.col("met.is_first").alias("is_first"), F.col("met.shard").alias("shards"))
    return joined.mapInPandas(trimmed(cut), "shard long, role int, id long, mark long, start int, words int, text string")


def _stream(segments: DataFrame, width: int) -> DataFrame:
    """(id, mark, start, spans, text): what a segment shares with a smaller id, and, with text, each stretch of windows left.

    A shard's reference goes to all tasks that stream its documents, one for each STREAM_WORDS words, which build its
    suffix automaton and take the documents' matching statistics against it.
    """
    loads = materialize(segments.where("role = 1").groupBy("shard").agg(F.ceil(F.sum("words") / STREAM_WORDS).cast("int").alias("tasks")).where("tasks > 1"), "loads")
    segments = segments.join(small(loads, loads.count()), "shard", "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))
    task = F.when(F.col("role") == 1, F.array(F.pmod(F.xxhash64(*KEY), "tasks").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("tasks") - 1))

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        lowest: dict[str, int] = {}
        is_reference = frame["role"].to_numpy() == 0
        for text, key in zip(*(frame.loc[is_reference, c].tolist() for c in ("text", "id")), strict=True):
            lowest[text] = min(key, lowest.get(text, key))
        reference = SuffixAutomaton()
        for text, key in lowest.items():
            reference.add(text.encode().split(), key)
        reference.close()
        judged: dict[str, tuple[list[bytes], np.ndarray]] = {}
        out = []
        for key, mark, start, text in zip(*(frame.loc[~is_reference, c].tolist() for c in (*KEY, "text")), strict=True):
            if text not in judged:
                words = text.encode().split()
                judged[text] = words, np.array([NONE if low is None else low for low in reference.windows(words, width)], np.int64)
            words, low = judged[text]
            found = low < key
            spans = []
            for begin, end in runs(found):
                if found[begin]:
                    spans.append({"begin": start + begin, "end": start + end - 1 + width})
                else:
                    out.append((key, mark, start + begin, None, b" ".join(words[begin : end - 1 + width]).decode()))
            if spans:
                out.append((key, mark, start, spans, None))
        return pd.DataFrame(out, columns=[*KEY, "spans", "text"])

    groups = segments.agg(F.count_distinct("shard"), F.coalesce(F.sum(F.when(F.col("role") == 1, F.col("words"))), F.lit(0))).first()
    parts = max(1, -(-(groups[0] + groups[1] // STREAM_WORDS) // 8))  # so many that small shards don't end in a few long tasks
    dealt = segments.select("shard", F.explode(task).alias("task"), "role", *KEY, "text").repartition(parts, "shard", "task")
    return dealt.groupBy("shard", "task").applyInPandas(judge, f"id long, mark long, start int, spans {SPANS}, text string")


def repeated_spans(docs: DataFrame, width: int = 50, gram: int = 12) -> DataFrame:
    """(id, mark, spans): the words of each text that lie in a window that a smaller id has too. docs: id, mark, text.

    Rounds over pieces of text, at first the documents, with ever longer grams:

    1. Equal pieces: what a smaller id has as a whole is repeated as a whole; the smallest id's piece goes on.
    2. Every window has an anchor, the smallest of its gram hashes, so equal windows have equal anchors. Of each anchor in
       two documents or more, the document of the smallest id is the reference. Reference windows are cut into shards
       by document, of bounded size whatever the number of documents that share them.
    3. A suffix automaton of each shard gives the matching statistics of the documents that share its anchors: where a
       match spans a window that a smaller id has, the window is repeated.
    4. Windows that the reference does not have are the next round's pieces: they may still be equal among each other. In
       the last round the gram is the window, so that nothing is left.
    """
    spark = docs.sparkSession
    with scratch(spark, "repeats"):
        pieces, found = docs.withColumn("start", F.lit(0)), []
        for own in grams(width, gram):
            sketch = materialize(_sketch(pieces, width, own), "sketch")
            classes = materialize(sketch.groupBy("hash_a", "hash_b").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last").drop("last"), "classes")
            marked = materialize(join_counted(sketch, classes, ["hash_a", "hash_b"], sketch.count()), "marked")
            whole = F.array(F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("words")).alias("end")))
            found.append(marked.where("first < id").select("id", "mark", whole.alias("spans")))
            live = marked.where("first is null or first = id")
            anchors = live.select("id", F.explode(F.arrays_zip("anchors", "parts")).alias("a"))
            place = F.min(F.struct("id", "a.parts")).alias("place")
            shared = anchors.groupBy("a.anchors").agg(place, F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("place.id < last")
            shared = materialize(shared.select(F.col("anchors").alias("anchor"), F.col("place.id").alias("first"), F.xxhash64("place").alias("shard"), "n"), "shared")
            n_shared, n_anchors = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
            if not n_shared:
                break
            shared = shared.withColumn("shard", F.pmod("shard", F.lit(-(-n_shared // SHARD_ANCHORS))))
            segments = materialize(_segments(pieces, live, shared, n_anchors, width, own), "segments")
            judged = materialize(_stream(segments, width), "judged")
            found.append(judged.where("spans is not null").select("id", "mark", "spans"))
            pieces = judged.where("text is not null").select(*KEY, "text")
            pieces = pieces.repartition(max(1, -(-pieces.count() // PIECE_ROWS)))
        spans = reduce(DataFrame.unionByName, found).groupBy("id", "mark").agg(F.sort_array(F.flatten(F.collect_set("spans"))).alias("spans"))
        with lasting():
            return materialize(spans, "spans")


_WORD = re.compile(WORD)


def cut_words(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]], int]:
    """The text without the words of sorted spans and the blanks after them; the spans merged; the words removed."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    parts, end = [], 0
    for a, b in merged:
        parts.append(text[end : at[a]])
        end = at[b]
    return "".join([*parts, text[end:]]), merged, sum(b - a for a, b in merged)


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark, n_words, n_removed, spans and text of every row: the text without what documents with smaller ids have.

    Each word is removed that a window of `width` words covers which also starts in a document with a smaller id.
    Windows are judged on the input. spans are the removed words as (begin, end); the rest of the text keeps its
    white space, and a text of which nothing is removed is unchanged. mark is a hash of the text as it was.

    Null text stays null with 0 words. Rows with a null id are neither changed nor a reason for changes. Rows of one
    id don't count as repeats of each other, whatever their texts. An empty table gives no rows; further columns are
    ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    spans = repeated_spans(docs.where("id is not null"), width)

    def clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, mark, text, found in zip(frame["id"], frame["mark"], frame["text"], frame["spans"], strict=True):
                words = len(split_words(text))
                text, merged, gone = (text, [], 0) if found is None else cut_words(text, [(s["begin"], s["end"]) for s in found])
                out.append((key, mark, words, gone, [{"begin": a, "end": b} for a, b in merged], text))
            yield pd.DataFrame(out, columns=["id", "mark", "n_words", "n_removed", "spans", "text"]).astype({"id": "Int64"})

    key, n = ["id", "mark"], spans.count()
    joined = only(docs, spans, key, n).join(spans, key, "left").select(*key, "text", "spans")
    if n <= KEY_ROWS:
        rest = docs.join(F.broadcast(spans.select(*key)), key, "left_anti")
        joined = joined.unionByName(rest.withColumn("spans", F.lit(None).cast(SPANS)).select(*key, "text", "spans"))
    return joined.mapInPandas(trimmed(clean), "id long, mark long, n_words long, n_removed long, spans array<struct<begin:int,end:int>>, text string").withColumnsRenamed({"id": id_col, "text": text_col})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.array_join(kept, " "), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
g AS (SELECT h.doc_id, list(DISTINCT i) AS starts FROM h JOIN f ON h.h = f.h WHERE f.first < h.doc_id GROUP BY h.doc_id),
c AS (SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda x: generate_series(x, x + 49)))) AS gone FROM g),
k AS (SELECT d.doc_id, w, coalesce(len(gone), 0) AS n, CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(gone, j)) END AS kept
      FROM d LEFT JOIN c ON d.doc_id = c.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
