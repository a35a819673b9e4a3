"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy."""

from __future__ import annotations

import pickle
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import hash_below, materialize, narrow, table, trimmed

STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words convolved at once; longer texts are read in overlapping parts.
PART = 50_000
#: Words pooled at once.
POOLED = 10_000
#: Words whose vectors a task keeps.
CACHE_WORDS = 100_000
#: Buckets of scores from 0 to 1, for the thresholds.
BUCKETS = 4096


def subwords(word: str, buckets: int) -> list[int]:
    """Buckets of the word without outer punctuation and of its 4-, 6- and 8-grams, its ends marked; 0 is kept for padding."""
    s = f"<{word.strip(STRIP)}>"
    parts = [s, *[s[i : i + n] for n in (4, 6, 8) for i in range(len(s) - n + 1)]]
    return [1 + zlib.crc32(p.encode("utf-8", "replace")) % (buckets - 1) for p in parts]


def lower_words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def flatten(lists: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers, where each list begins, and the end)."""
    numbers, sizes = array("i"), array("q", [0])
    for own in lists:
        numbers.extend(own)
        sizes.append(len(own))
    return np.frombuffer(numbers, np.int32), np.cumsum(np.frombuffer(sizes, np.int64))


def pool_words(embedding: np.ndarray, numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The vector of each word: the sum of its subwords' embeddings over the root of their number."""
    return np.add.reduceat(embedding[numbers], begins[:-1], axis=0) / np.sqrt(np.diff(begins))[:, None].astype(np.float32)


def own_responses(h: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """h, the responses at all places of texts in a row, without those of windows that reach into the next text; ends are the texts' ends."""
    for back in range(1, width):
        h[ends - back] = -np.inf
    return h


@dataclass
class TextCNN:
    """Hashed (sub)word embeddings, filters over several numbers of words, the largest response of each filter, and a logistic output."""

    buckets: int = 1 << 16
    dims: int = 16
    filters: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    steps: int = 450
    batch: int = 32
    rate: float = 0.3
    seed: int = 5
    #: By language, for decide(); None has the threshold of all others.
    thresholds: dict = field(default_factory=lambda: {None: 0.5})

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        self.embedding = rng.normal(0, 0.05, (self.buckets, self.dims)).astype(np.float32)
        self.kernels = [rng.normal(0, 1 / np.sqrt(w * self.dims), (w, self.dims, self.filters)).astype(np.float32) for w in self.widths]
        self.out = rng.normal(0, 0.1, len(self.widths) * self.filters).astype(np.float32)
        self.scale, self.shift = np.float32(1), np.float32(0)

    def fit(self, rows: list[np.ndarray], numbers: np.ndarray, begins: np.ndarray, labels: np.ndarray) -> TextCNN:
        """AdaGrad on the log loss; only each filter's best position gets a gradient. Half of every batch is of label 1.

        rows holds each text's words as numbers from 1; the buckets of word i are numbers[begins[i] : begins[i + 1]].
        """
        rng = np.random.default_rng(self.seed + 1)
        seen = [np.full_like(self.embedding, 1e-3), *[np.full_like(k, 1e-3) for k in self.kernels], np.full_like(self.out, 1e-3)]
        widest = max(self.widths)

        def parts_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes = begins[words + 1] - begins[words]
            ends = np.cumsum(sizes)
            return numbers[np.arange(ends[-1]) + np.repeat(begins[words] - (ends - sizes), sizes)], np.append(0, ends)

        kinds = [np.flatnonzero(labels == k) for k in (0, 1)]
        for _ in range(self.steps):
            chosen = np.concatenate([rng.choice(own, self.batch // 2) for own in kinds])
            ids = [np.concatenate([rows[i], np.zeros(widest, np.int32)]) for i in chosen]
            ends = np.cumsum([0, *map(len, ids)])
            n = ends[-1]
            words, flat = np.unique(np.concatenate([*ids, np.zeros(widest, np.int32)]), return_inverse=True)
            vectors = pool_words(self.embedding, *parts_of(words))
            vectors[words == 0] = 0
            x = vectors[flat]
            pooled, places = [], []
            for w, kernel in zip(self.widths, self.kernels, strict=True):
                h = own_responses(sum(x[j : j + n] @ kernel[j] for j in range(w)), ends[1:], w)
                place = np.stack([h[a:b].argmax(axis=0) + a for a, b in zip(ends[:-1], ends[1:], strict=True)])
                places.append(place)
                pooled.append(np.take_along_axis(h, place, axis=0))
            z = np.concatenate(pooled, axis=1)
            top = np.maximum(z, 0)
            y = labels[chosen].astype(np.float32)
            p = 1 / (1 + np.exp(-(top @ self.out + self.shift)))
            error = (p - y) / len(chosen)
            inner = error[:, None] * self.out * (z > 0)
            change = top.T @ error
            seen[-1] += change**2
            self.shift -= np.float32(self.rate * error.sum())
            to_words = np.zeros((len(words), self.dims), np.float32)
            for k, (w, kernel) in enumerate(zip(self.widths, self.kernels, strict=True)):
                g = inner[:, k * self.filters : (k + 1) * self.filters]
                spots = places[k][..., None] + np.arange(w)  # document, filter, word
                step = np.einsum("bf,bfwd->wdf", g, x[spots])
                np.add.at(to_words, flat[spots].reshape(-1), np.einsum("bf,wdf->bfwd", g, kernel).reshape(-1, self.dims))
                seen[1 + k] += step**2
                kernel -= self.rate * step / np.sqrt(seen[1 + k])
            self.out -= self.rate * change / np.sqrt(seen[-1])
            moved = np.flatnonzero((np.abs(to_words).max(axis=1) > 1e-5) & (words > 0))
            if len(moved):
                parts, own = parts_of(words[moved])
                buckets, inverse = np.unique(parts, return_inverse=True)
                each = np.repeat(to_words[moved] / np.sqrt(np.diff(own))[:, None].astype(np.float32), np.diff(own), axis=0)
                total = np.stack([np.bincount(inverse, each[:, d], len(buckets)) for d in range(self.dims)], axis=1).astype(np.float32)
                seen[0][buckets] += total**2
                self.embedding[buckets] -= self.rate * total / np.sqrt(seen[0][buckets])
        return self

    def calibrate(self, scores: np.ndarray, labels: np.ndarray) -> TextCNN:
        """Fit scores to probabilities on documents that fit() has not seen.

        Half of what fit() sees has label 1; the scale and shift of the raw output with the
        least log loss set that right.
        """
        raw = np.log(np.maximum(scores, 1e-12) / np.maximum(1 - scores, 1e-12))
        sign = np.where(labels > 0, -1.0, 1.0)
        tried = [(np.logaddexp(0, sign * (a * raw + b)).mean(), a, b) for a in np.geomspace(0.2, 2, 11) for b in np.linspace(-5, 2, 29)]
        _, a, b = min(tried)
        self.scale, self.shift = np.float32(a), np.float32(a * self.shift + b)
        return self


def best_threshold(buckets: np.ndarray, n: np.ndarray, bad: np.ndarray) -> float:
    """The threshold of best F1 from the rows (n) and those of label 1 (bad) of each score bucket that has any."""
    order = np.argsort(-buckets)
    f1 = 2 * np.cumsum(bad[order]) / (np.cumsum(n[order]) + bad.sum())
    at = int(f1.argmax())
    below = buckets[order[at + 1]] + 1 if at + 1 < len(order) else 0
    return float(np.clip((buckets[order[at]] + below) / 2 / BUCKETS, 0.2, 0.8))


class Scorer:
    """Scores texts with a fitted model, keeping the vectors of the words it has met."""

    def __init__(self, model: TextCNN, cache: int = CACHE_WORDS) -> None:
        self.model, self.rows = model, {}
        self.vectors = np.zeros((cache + 2 * PART, model.dims), np.float32)  # row 0 pads

    def _look_up(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) >= len(self.vectors):
            self.rows.clear()
            new = list(dict.fromkeys(words))
        if new:
            at = len(self.rows) + 1
            self.vectors[at : at + len(new)] = pool_words(self.model.embedding, *flatten(subwords(w, self.model.buckets) for w in new))
            self.rows.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words))

    def scores_of_numbers(self, rows: list[np.ndarray], numbers: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """As scores(), of texts given as fit() takes them."""
        m = self.model
        vectors = np.zeros((len(begins) - 1, m.dims), np.float32)
        for a in range(1, len(vectors), POOLED):  # an embedding for each bucket of each word: not for all at once
            own = begins[a : a + POOLED + 1]
            vectors[a : a + POOLED] = pool_words(m.embedding, numbers[own[0] : own[-1]], own - own[0])
        tail = np.zeros(2 * max(m.widths), np.int32)
        best = []
        for row in rows:
            x, n = vectors[np.concatenate([row, tail])], len(row) + max(m.widths)
            best.append(np.concatenate([sum(x[j : j + n] @ k[j] for j in range(len(k))).max(axis=0) for k in m.kernels]))
        return self._logistic(np.stack(best))

    def _logistic(self, best: np.ndarray) -> np.ndarray:
        m = self.model
        return 1 / (1 + np.exp(-(m.scale * (np.maximum(best, 0) @ m.out) + m.shift).astype(np.float64).clip(-40, 40)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text; a text without words scores what no response gives."""
        m, widest = self.model, max(self.model.widths)
        best = np.full((len(texts), len(m.out)), -np.inf, np.float32)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                ids = self._look_up([w for _, part in held for w in part])
                begins = np.cumsum([0, *[len(part) + widest for _, part in held]])
                flat = np.zeros(begins[-1] + widest, np.int32)
                flat[np.concatenate([np.arange(len(part)) + a for a, (_, part) in zip(begins, held, strict=False)])] = ids
                x, n = self.vectors[flat], begins[-1]
                top = [np.maximum.reduceat(own_responses(sum(x[j : j + n] @ k[j] for j in range(len(k))), begins[1:], len(k)), begins[:-1], axis=0) for k in m.kernels]
                np.maximum.at(best, [i for i, _ in held], np.concatenate(top, axis=1))
            held.clear()
            size = 0

        for i, words in enumerate(map(lower_words, texts)):
            for a in range(0, len(words), PART):
                part = words[a : a + PART + widest]
                if size + len(part) > PART:
                    flush()
                held.append((i, part))
                size += len(part)
        flush()
        return self._logistic(best)


def crc_mod(key: Column, n: int) -> Column:
    return F.crc32(key.cast("string")) % n


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_training_rows: int = 8_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", thresholds: bool = True, max_training_words: int = 20_000_000) -> TextCNN | float:
    """A classifier fitted on a repeatable hash sample of about max_training_rows labelled documents, whole texts.

    Rows of one id and text count once, so that no repeated row fills the sample. Words are hashed where the texts are;
    one task fits the model on the sample's numbers, and the driver gets the model alone. That task holds four bytes a
    word, so that the sample is bounded by max_training_words as well: texts beyond it, in the order of their hashes,
    take no part in the fitting.

    A fifth of the sample is kept back to calibrate the scores; the thresholds by language come from all labelled
    documents that the classifier was not fitted on, see fit_thresholds(). Without `thresholds` all are 0.5. Rows of one id in labels count once,
    with the highest label; null labels don't count. Without labels of both kinds the result is the constant score:
    the share of label 1, or 0 without any.
    """
    labels = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
    labels = labels.groupBy("id").agg(F.max("label").alias("label"))
    few = narrow(labels, labels.count())
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("mark")).join(few, "id")
    share = min(1.0, max_training_rows / max(1, rows.select("mark").distinct().count()))
    sample = rows.where(hash_below(F.col("mark"), share)).dropDuplicates(["mark"]).select("id", "mark", "label", "text")
    sample = materialize(sample.mapInPandas(trimmed(_numbered), "id long, mark long, label int, words binary, fresh array<int>, parts array<binary>"), "sample")
    words = (F.octet_length("words") / 4).cast("long")
    if (sample.agg(F.sum(words)).first()[0] or 0) > max_training_words:
        sums = sample.select("mark", F.sum(words).over(Window.orderBy("mark")).alias("upto"))  # about max_training_rows rows of two numbers
        sample = sample.join(F.broadcast(sums.where(F.col("upto") <= max_training_words).select("mark")), "mark")
    kinds = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return float(max(kinds)) if kinds else 0.0
    texts = sample.select(F.lit(0).alias("kind"), "id", "mark", "label", F.col("words").alias("numbers"))
    words = sample.select(F.explode(F.arrays_zip("fresh", "parts")).alias("w")).groupBy("w.fresh").agg(F.min("w.parts").alias("numbers"))
    words = words.select(F.lit(1).alias("kind"), F.col("fresh").cast("long").alias("id"), F.lit(0).cast("long").alias("mark"), F.lit(0).alias("label"), "numbers")
    fitted = texts.unionByName(words).repartition(1).mapInArrow(trimmed(_train), "model binary, marks binary").first()  # about max_training_rows texts
    model = pickle.loads(fitted.model)
    if not thresholds:
        return model
    marks = [(m,) for m in np.frombuffer(fitted.marks, np.int64).tolist()]
    fitted = F.broadcast(docs.sparkSession.createDataFrame(marks, "mark long"))  # a part of the sample
    return fit_thresholds(model, rows.join(fitted, "mark", "left_anti"))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the model fitted on all texts, and the marks of those that were not kept back.

    Rows of kind 0 are texts as hashes of their words, those of kind 1 are words (id) and their buckets.
    """
    rows = pa.Table.from_batches(list(batches))
    kind = rows["kind"].to_numpy()
    words, rows = rows.filter(kind == 1), rows.filter(kind == 0)
    words = words.take(np.argsort(words["id"].to_numpy()))
    known = words["id"].to_numpy().astype(np.int32)
    parts, ends = _binary_numbers(words["numbers"], np.uint16)
    numbers, begins = np.concatenate([np.zeros(1, np.uint16), parts]), np.append(0, ends + 1)
    rows = rows.take(np.lexsort((rows["mark"].to_numpy(), rows["id"].to_numpy())))
    y, marks = rows["label"].to_numpy().astype(np.int64), rows["mark"].to_numpy().copy()
    flat, ends = _binary_numbers(rows["numbers"], np.int32)
    del words, rows, parts
    texts = [(np.searchsorted(known, flat[a:b]) + 1).astype(np.int32) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    kept_back = np.arange(len(texts)) % 5 == 0
    if min(len(set(y[b].tolist())) for b in (kept_back, ~kept_back)) < 2:  # too few to keep any back
        kept_back[:] = False
    model = TextCNN().fit([t for t, b in zip(texts, kept_back, strict=True) if not b], numbers, begins, y[~kept_back])
    if kept_back.any():
        model.calibrate(Scorer(model, cache=0).scores_of_numbers([t for t, b in zip(texts, kept_back, strict=True) if b], numbers, begins), y[kept_back])
    yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)], "marks": [marks[~kept_back].tobytes()]})


def _binary_numbers(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all values of a binary column in a row, and where each value's begin and the last one's end."""
    width = np.dtype(kind).itemsize
    ends = np.cumsum(np.append(0, pc.binary_length(column).to_numpy() // width))
    numbers = np.empty(ends[-1], kind)
    at = 0
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int64 if pa.types.is_large_binary(chunk.type) else np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        if len(chunk) and offsets[-1] > offsets[0]:
            own = np.frombuffer(chunk.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(kind)
            numbers[at : at + len(own)] = own
            at += len(own)
    return numbers, ends


def _numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as 32-bit hashes of their words, and the buckets, 16 bits each, of every word that the task has not shown before."""
    seen: set[str] = set()
    for frame in frames:
        words, fresh, parts = [], [], []
        for text in frame.pop("text"):
            own = lower_words(text)
            new = [w for w in dict.fromkeys(own) if w not in seen]
            seen.update(new)
            words.append(np.array([word_number(w) for w in own], np.int32).tobytes())
            fresh.append([word_number(w) for w in new])
            parts.append([np.array(subwords(w, TextCNN.buckets), np.uint16).tobytes() for w in new])
        yield frame.assign(words=words, fresh=fresh, parts=parts)


def word_number(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) - (1 << 31)


def fit_thresholds(model: TextCNN, labelled: DataFrame, least: int = 30) -> TextCNN:
    """Sets the thresholds of best F1 from all rows of labelled (lang, text, label), which the model was not fitted on.

    A language with `least` rows of label 1 gets its own; one with fewer, and null and empty languages, get the
    threshold of all rows together, which is 0.5 if they have fewer than `least` as well. Scores are counted in BUCKETS
    buckets by language; the driver sees those counts alone.
    """
    bucket = F.least(F.floor(F.col("toxic_score") * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    scored = score_toxicity(labelled, model).select(F.coalesce("lang", F.lit("")).alias("lang"), bucket.alias("bucket"), "label")
    counts = materialize(scored.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")), "scores")
    often = counts.where("lang <> ''").groupBy("lang").agg(F.sum("bad").alias("all")).where(F.col("all") >= least).select("lang")
    by: dict[str | None, list] = {}
    for r in counts.join(often, "lang").select("lang", "bucket", "n", "bad").collect():
        by.setdefault(r.lang, []).append(r[1:])
    common = [tuple(r) for r in counts.groupBy("bucket").agg(F.sum("n"), F.sum("bad")).collect()]
    if sum(r[2] for r in common) >= least:
        by[None] = common
    model.thresholds = {None: 0.5} | {name: best_threshold(*np.array(own, np.int64).T) for name, own in by.items()}
    return model


def score_toxicity(docs: DataFrame, model: TextCNN | float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All columns of docs plus toxic_score, toxic_threshold (the language's) and is_toxic.

    Scores depend on the text alone. Null and empty texts get the score of a text without words; unknown and null
    languages the common threshold. Existing columns of the three names are replaced; an empty table gives no rows.
    """
    plain = docs.drop("toxic_score", "toxic_threshold", "is_toxic")
    if isinstance(model, float):
        scored, thresholds = plain.withColumn("toxic_score", F.lit(model)), {None: 0.5}
    else:
        shared, thresholds = docs.sparkSession.sparkContext.broadcast(model), model.thresholds

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shared.value)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                yield batch.append_column("toxic_score", pa.array(scorer.scores(texts)))

        scored = plain.mapInArrow(trimmed(score), StructType([*plain.schema.fields, StructField("toxic_score", DoubleType())]))
    threshold = F.lit(thresholds[None])
    for name, value in sorted((k, v) for k, v in thresholds.items() if k):
        threshold = F.when(F.col(lang_col) == name, value).otherwise(threshold)
    return scored.withColumn("toxic_threshold", threshold).withColumn("is_toxic", F.col("toxic_score") >= F.col("toxic_threshold"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    scored = score_toxicity(docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")), fit_toxicity(docs, labels, thresholds=False))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))
