"""Language identification by a blended-spectrum string kernel, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_below, table
from .toxicity import crc_mod

#: Hashed n-grams; a text is the set of those it has.
BITS = 14
GRAMS = (1, 2, 3)
#: Characters hashed at once, so that very long texts need no more memory.
PART = 200_000
UNKNOWN = "und"


@functools.cache
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def gram_presence(text: str | None) -> np.ndarray | None:
    """Which hashed letter n-grams the text has; None without a letter. Anything between letters counts as one blank."""
    if not text:
        return None
    here, any_letter = np.zeros(1 << BITS, bool), False
    for a in range(0, len(text), PART):
        codes = np.frombuffer(f" {text[max(0, a - 2) : a + PART].lower()} ".encode("utf-32-le", "replace"), np.uint32)
        alphabetic = letters()[np.minimum(codes, 0xFFFF)]
        high = np.flatnonzero(codes > 0xFFFF)
        if len(high):
            alphabetic[high] = [chr(c).isalpha() for c in codes[high].tolist()]
        any_letter |= bool(alphabetic.any())
        keep = alphabetic.copy()
        keep[1:] |= alphabetic[:-1]  # a blank only after a letter
        keep[0] = True
        codes = np.where(alphabetic, codes, np.uint32(32))[keep].astype(np.uint64)
        for n in GRAMS:
            if len(codes) >= n:
                h = sum((codes[i : len(codes) - n + 1 + i] * np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 2**64)) for i in range(n)), np.uint64(n))
                here[(h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)] = True
    return here if any_letter else None


@dataclass
class KernelModel:
    """languages, landmarks (grams x landmarks, unit columns) and their weights by language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language, score) of rows of gram presence."""
        answers = similarities(rows, self.landmarks) @ self.weights
        p = np.exp(4 * (answers - answers.max(axis=1, keepdims=True)))
        return answers.argmax(axis=1), p.max(axis=1) / p.sum(axis=1)


def similarities(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """The normalized kernel: shared grams over the root of the product of both counts."""
    x = rows.astype(np.float32)
    return (x @ landmarks) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def fit_kernel(rows: np.ndarray, labels: list[str], landmarks: int = 96, ridge: float = 1e-2) -> KernelModel:
    """One-versus-rest kernel ridge regression in the span of landmarks, which are dealt evenly over the languages."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    own = [np.flatnonzero(y == k)[: max(1, landmarks // len(languages))] for k in range(len(languages))]
    chosen = rows[np.concatenate(own)].astype(np.float32)
    columns = (chosen / np.sqrt(np.maximum(chosen.sum(axis=1, keepdims=True), 1))).T
    inner = similarities(rows[np.concatenate(own)], columns).astype(np.float64)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = similarities(rows, columns).astype(np.float64) @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    share = 1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)[y][:, None]  # every language weighs the same
    answer = np.linalg.solve((z * share).T @ z + ridge * np.eye(z.shape[1]), (z * share).T @ target)
    return KernelModel(languages, columns.astype(np.float32), (root @ answer).astype(np.float32))


def fit_languages(docs: DataFrame, max_training_rows: int = 4_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> KernelModel | None:
    """A model fitted on a repeatable hash sample of about max_training_rows documents with text and language; None without any.

    Rows of the same language and text count as one document, whatever their ids, so that no id and no text that
    repeats can fill the sample.
    """
    known = docs.select(F.xxhash64(lang_col, text_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = min(1.0, max_training_rows / max(1, known.select("id").distinct().count()))

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [gram_presence(t) for t in frame.pop("text")]
            yield frame.assign(grams=[None if g is None else np.packbits(g).tobytes() for g in found])

    rows = known.where(hash_below(F.col("id"), share)).dropDuplicates(["id"]).mapInPandas(grams, "id long, lang string, grams binary").where("grams is not null").collect()
    rows.sort(key=lambda r: (r.id, r.lang, r.grams))
    if not rows:
        return None
    bits = np.unpackbits(np.frombuffer(b"".join(r.grams for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    return fit_kernel(bits.astype(bool), [r.lang for r in rows])


def identify_languages(docs: DataFrame, model: KernelModel | None, id_col: str = "doc_id", text_col: str = "text", batch: int = 128) -> DataFrame:
    """id, lang_pred and score of every row, from the whole text alone.

    Null texts and texts without a letter are `und` with score 0, and so is every text without a model. Repeated rows
    are judged alike; null ids stay null; an empty table gives no rows; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names, scores = np.full(len(frame), UNKNOWN, object), np.zeros(len(frame))
            texts = frame["text"].tolist() if shared.value else []
            for a in range(0, len(texts), batch):
                found = [(a + i, g) for i, t in enumerate(texts[a : a + batch]) if (g := gram_presence(t)) is not None]
                if found:
                    at = [i for i, _ in found]
                    best, scores[at] = shared.value.predict(np.stack([g for _, g in found]))
                    names[at] = np.array(shared.value.languages, object)[best]
            yield pd.DataFrame({id_col: frame["id"], "lang_pred": names, "score": scores})

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(predict, f"{id_col} long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    out = identify_languages(docs, fit_languages(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
