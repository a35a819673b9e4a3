"""The scores of the classifiers against plain loops over words and grams."""

import math

import numpy as np
from pyspark.sql import functions as F

from episodia.llm import language, toxicity


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")


def plain_convolution(model, text):
    """One text, one filter position at a time."""
    words = []
    for word in (text or "").lower().split():
        parts = toxicity.subwords(word, model.buckets)
        words.append(np.sum([model.embedding[p].astype(float) for p in parts], axis=0) / math.sqrt(len(parts)))
    words += [np.zeros(model.dims)] * (2 * max(model.widths))
    total, at = float(model.shift), 0
    for width, kernel in zip(model.widths, model.kernels, strict=True):
        for f in range(model.filters):
            best = max(sum(float(words[i + j] @ kernel[j, :, f].astype(float)) for j in range(width)) for i in range(len(words) - max(model.widths)))
            total += float(model.scale) * max(best, 0.0) * float(model.out[at])
            at += 1
    return 1 / (1 + math.exp(-min(max(total, -40), 40)))


def test_convolution_scores(spark):
    from ..compare import DATA

    docs = documents(spark, DATA)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{DATA}/labels.parquet"), thresholds=False)
    rows = [(r.doc_id, " ".join((r.text or "").split()[:60])) for r in docs.orderBy("doc_id").limit(197).collect()] + [(-1, ""), (-2, None), (-3, "One")]
    scored = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")), model)
    got = {r.doc_id: r.toxic_score for r in scored.collect()}
    assert len(got) == 200 and max(abs(got[i] - plain_convolution(model, t)) for i, t in rows) < 1e-5


def plain_kernel(a, b):
    """Shared grams over the root of the product of both numbers of grams."""
    return len(a & b) / math.sqrt(len(a) * len(b))


def plain_grams(text):
    """Letters and single blanks, as sets of the buckets of all runs of one to three."""
    letters, last = " ", " "
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or last != " ":
            letters += c
        last = c
    letters += "" if last == " " else " "
    found = set()
    for n in language.GRAMS:
        for i in range(len(letters) - n + 1):
            h = n
            for j in range(n):
                h += ord(letters[i + j]) * pow(0x9E3779B97F4A7C15, j + 1, 2**64)
            found.add(((h % 2**64) * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - language.BITS))
    return found


def test_kernel_scores(spark):
    from ..compare import DATA

    rows = [r for r in documents(spark, DATA).orderBy("doc_id").collect() if r.text and any(c.isalpha() for c in r.text)][:200]
    grams = [plain_grams(r.text) for r in rows]
    for r, own in zip(rows, grams, strict=True):
        assert set(np.flatnonzero(language.gram_presence(r.text)).tolist()) == own
    model = language.fit_languages(documents(spark, DATA))
    marks = [set(np.flatnonzero(column).tolist()) for column in model.landmarks.T]
    got = {r.doc_id: r for r in language.identify_languages(documents(spark, DATA), model).collect()}
    for r, own in zip(rows, grams, strict=True):
        answers = np.array([plain_kernel(own, m) for m in marks]) @ model.weights.astype(float)
        p = np.exp(4 * (answers - answers.max()))
        assert abs(got[r.doc_id].score - p.max() / p.sum()) < 1e-4
        top = np.sort(answers)[::-1]
        assert top[0] - top[1] < 1e-5 or got[r.doc_id].lang_pred == model.languages[int(answers.argmax())]


def test_few_sequences_of_all_documents(spark):
    from episodia.llm import packing

    from ..compare import DATA

    packed = packing.query(spark, DATA.replace("sf0.001", "sf0.1"))
    tokens, sequences, pieces = packed.agg(F.sum("length"), F.count_distinct("sequence_id"), F.count(F.lit(1))).first()
    assert sequences <= 1.002 * tokens / 2048 + 1 and pieces >= 10_000
