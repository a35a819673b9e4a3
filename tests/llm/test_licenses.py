"""License scans on awkward rows, against a walk over the words, and on edited notices."""

import re

import pytest
from pyspark.sql import functions as F

from episodia.llm import licenses

DOCS = "doc_id long, text string, labels string, words int, place int"
MIT = dict(licenses.TEMPLATES[3:4])["mit"]
BSD = next(text for label, text in licenses.TEMPLATES if label == "bsd")


def plain_base(text):
    """(words, places, first, last, labels) of the phrases."""
    words = licenses.license_words(text or "")
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


ROWS = [
    (1, "The MIT license, the Mit  LICENSE; apache-license and GNU general_public.license", None, 1, 1),
    (2, "", None, 1, 1),
    (3, None, None, 1, 1),
    (4, "mit", None, 1, 1),
    (5, "mit license", None, 1, 1),
    (5, "mit license", None, 1, 1),
    (6, "é mit licenseé mit×license general public public license", None, 1, 1),
    (7, "permit license mit licenses mit 2 license", None, 1, 1),
    (8, "word " * 30_000 + "mit license " * 2_000 + "end", None, 1, 1),
    (9, "... ,,, ---", None, 1, 1),
    (None, "general public license", None, 1, 1),
    (None, "other general public license", None, 1, 1),
    (10, "general general public license license", None, 1, 1),
]


def test_base_places(spark):
    got = licenses.scan_licenses(spark.createDataFrame(ROWS, DOCS)).collect()
    rows = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str)
    assert rows == sorted(((i, *plain_base(t)) for i, t, *_ in ROWS), key=str)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


def edited(text, every, how):
    words = text.split()
    return " ".join({"drop": "", "change": "xyz", "insert": f"{w} foo bar"}[how] if i % every == 1 else w for i, w in enumerate(words))


@pytest.mark.parametrize("how", ["drop", "change", "insert"])
def test_edited_notices(spark, how):
    few, many = edited(MIT, 30, how), edited(MIT, 3, how)
    rows = [(1, f"before it {few} after"), (2, f"before it {many} after"), (3, MIT[: len(MIT) // 3]), (4, f"{BSD} and {few}"), (5, f"{MIT} {MIT}")]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[2].labels, got[3].labels, got[4].labels) == ("mit", "", "", "bsd,mit")
    assert 0.8 <= got[1].score < 1 and got[2].score == 0 and got[5].score == 1
    span = got[1].spans[0]
    assert span.start in range(0, 8) and abs(span.words - len(few.split())) < 8
    assert [s.label for s in got[5].spans] == ["mit", "mit"] and got[1].n_base == 0


def test_templates_of_ones_own(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "two three")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(docs, [("two three", "b")], [("x", "one two three four five")]).withColumn("n", F.size("spans")).collect()}
    assert (got[1].base_labels, got[1].labels, got[1].n, got[2].labels) == ("b", "b,x", 1, "b")
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, [("one two three four five six", "b")])
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, templates=[("x", "too short")])
    assert re.fullmatch("[a-z0-9 ]+", " ".join(licenses.license_words(MIT)))
