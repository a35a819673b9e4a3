"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from episodia.llm import spelling

DOCS = "doc_id long, text string, word string, n int"


def near(a, b):
    """One inserted, deleted or replaced code point, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows, least_chars=6, least=5):
    n = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= least_chars and k >= least}


def plain_groups(n, times=5):
    nears = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in nears.items() if v}
    form = {w: b if (b := best.get(w)) and n[b] >= times * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(nears[w]), n[form[w]] if form[w] else None) for w in n}


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("partitions", ["1", "7", "50"])
def test_groups_match_all_pairs(spark, partitions):
    rng = random.Random(3)
    n = {"".join(rng.choices("abé" if i % 3 else "a", k=rng.randint(1, 7))): rng.choice([1, 2, 5, 30, 400, 9000]) for i in range(600)}
    n |= {"a" * 40: 3, "a" * 41: 50, "b" + "a" * 40: 7, "z" * 3000: 5, "z" * 3001: 30, "𐐷x": 4, "𐐷": 90, "ÿ": 1}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert as_rows(spelling.variant_groups(words)) == sorted(plain_groups(n), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_counts(spark):
    rows = [(i, f"Letter letters LETTER é{'É' * 6} x{i} " + "straße straßen " * (i % 4), "w", 1) for i in range(300)]
    rows += [(None, "letter letter", "w", 1), (7, None, None, None), (8, "", "w", 1), (9, "w" * 50_000 + " " + "lettar " * 6, "w", 1), (9, "w" * 50_000, "w", 1)] + [(10, "repeated", "w", 1)] * 5
    got = {r.word: r.n for r in spelling.count_words(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == plain_counts(rows) and got["repeated"] == 5
    groups = spelling.variant_groups(spelling.count_words(spark.createDataFrame(rows, DOCS)))
    assert as_rows(groups) == sorted(plain_groups(got), key=str)


def test_no_words(spark):
    none = spelling.count_words(spark.createDataFrame([], DOCS))
    assert spelling.variant_groups(none).count() == 0
    one = spark.createDataFrame([("", 3), ("a", 4)], "word string, n long")
    assert {tuple(r) for r in spelling.variant_groups(one).collect()} == {("", None, "", 3, 0, None), ("a", None, "a", 4, 0, None)}
