"""Conversation tries against a dictionary of all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from episodia.llm import tries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, head string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + own[c][h[c] :] for c in own}


def plain_trie(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    children = {node: sum(len(x) == len(node) + 1 for x in below[node]) for node in members}
    size = lambda node: len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            m[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(m),
            children[node],
            sum(children[x] == 0 for x in below[node]),
            sum((len(members[x]) - 1) * size(x) for x in below[node]),
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def got(df):
    return sorted(map(tuple, df.selectExpr(*[c.split()[0] for c in tries.NODES.split(", ")]).collect()), key=lambda r: r)


def key(rows):
    return sorted(rows, key=lambda r: [x if x is not None else -1 for x in r])


ROWS = [(c, t, "user" if t % 2 == 0 else "assistant", f"café {c % 3 if t > 4 else 0} {t}" if t < 7 else "ü" * (c % 4), 1, "x") for c in range(60) for t in range(c % 9)]
ROWS += [(100 + c, t, "user", f"turn {t}", 1, "x") for c in range(40) for t in range(12)]  # copies
ROWS += [(200 + c, t, "user", f"turn {t}" if t < 9 else f"{c}", 1, "x") for c in range(40) for t in range(11)]  # a long common beginning
ROWS += [(300, None, None, None, 1, None), (300, 0, "user", None, 1, None), (300, 0, "user", None, 1, None), (301, 3, None, "x", 1, None), (None, 0, "user", "lost", 1, None), (-7, 0, "user", "n", 1, None)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("container", [1, 3, 20, 1000])
def test_tries_match_all_prefixes(rows, container):
    seqs = tries.share_beginnings(tries.sequences(rows))
    assert key(got(tries.prefix_trie(seqs, container))) == key(plain_trie(rebuilt(ROWS)))


def test_trie_of_none_and_of_turnless(spark, rows):
    assert tries.prefix_trie(tries.sequences(rows.limit(0))).count() == 0
    seqs = spark.createDataFrame([(4, "", []), (2, "", [])], "conv_id long, seq string, sizes array<int>")
    assert got(tries.prefix_trie(seqs)) == [(2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,4").hexdigest())]


def test_many_copies_hash_in_pieces(spark):
    n = 3 * tries.PIECE + 7
    seqs = spark.range(n).selectExpr("id AS conv_id", f"repeat('a', {tries.ID}) AS seq", "array(5) AS sizes")
    want = hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert got(tries.prefix_trie(seqs))[1] == (0, 1, 0, n, 0, 1, 5 * (n - 1), want)
