"""Prefix tries of conversations: containers of suffixes under trie heads, burst while too large, then swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small, table, trimmed

#: A turn's id is this many hexadecimal digits of a SHA-256; a conversation is the concatenation of its turns' ids.
ID = 32
#: Distinct suffixes that a container may hold before it bursts.
CONTAINER = 256
#: Ids that go into one piece of a list to be hashed.
PIECE = 500
NOTHING = hashlib.sha256(b"").hexdigest()
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, seq, sizes) of (conv_id, turn, role, text): the turns' ids in order, one after the other, and their texts' UTF-8 bytes.

    Turns are ordered by number (null first), those of the same number by role and id; repeated rows are repeated
    turns. Null roles and texts are empty. Rows with a null conv_id have no conversation and take no part. Only ids
    and sizes move, not texts.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct("turn", role.alias("role"), F.substring(digest, 1, ID).alias("id"), F.octet_length(text).alias("bytes"))
    by = rows.where("conv_id is not null").select(F.col("conv_id").cast("long"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return by.select("conv_id", F.array_join("t.id", "").alias("seq"), F.col("t.bytes").alias("sizes"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (seq_key, conv_id) -> (seq_key, first, ids): up to PIECE ids of a key joined by commas."""
    key, held = None, []

    def out(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["seq_key", "first", "ids"])

    for batch in batches:
        rows = []
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (k != key or len(held) == PIECE):
                rows.append((key, held[0], ",".join(map(str, held))))
                held = []
            key = k
            held.append(conv)
        if rows:
            yield out(rows)
    if held:
        yield out([(key, held[0], ",".join(map(str, held)))])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (seq_key, first) -> (seq_key, ends): the SHA-256 of a key's pieces, of which one at a time is held."""
    key, state = None, None

    def out(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["seq_key", "ends"])

    for batch in batches:
        rows = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k == key:
                state.update(b"," + ids.encode())
                continue
            if state:
                rows.append((key, state.hexdigest()))
            key, state = k, hashlib.sha256(ids.encode())
        if rows:
            yield out(rows)
    if state:
        yield out([(key, state.hexdigest())])


def _common(a: str, b: str, depth: int = 0) -> int:
    """How many leading turns two sequences share, if they share `depth`."""
    most = min(len(a), len(b)) // ID
    while depth < most and a[depth * ID : depth * ID + ID] == b[depth * ID : depth * ID + ID]:
        depth += 1
    return depth


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, depth, low, high, sizes) -> (head, reach, bytes): the depth down to which all suffixes of a head are one, and the bytes of each turn from depth to reach."""
    for batch in batches:
        rows = batch.to_pylist()
        reach = [_common(r["low"], r["high"], r["depth"]) for r in rows]
        sizes = [([0] + r["sizes"])[r["depth"] : e + 1] for r, e in zip(rows, reach, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r["head"] for r in rows]), pa.array(reach, pa.int32()), pa.array(sizes, pa.list_(pa.int64()))], ["head", "reach", "bytes"])


def sweep(depth: int, rows: list[dict]) -> list[list]:
    """The nodes of one container, whose head is at `depth`; rows (seq, sizes, n, conv, ends) are sorted by seq. The head's node comes first.

    A node is [conv, depth, its parent's position or None, members, children, leaves, saved, ends]. It is closed, and
    added to its parent, as soon as a row leaves it.
    """
    nodes: list[list] = []
    path: list[tuple[int, int]] = []  # position and last text's bytes of the open nodes

    def close(kept: int) -> None:
        while len(path) > kept:
            at, size = path.pop()
            node = nodes[at]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * size
            if path:
                above = nodes[path[-1][0]]
                above[0] = min(above[0], node[0])
                for i in (3, 5, 6):
                    above[i] += node[i]
                above[4] += 1

    last = None
    for r in rows:
        seq = r["seq"]
        shared = depth - 1 if last is None else _common(last, seq, depth)
        close(shared - depth + 1)
        for d in range(shared + 1, len(seq) // ID + 1):
            nodes.append([r["conv"], d, path[-1][0] if path else None, 0, 0, 0, 0, None])
            path.append((len(nodes) - 1, r["sizes"][d - 1] if d else 0))
        own = nodes[path[-1][0]]
        own[0], own[7] = min(own[0], r["conv"]), r["ends"]
        own[3] += r["n"]
        last = seq
    close(0)
    return nodes


SWEPT = "head string, parent string, path array<string>, top boolean, " + NODES


def _sweep_containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (head, seq) -> SWEPT; one container is held at a time. The parent of a container's top is found later."""
    schema = pa.schema([("head", pa.string()), ("parent", pa.string()), ("path", pa.list_(pa.string())), ("top", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()), *((c, pa.int64()) for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string())])
    held: list[dict] = []

    def nodes() -> list[tuple]:
        own = sweep(held[0]["depth"], held)
        first = held[0]
        return [(first["head"], first["parent"], first["path"], i == 0, conv, d, None if above is None else own[above][0], n, children, leaves, saved, ends or NOTHING) for i, (conv, d, above, n, children, leaves, saved, ends) in enumerate(own)]

    out: list[tuple] = []
    for batch in batches:
        for r in batch.to_pylist():
            if held and r["head"] != held[0]["head"]:
                out += nodes()
                held = []
            held.append(r)
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
    if held:
        out += nodes()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _distinct(seqs: DataFrame) -> DataFrame:
    """(seq, sizes, n, conv, ends): each different sequence once, with its conversations' number, smallest id and the digest of all their ids."""
    keyed = materialize(seqs.withColumn("seq_key", F.sha2("seq", 256)), "sequences")
    pieces = keyed.select("seq_key", "conv_id").repartitionByRange("seq_key", "conv_id").sortWithinPartitions("seq_key", "conv_id").mapInArrow(trimmed(_pieces), "seq_key string, first long, ids string")
    ends = pieces.repartition("seq_key").sortWithinPartitions("seq_key", "first").select("seq_key", "ids").mapInArrow(trimmed(_digests), "seq_key string, ends string")
    classes = keyed.groupBy("seq_key", "seq", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    return classes.join(ends, "seq_key").select("seq", "sizes", "n", "conv", "ends")


def prefix_trie(seqs: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes (NODES) of the trie of seqs (conv_id, seq, sizes), whose conv_id is unique.

    1. Sequences that are alike become one suffix with its number of conversations, so a conversation that everyone
       has is one row. The ids of those that end at a node are sorted in ranges and hashed piece by piece.
    2. All suffixes start in one container under the root. A container of more than `container` suffixes bursts: its
       head runs down to where the suffixes part, and the next turn's id deals them out to new containers. Each round
       handles all crowded containers at once and moves their rows only, and the rounds are as many as crowded
       branchings lie above one another.
    3. Each container left is sorted and swept once into nodes, from which every subtree's sums follow. Those of the
       burst heads add up the containers below them.

    A node's conv_id is its smallest member's, that of its parent parent_conv_id (null for the root). saved_tokens
    counts UTF-8 bytes. A conversation without turns is a member of the root. No conversations give no nodes.
    """
    rows = materialize(_distinct(seqs).select(F.sha2(F.lit(""), 256).alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("path"), "*"), "suffixes")
    calm, chains = [], []
    while True:
        crowded = materialize(rows.groupBy("head").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > container).select("head"), "crowded")
        n = crowded.count()
        calm.append(rows.join(small(crowded, n), "head", "left_anti") if n else rows)
        if not n:
            break
        bounds = rows.join(small(crowded, n), "head", "left_semi").groupBy("head", "depth").agg(F.min("seq").alias("low"), F.max("seq").alias("high"), F.first("sizes").alias("sizes"))
        reach = materialize(bounds.mapInArrow(trimmed(_reach), "head string, reach int, bytes array<long>"), "reach")
        burst = rows.join(small(reach, n), "head").withColumn("next", F.substring(F.col("seq"), F.col("reach") * ID + 1, F.lit(ID)))
        by_next = burst.groupBy("head", "depth", "parent", "path", "reach", "bytes", "next").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max(F.when(F.col("next") == "", F.col("ends"))).alias("ends"))
        chain = by_next.groupBy("head", "depth", "parent", "path", "reach", "bytes").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), F.max("ends").alias("ends"), F.count(F.when(F.col("next") != "", 1)).alias("children"))
        chains.append(materialize(chain, "heads"))
        below = F.col("reach") + 1
        rows = burst.where("next <> ''").select(F.sha2(F.substring(F.col("seq"), F.lit(1), below * ID), 256).alias("head"), below.alias("depth"), F.col("head").alias("parent"), F.array_append("path", F.col("head")).alias("path"), "seq", "sizes", "n", "conv", "ends")
        rows = materialize(rows, "suffixes")
    suffixes = reduce(DataFrame.unionByName, calm)
    swept = suffixes.repartition("head").sortWithinPartitions("head", "seq").mapInArrow(trimmed(_sweep_containers), SWEPT)
    if not chains:
        return swept.selectExpr(*[c.split()[0] for c in NODES.split(", ")])
    swept = materialize(swept, "swept")
    heads = materialize(reduce(DataFrame.unionByName, chains).withColumn("own", F.aggregate("bytes", F.lit(0).cast("long"), lambda total, x: total + x) * (F.col("n") - 1)), "heads")
    n = heads.count()
    # sums of a head's subtree: from the tops of the containers and the chains of the heads at or below it
    parts = swept.where("top").select(F.explode("path").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    parts = parts.unionByName(heads.select(F.explode("path").alias("head"), F.lit(0).cast("long").alias("leaves"), F.col("own").alias("saved")))
    sums = parts.groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    above = small(heads.select(F.col("head").alias("parent"), F.col("conv").alias("above")), n)
    steps = heads.join(small(sums, n), "head").join(above, "parent", "left").select("*", F.posexplode("bytes").alias("j", "size"))
    last = F.col("depth") + F.col("j") == F.col("reach")
    chain_bytes = F.aggregate(F.slice("bytes", F.col("j") + 1, F.size("bytes") - F.col("j")), F.lit(0).cast("long"), lambda total, x: total + x)
    inner = steps.select(
        F.col("conv").alias("conv_id"),
        (F.col("depth") + F.col("j")).cast("long").alias("depth"),
        F.when(F.col("j") == 0, F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + (F.col("n") - 1) * chain_bytes).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends")), F.lit(NOTHING)).alias("ends_sha256"),
    )
    outer = swept.join(above, "parent", "left").withColumn("parent_conv_id", F.when(F.col("top"), F.col("above")).otherwise(F.col("parent_conv_id")))
    return inner.unionByName(outer.select(*inner.columns))


def share_beginnings(seqs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """seqs with every conversation c rebuilt: the first h turns of conversation c - c % group, then c's own after its first h; h = crc32(c in decimal) % most."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    bases = seqs.select(F.col("conv_id").alias("base"), F.col("seq").alias("base_seq"), F.col("sizes").alias("base_sizes"))
    both = seqs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group}).join(bases, "base", "left")
    seq = F.concat(F.substring(F.coalesce("base_seq", F.lit("")), F.lit(1), F.col("h") * ID), F.substring(F.col("seq"), F.col("h") * ID + 1, F.length("seq")))
    sizes = F.concat(F.slice(F.coalesce("base_sizes", F.array().cast("array<int>")), F.lit(1), F.col("h")), F.slice("sizes", F.col("h") + 1, F.size("sizes")))
    return both.select("conv_id", seq.alias("seq"), sizes.alias("sizes"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(share_beginnings(materialize(sequences(table(spark, sf_dir, "conversations")), "conversations")))


_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])))"
#: Every prefix of every rebuilt conversation is spelled out as a list of turns; subtrees are sums over ancestors.
SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(t ORDER BY k) AS t FROM turns GROUP BY conv_id),
h AS (SELECT conv_id, t, {_CRC} % 9 AS h FROM own, crc),
rebuilt AS (SELECT h.conv_id, list_concat(coalesce(b.t, [])[1:h], h.t[h + 1:]) AS t FROM h LEFT JOIN own AS b ON b.conv_id = h.conv_id - h.conv_id % 5),
prefixes AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt),
spelled AS (SELECT conv_id, depth, sha256(CAST(t[1:depth] AS VARCHAR)) AS node, sha256(CAST(t[1:depth - 1] AS VARCHAR)) AS above, CASE WHEN depth > 0 THEN octet_length(encode(t[depth].text)) ELSE 0 END AS size, depth = len(t) AS last FROM prefixes),
nodes AS (SELECT depth, node, CASE WHEN depth > 0 THEN any_value(above) END AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM spelled GROUP BY depth, node),
children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
marked AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)),
pairs AS (SELECT DISTINCT a.depth, a.node, b.depth AS low_depth, b.node AS low FROM spelled AS a JOIN spelled AS b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (SELECT p.depth, p.node, count(*) FILTER (m.n_children = 0) AS n_leaves, sum(m.own) AS saved_tokens FROM pairs AS p JOIN marked AS m ON m.depth = p.low_depth AND m.node = p.low GROUP BY ALL)
SELECT m.conv_id, m.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
FROM marked AS m JOIN sums USING (depth, node) LEFT JOIN nodes AS u ON u.depth = m.depth - 1 AND u.node = m.above
"""
