"""Near-duplicates: MinHash signatures, an LSH forest for candidates, exact confirmation, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, lasting, materialize, scratch, small, table, trimmed
from .graph import components
from .words import mix, shingle_set, word_hashes

#: Shingles hashed at once, so that very long texts need no more memory.
CHUNK = 4096
#: Rows of a sorted order in one task.
ORDER_ROWS = 32_000
#: Rows on either side of a cell of a large region's comparison.
CELL_ROWS = 512
#: Elements of sets compared at once in a cell.
COLUMNS = 4096
PAIR, EDGE = ("low", "high", "same"), ("edge", "tree", "key_a", "key_b", "id", "sketch")


@dataclass(frozen=True)
class Forest:
    """The forest's shape. Every tree orders the signatures by `depth` hashes of its own choice.

    A region is a run of signatures in a tree's order with a common prefix. From `least` common hashes on, a region of
    up to `region` signatures gives all its pairs; a larger one pairs each signature with its smallest member, with its
    hub (the sketch that agrees most with the region's most frequent values) and with the most similar sketches, `best`
    of them, of the `near` neighbours on either side, and is looked at again one hash deeper. What of a large region
    that leaves in different components is compared in full afterwards, by _dense(), in the regions of the first
    `dense_trees` trees: a pair of similarity 0.8 shares one of them with probability 0.999. Pairs whose sketches agree
    on less than `agree` of the hashes are left out: at similarity 0.8 that is 4 standard deviations below the mean. The
    full comparison sends sketches first, and sets only of rows that agree with another component's on `sift` of the
    hashes, which is 6 deviations below it.
    """

    hashes: int = 64
    trees: int = 32
    depth: int = 8
    least: int = 3
    region: int = 48
    near: int = 64
    best: int = 2
    dense_trees: int = 10
    agree: float = 0.6
    sift: float = 0.5
    seed: int = 77
    orders: np.ndarray = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        object.__setattr__(self, "orders", np.stack([rng.permutation(self.hashes)[: self.depth] for _ in range(self.trees)]))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed + 1)
        factors = rng.integers(1, 2**63, self.hashes, np.uint64) * np.uint64(2) + np.uint64(1)
        shifts = rng.integers(0, 2**63, self.hashes, np.uint64)
        low = np.full(self.hashes, np.iinfo(np.uint64).max)
        for i in range(0, len(shingles), CHUNK):
            low = np.minimum(low, (shingles[i : i + CHUNK, None] * factors + shifts).min(axis=0))
        return (low >> np.uint64(32)).astype(np.uint32)

    def _closest(self, sketches: np.ndarray, large: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row of a large region with the `best` rows of most equal hashes among its neighbours there."""
        most, who = np.full((len(run), self.best), -1, np.int16), np.zeros((len(run), self.best), np.int64)

        def offer(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> None:
            weakest = most[a].argmin(axis=1)
            better = same > most[a, weakest]
            a, weakest = a[better], weakest[better]
            most[a, weakest], who[a, weakest] = same[better], b[better]

        for step in range(1, min(self.near, len(run) - 1) + 1):
            a = np.flatnonzero(large[:-step] & (run[:-step] == run[step:]))
            if not len(a):
                break
            same = (sketches[a] == sketches[a + step]).sum(axis=1).astype(np.int16)
            offer(a, a + step, same)
            offer(a + step, a, same)
        found = np.nonzero(most >= 0)
        return found[0], who[found]

    def _hubs(self, sketches: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each run the row that agrees most with the run's most frequent value of every hash; only for large runs."""
        hubs = begins.copy()
        offsets = 256 * np.arange(self.hashes)
        for i in np.flatnonzero(sizes > self.region):
            own = sketches[begins[i] : begins[i] + sizes[i]]
            counts = np.zeros(256 * self.hashes, np.int64)
            for at in range(0, len(own), CHUNK):
                counts += np.bincount((own[at : at + CHUNK] + offsets).ravel(), minlength=256 * self.hashes)
            hubs[i] += int((own == counts.reshape(self.hashes, 256).argmax(axis=1)).sum(axis=1).argmax())
        return hubs

    def pairs(self, tree: np.ndarray, keys: np.ndarray, ids: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Candidate pairs (low id, high id, equal hashes) of rows sorted by tree and keys (rows x depth)."""
        n = len(ids)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit(a: np.ndarray, b: np.ndarray) -> None:
            for i in range(0, len(a), 50_000):
                x, y = a[i : i + 50_000], b[i : i + 50_000]
                same = (sketches[x] == sketches[y]).sum(axis=1)
                keep = (same >= self.agree * self.hashes) & (ids[x] != ids[y])
                x, y = ids[x[keep]], ids[y[keep]]
                found.append((np.minimum(x, y), np.maximum(x, y), same[keep]))

        equal = (keys[1:] == keys[:-1]) & (tree[1:] == tree[:-1])[:, None]
        common = np.concatenate([[0], np.logical_and.accumulate(equal, axis=1).sum(axis=1)])  # with the row before
        rows = np.arange(n)
        active = np.ones(n, bool)
        for deep in range(self.least, self.depth + 1):
            begins = np.flatnonzero(common < deep)
            sizes = np.diff(np.append(begins, n))
            run = np.repeat(np.arange(len(begins)), sizes)
            own = np.repeat(sizes, sizes)
            small, large = active & (own <= self.region) & (own > 1), active & (own > self.region)
            for step in range(1, self.region):
                a = rows[:-step][small[:-step] & (run[:-step] == run[step:])] if step < n else rows[:0]
                if not len(a):
                    break
                emit(a, a + step)
            if not large.any():
                break
            if deep == self.least:
                emit(*self._closest(sketches, large, run))
            order = np.lexsort((ids, run))
            leader = np.repeat(order[begins], sizes)
            emit(leader[large], rows[large])
            hub = np.repeat(self._hubs(sketches, begins, sizes), sizes)
            emit(hub[large], rows[large])
            active = large
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (ids[:0], ids[:0], np.zeros(0, np.int64))


def _sign(docs: DataFrame, width: int, forest: Forest) -> DataFrame:
    """(id, n_shingles, set_a, set_b, signature): set_a and set_b are a 128-bit hash of the whole set."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for frame in frames:
            out = []
            for key, text in zip(frame["id"].tolist(), frame["text"].tolist(), strict=True):
                s = shingle_set(text, width, hashes.of)
                whole = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                out.append((key, len(s), whole[0], whole[1], forest.signature(s).tobytes() if len(s) else None))
            yield pd.DataFrame(out, columns=["id", "n_shingles", "set_a", "set_b", "signature"])

    return docs.where("id is not null").mapInPandas(trimmed(sign), "id long, n_shingles long, set_a long, set_b long, signature binary")


def _candidates(signed: DataFrame, forest: Forest) -> DataFrame:
    """(low, high, same): pairs of ids that are neighbours in some tree of the forest."""

    def plant(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            signatures = np.frombuffer(b"".join(frame["signature"]), np.uint32).reshape(len(frame), -1)
            sketches = signatures.astype(np.uint8)
            sketch = [row.tobytes() for row in sketches]
            for tree, order in enumerate(forest.orders):
                keys = np.ascontiguousarray((signatures[:, order] >> 8).astype(">u2")).view(">i8").astype(np.int64)
                yield pd.DataFrame({"tree": tree, "key_a": keys[:, 0], "key_b": keys[:, 1], "id": frame["id"], "sketch": sketch})

    def pairs_of(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.ascontiguousarray(rows[["key_a", "key_b"]].to_numpy().astype(">i8")).view(">u2").reshape(len(rows), -1)
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        low, high, same = forest.pairs(rows["tree"].to_numpy(), keys, rows["id"].to_numpy(), sketches)
        return pd.DataFrame({"low": low, "high": high, "same": same}).drop_duplicates()

    def neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        if rows:
            rows, here = pd.concat(rows, ignore_index=True), TaskContext.get().partitionId()
            yield pairs_of(rows).reindex(columns=[*PAIR, *EDGE])
            # a region of up to `region` rows that a partition's end cuts lies within so many rows of it on either side
            ends = pd.concat([rows.head(forest.region).assign(edge=here), rows.tail(forest.region).assign(edge=here + 1)])
            yield ends.reindex(columns=[*PAIR, *EDGE]).astype({"edge": "Int64", "tree": "Int32", "key_a": "Int64", "key_b": "Int64", "id": "Int64"})

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        return pairs_of(rows.sort_values(["tree", "key_a", "key_b", "id"], ignore_index=True).drop_duplicates(["tree", "id", "key_a", "key_b"], ignore_index=True))

    parts = max(1, -(-signed.count() * forest.trees // ORDER_ROWS))
    planted = signed.select("id", "signature").mapInPandas(trimmed(plant), "tree int, key_a long, key_b long, id long, sketch binary")
    order = ["tree", "key_a", "key_b", "id"]
    found = planted.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(trimmed(neighbours), "low long, high long, same long, edge long, tree int, key_a long, key_b long, id long, sketch binary")
    found = materialize(found, "neighbours")
    across = found.where("edge is not null").select(*EDGE).groupBy("edge").applyInPandas(stitch, "low long, high long, same long")
    return found.where("edge is null").select(*PAIR).unionByName(across).groupBy("low", "high").agg(F.max("same").alias("same"))


def _dense(signed: DataFrame, roots: DataFrame, forest: Forest, percent: int, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """(low, high, low_root, high_root): the links between different components that share a large region; None without any.

    Regions are those of `least` common hashes, counted over the whole table. In each, every row outside the region's
    most frequent component is compared with all its rows, in cells of CELL_ROWS by CELL_ROWS rows, so that a region is no
    single task. Rows of one component need no further link. Cells get sketches of fixed size at first; what is left of
    them, rows and not pairs, gets its sets and is compared again. Only links leave a cell, found on 32 bits of the
    shingles' hashes with one shingle to spare, for _confirm() to decide.
    """

    def regions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            signatures = np.frombuffer(b"".join(frame["signature"]), np.uint32).reshape(len(frame), -1)
            for tree, order in enumerate(forest.orders[: forest.dense_trees]):
                prefix = np.zeros(len(frame), np.uint64)
                for k in order[: forest.least]:
                    prefix = mix(prefix ^ (signatures[:, k] >> 8).astype(np.uint16)) + np.uint64(k)
                yield pd.DataFrame({"region": mix(prefix + np.uint64(tree)).astype(np.int64), "id": frame["id"]})

    placed = signed.select("id", "signature").mapInPandas(trimmed(regions), "region long, id long")
    large = materialize(placed.groupBy("region").count().where(F.col("count") > forest.region).select("region"), "regions")
    n_large = large.count()
    if not n_large:
        return None
    rows = placed.join(small(large, n_large), "region", "left_semi").join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    rows = materialize(rows.withColumn("root", F.coalesce("root", "id")), "dense")
    own = rows.groupBy("region", "root").count()
    own = own.groupBy("region").agg(F.sum("count").alias("n"), F.max(F.struct("count", "root")).alias("main"))
    mixed = own.where("n > main.count").select("region", F.col("main.root").alias("main"), F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("n_right"), F.ceil((F.col("n") - F.col("main.count")) / CELL_ROWS).cast("int").alias("n_left"))
    mixed = materialize(mixed, "mixed")
    rows = rows.join(small(mixed, mixed.count()), "region").withColumns({"minor": F.col("root") != F.col("main"), "hash": F.xxhash64("id")})
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = ["region", "i", "j"]
    columns = [*cell, "side", "id", "root", "minor"]

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        left = rows.where("minor").withColumn("j", every("n_right")).withColumns({"i": F.pmod("hash", "n_left").cast("int"), "side": F.lit(0)})
        right = rows.withColumn("i", every("n_left")).withColumns({"j": F.pmod("hash", "n_right").cast("int"), "side": F.lit(1)})
        return left.select(*columns, *more).unionByName(right.select(*columns, *more))

    def sift(frame: pd.DataFrame) -> pd.DataFrame:
        """The cell's rows whose sketch agrees with another root's on `sift` of the hashes."""
        is_left = (frame["side"] == 0).to_numpy()
        x, y = frame[is_left], frame[~is_left]
        kept = np.zeros(len(frame), bool)
        if len(x) and len(y):
            of_x, of_y = (np.frombuffer(b"".join(f["signature"]), np.uint32).reshape(len(f), -1) for f in (x, y))
            same = np.zeros((len(x), len(y)), np.int16)
            for k in range(of_x.shape[1]):
                same += of_x[:, k, None] == of_y[:, k]
            near = (same >= forest.sift * forest.hashes) & (x["root"].to_numpy()[:, None] != y["root"].to_numpy())
            kept[is_left], kept[~is_left] = near.any(axis=1), near.any(axis=0)
        return frame.loc[kept, columns]

    asked = materialize(rows.select("id").distinct(), "asked")
    signatures = signed.select("id", "signature").join(small(asked, asked.count()), "id", "left_semi")
    kinds = "region long, i int, j int, side int, id long, root long, minor boolean"
    sifted = dealt(rows.join(signatures, "id"), "signature").groupBy(*cell).applyInPandas(sift, kinds)
    sifted = materialize(sifted, "sifted")
    if sifted.isEmpty():
        return None
    sets = sets_of(sifted.select("id")).select("id", F.transform("shingles", lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("array<int>").alias("shingles"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        x, y = frame[frame["side"] == 0], frame[frame["side"] == 1]
        p = q = p_root = q_root = np.zeros(0, np.int64)
        if len(x) and len(y):
            x_id, y_id, x_root, y_root = (f[c].to_numpy() for c in ("id", "root") for f in (x, y))
            shared, total = shared_counts(x["shingles"].tolist(), y["shingles"].tolist())
            ok = (100 * (shared + 1) >= percent * (total - shared - 1)) & (x_root[:, None] != y_root)
            a, b = np.nonzero(ok & (~y["minor"].to_numpy() | (y_id > x_id[:, None])))
            p, q, p_root, q_root = x_id[a], y_id[b], x_root[a], y_root[b]
        swap = p > q
        pick = lambda u, v: np.where(swap, v, u)
        return pd.DataFrame({"low": pick(p, q), "high": pick(q, p), "low_root": pick(p_root, q_root), "high_root": pick(q_root, p_root)})

    links = sifted.join(sets, "id").groupBy(*cell).applyInPandas(compare, "low long, high long, low_root long, high_root long")
    return links.distinct()


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(elements in common, elements of both) of every set of x with every set of y, by products of 0-1 matrices over COLUMNS elements at once."""
    sides = []
    for own in (x, y):
        sizes = np.array([len(a) for a in own])
        sides.append((np.concatenate(own), np.repeat(np.arange(len(own)), sizes), sizes))
    (flat_x, row_x, size_x), (flat_y, row_y, size_y) = sides
    common = np.intersect1d(flat_x, flat_y)
    shared = np.zeros((len(x), len(y)), np.int64)
    at = [(np.searchsorted(common, flat), row, flat) for flat, row in ((flat_x, row_x), (flat_y, row_y))]
    at = [(k[ok], row[ok]) for k, row, flat in at for ok in [(k < len(common)) & (common[np.minimum(k, len(common) - 1)] == flat) if len(common) else np.zeros(len(k), bool)]]
    for begin in range(0, len(common), COLUMNS):
        pair = []
        for (k, row), n in zip(at, shared.shape, strict=True):
            here = (k >= begin) & (k < begin + COLUMNS)
            m = np.zeros((n, min(COLUMNS, len(common) - begin)), np.float32)
            m[row[here], k[here] - begin] = 1
            pair.append(m)
        shared += (pair[0] @ pair[1].T).astype(np.int64)
    return shared, size_x[:, None] + size_y


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("low"), F.col("shingles").alias("of_low"))
    right = sets.select(F.col("id").alias("high"), F.col("shingles").alias("of_high"))
    both = pairs.select("low", "high").join(right, "high").join(left, "low")  # pairs travel with one set, to the other
    shared = F.size(F.array_intersect("of_low", "of_high"))
    return both.select("low", "high", shared.alias("shared"), (F.size("of_low") + F.size("of_high")).alias("total")).where(F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("total") - F.col("shared"))).select("low", "high")


def _members(full: DataFrame) -> DataFrame:
    """(id, class) of rows of (id, set_a, set_b): class is the smallest id that has the same set."""
    key = ["set_a", "set_b"]
    classes = materialize(full.groupBy(*key).agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("n")).where("n > 1"), "classes")
    return join_counted(full, classes, key, full.count()).select("id", F.coalesce("class", "id").alias("class")).distinct()


def _components_of(docs: DataFrame, width: int, percent: int, forest: Forest) -> DataFrame:
    """(id, n_shingles, component_id) of docs (id, text) with an id."""
    signed = materialize(_sign(docs, width, forest), "signatures")
    full = signed.where("n_shingles > 0")
    members = materialize(_members(full.select("id", "set_a", "set_b")), "members")
    heads = members.where("id = class").select("id").distinct()
    repeated = not signed.groupBy("id").count().where("count > 1").isEmpty()
    signatures = full.join(heads, "id", "left_semi")
    signatures = signatures.dropDuplicates(["id", "set_a", "set_b"]) if repeated else signatures
    pairs = materialize(_candidates(signatures, forest), "candidates")

    def to_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = word_hashes()
        for frame in frames:
            sets = [shingle_set(t, width, hashes.of).astype(np.int64) for t in frame["text"].tolist()]
            yield pd.DataFrame({"id": frame["id"], "shingles": sets})

    def sets_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("low").alias("id")).union(pairs.select("high")) if "low" in pairs.columns else pairs
        needed = materialize(ids.distinct(), "needed")
        sets = docs.join(small(needed, needed.count()), "id", "left_semi").mapInPandas(trimmed(to_sets), "id long, shingles array<long>")
        return materialize(sets.dropDuplicates() if repeated else sets, "sets")

    def join_roots(roots: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        linked = _confirm(pairs, sets, percent).join(pairs, ["low", "high"]).select(F.least("low_root", "high_root").alias("low"), F.greatest("low_root", "high_root").alias("high"))
        above = components(linked).select(F.col("node").alias("root"), F.col("root").alias("top"))
        final = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        return final.unionByName(above.select(F.col("root").alias("node"), F.col("top").alias("root")))

    sets = sets_of(pairs)
    sure = F.least("same", F.lit(round(0.85 * forest.hashes)))
    first = pairs.groupBy("high").agg(F.max(F.struct(sure.alias("sure"), (-F.col("low")).alias("low"))).alias("best")).select((-F.col("best.low")).alias("low"), "high")
    several = members.groupBy("id").agg(F.min("class").alias("low"), F.max("class").alias("top")).where("low <> top").select("id", "low")
    several = members.join(several, "id").where("class <> low").select("low", F.col("class").alias("high"))
    roots = components(materialize(_confirm(materialize(first, "first"), sets, percent), "confirmed").unionByName(several))

    rest = pairs.select("low", "high")
    for end in ("low", "high"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        rest = rest.join(of, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
    rest = materialize(rest.where("low_root <> high_root"), "rest")
    final = join_roots(roots, rest, sets)
    dense = _dense(signatures, final, forest, percent, sets_of)
    if dense is not None:
        dense = materialize(dense, "compared")
        if not dense.isEmpty():
            final = join_roots(final, dense, sets_of(dense))

    grouped = members.groupBy("id").agg(F.min("class").alias("class")).join(final.withColumnRenamed("node", "class"), "class", "left").select("id", F.coalesce("root", "class").alias("component_id"))
    return signed.select("id", "n_shingles").join(grouped, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, forest: Forest | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept of every row.

    Documents whose sets of `width`-word shingles (lower-cased in ASCII) have a Jaccard similarity of percent / 100
    or more are linked; component_id is the smallest id reachable, and the document of that id is kept. Every link
    that counts has been confirmed on the full sets.

    1. Documents with equal sets are one class, found by a hash of the whole set. Only classes go on.
    2. The forest gives candidate pairs; pairs in dense regions are neighbours, leaders and hubs, not yet all pairs. Where
       a partition of a sorted order ends, the rows on both sides are looked at once more together.
    3. Each class's best candidate is confirmed; then all other candidates that would join two components.
    4. Dense regions that still hold several components are compared in full, and what would join two is confirmed.

    A text with fewer words than `width` is one shingle; null and empty texts have none and link with nothing. Rows
    of one id are one document with all their links. Null ids link with nothing and are kept. An empty table gives no
    rows; further columns are ignored.
    """
    forest = forest or Forest()
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with scratch(docs.sparkSession, "near_duplicates"):
        out = _components_of(docs, width, percent, forest)
        with lasting():
            out = materialize(out, "components")
    nameless = docs.where("id is null").select("id", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(nameless).select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


#: The exact links of all pairs that share a shingle, and what each document reaches by them.
SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS shingle FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s AS a JOIN s AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n AS a ON a.doc_id = x JOIN n AS b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reach),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""
