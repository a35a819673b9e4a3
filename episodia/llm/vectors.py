"""What both vector searches share: clean vectors, and a query set against all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import materialize

#: search(ids, vectors, query_ids, queries, thresholds, k) -> for each query (row numbers of its best in the block, scores)
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], list[tuple[np.ndarray, np.ndarray]]]
#: scores(vectors, queries) -> about the score of every vector for every query, smaller is better
Scores = Callable[[np.ndarray, np.ndarray], np.ndarray]


def clean_vectors(df: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(id, vec, dim) of the vectors that take part: no null id, vector or component, no NaN or infinity, not empty.

    With nonzero, zero vectors take no part either. Rows with the same id count once, with the smallest vector in
    array order.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(finite)
    if nonzero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v).alias("vec")).withColumn("dim", F.size("vec"))


def _by_dim(frame: pd.DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """dim -> (ids, vectors, thresholds) of a frame of (id, vec, dim, threshold)."""
    return {int(d): (f["id"].to_numpy(), np.stack(f["vec"]).astype(np.float64), f["threshold"].to_numpy(np.float64)) for d, f in frame.groupby("dim")}


class Best:
    """The k best rows so far of every query of one dimension, and the thresholds that follow from them."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, k: int, sign: int) -> None:
        self.query_ids, self.queries, self.thresholds, self.k, self.sign = query_ids, queries, thresholds.copy(), k, sign
        self.at, self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64), None

    def add(self, ids: np.ndarray, rows: np.ndarray, search: Search) -> None:
        """Searches a block, rows in order of ids. sign is 1 if small scores are good, else -1."""
        hits = search(ids, rows, self.query_ids, self.queries, self.thresholds, self.k)
        at = np.append(self.at, np.repeat(np.arange(len(hits)), [len(rows) for rows, _ in hits]))
        found = np.append(self.ids, ids[np.concatenate([rows for rows, _ in hits])])
        scores = np.concatenate([*([] if self.scores is None else [self.scores]), *[own for _, own in hits]])
        order = np.lexsort((found, self.sign * scores, at))
        at, found, scores = at[order], found[order], scores[order]
        begins = np.searchsorted(at, np.arange(len(hits)))
        nth = np.arange(len(at)) - begins[at]
        last = nth == self.k - 1
        worst = self.sign * scores[last].astype(np.float64)
        self.thresholds[at[last]] = np.minimum(self.thresholds[at[last]], worst + 1e-9 * np.abs(worst))
        self.at, self.ids, self.scores = at[nth < self.k], found[nth < self.k], scores[nth < self.k]


def search_blocks(vectors: DataFrame, every: int, k: int, search: Search, scores: Scores, score: str, ascending: bool, block_rows: int = 8192, chunk_queries: int = 16_384, sample_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row whose id is divisible by `every`.

    1. The rows are written once, dealt out by their ids. A sample of about sample_rows rows gives each query a first
       threshold: its k-th best score there, which no answer can fall behind. Without k rows in the sample the
       threshold is infinite.
    2. Queries go in chunks of about chunk_queries, which are broadcast with their thresholds. The rows stay where
       they are: each task reads its part in blocks of at most block_rows, indexes and searches them one after the
       other, and keeps the k best of each query, which lower the threshold for its next blocks. Nothing is shuffled but
       the tasks' answers.
    3. A window keeps the k best of all tasks.

    A task thus holds one block, one chunk and its answers whatever the input's size. Ties go to the smaller id. Vectors
    are compared with vectors of their own length only.
    """
    spark = vectors.sparkSession
    is_query = F.pmod("id", F.lit(every)) == 0
    n, n_queries = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    part = lambda count, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count)).cast("int")
    blocks, chunks, samples = (max(1, -(-a // b)) for a, b in ((n, block_rows), (n_queries, chunk_queries), (n, sample_rows)))
    few = 4 * spark.sparkContext.defaultParallelism
    vectors = materialize(vectors.repartition(blocks if blocks <= few else max(few, blocks // 32), "id"), "vectors")
    sample = spark.sparkContext.broadcast(_by_dim(vectors.where(part(samples, 1) == 0).withColumn("threshold", F.lit(0.0)).toPandas()))

    def first_thresholds(frames):
        for frame in frames:
            frame["threshold"] = np.inf
            for dim, own in frame.groupby("dim"):
                ids, rows, _ = sample.value.get(int(dim), (np.empty(0, np.int64), np.empty((0, int(dim))), None))
                for a in range(0, len(own) if len(ids) > k else 0, 512):
                    some = own.iloc[a : a + 512]
                    found = scores(rows, np.stack(some["vec"]).astype(np.float64))
                    found[some["id"].to_numpy()[:, None] == ids] = np.inf
                    kth = np.partition(found, k - 1, axis=1)[:, k - 1]
                    frame.loc[some.index, "threshold"] = kth + 1e-9 * np.abs(kth)
            yield frame

    def chunk_search(asked: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def answers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = {dim: Best(*found, k, 1 if ascending else -1) for dim, found in asked.value.items()}
            for frame in frames:
                for dim, own in frame.groupby("dim"):
                    if int(dim) in best:
                        own = own.sort_values("id")
                        ids, rows = own["id"].to_numpy(), np.stack(own["vec"]).astype(np.float64)
                        for at in np.array_split(np.arange(len(ids)), -(-len(ids) // block_rows)):
                            best[int(dim)].add(ids[at], rows[at], search)
            for own in best.values():
                if len(own.at):
                    yield pd.DataFrame({"query_id": own.query_ids[own.at], "vec_id": own.ids, "score": own.scores})

        return answers

    found = []
    for chunk in range(chunks):
        queries = vectors.where(is_query & (part(chunks, 2) == chunk)).mapInPandas(first_thresholds, StructType([*vectors.schema.fields, StructField("threshold", DoubleType())]))
        answer = chunk_search(spark.sparkContext.broadcast(_by_dim(queries.toPandas())))
        hits = vectors.mapInPandas(answer, f"query_id long, vec_id long, score {score}")
        order = F.col("score").asc() if ascending else F.col("score").desc()
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
        ranked = hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(ranked if chunks == 1 else materialize(ranked, "answers"))
    return reduce(DataFrame.unionByName, found)


def first_k(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        keep = np.flatnonzero(scores <= np.partition(scores, k - 1)[k - 1])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], scores[keep]))][:k]
