"""Exact top-k inner products by MaxScore over signed postings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .vectors import clean_vectors, first_k, search_blocks


def maxscore(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, k: int, read: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Up to k rows of a block with the largest inner product for each query, none below its threshold; all numbers are integers.

    thresholds holds the negated score that a row must reach, infinity for none. read gets the number of postings
    traversed and components probed for each query.

    Each dimension has a posting list of (row, value) for either sign. A query's terms are its non-zero components. A
    term adds at most its bound, the largest product in the list of the query's own sign; the other list only lowers
    scores. What the terms from some place on can add is the sum of their bounds, or the product of the query's norm in
    those terms and the row's norm, if that is less. In order of falling bounds, the first terms are essential: as many
    as it takes until the others together stay below the threshold, so that a row in none of the essential lists of
    the query's sign cannot reach it. Their lists are traversed, scores are summed up by row, and the rows found are
    probed in the other terms while their score plus what is left is competitive. Ties at the threshold stay in.
    """
    n, dims = rows.shape
    columns = np.ascontiguousarray(rows.astype(np.int64).T)
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    lists = {(d, s): np.flatnonzero(columns[d] * s > 0) for d in range(dims) for s in (1, -1)}
    postings = {(d, s): (at, columns[d][at]) for (d, s), at in lists.items()}
    most = {(d, s): int((values * s).max(initial=0)) for (d, s), (_, values) in postings.items()}
    out = []
    for own, query, limit in zip(query_ids, queries.astype(np.int64), thresholds, strict=True):
        sign = np.sign(query).tolist()
        weights = query.tolist()
        bound = [most[d, s] * abs(w) if s else 0 for d, (s, w) in enumerate(zip(sign, weights, strict=True))]
        terms = sorted((d for d in range(dims) if sign[d]), key=lambda d: -bound[d])
        lists_left = np.append(np.cumsum([bound[d] for d in terms][::-1])[::-1], 0)
        norm_left = np.append(np.sqrt(np.cumsum([float(weights[d]) ** 2 for d in terms][::-1]))[::-1], 0.0) * (1 + 1e-9)
        left = lambda i, norm: np.minimum(lists_left[i], norm_left[i] * norm)
        score, seen, work = np.zeros(n, np.int64), np.zeros(n, bool), 0
        threshold = -limit if np.isfinite(limit) else None
        # a threshold of 0 and less is in reach of rows that no list holds, so all terms are traversed for all rows
        everything = threshold is None or threshold <= 0
        upto = len(terms) if everything else int(np.argmax(left(np.arange(len(terms) + 1), norms.max(initial=0)) < threshold))
        for d in terms[:upto]:
            at, values = postings[d, sign[d]]
            score[at] += values * weights[d]
            seen[at] = True
            against, others = postings[d, -sign[d]]
            score[against] += others * weights[d]
            work += len(at) + len(against)
        seen |= everything
        seen &= ids != own
        rows_left = np.flatnonzero(seen if threshold is None else seen & (score + left(upto, norms) >= threshold))
        score, norm = score[rows_left], norms[rows_left]
        for i in range(upto, len(terms)):
            score = score + columns[terms[i]][rows_left] * weights[terms[i]]
            work += len(rows_left)
            keep = score + left(i + 1, norm) >= threshold
            rows_left, score, norm = rows_left[keep], score[keep], norm[keep]
        best = first_k(ids[rows_left], -score, k)
        out.append((rows_left[best], score[best]))
        if read is not None:
            read.append(work)
    return out


def negated_products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """For a first threshold; whole numbers, so the rounding of very large ones is made up for by a step of 1."""
    return 1.0 - queries @ rows.T


def top_products(vectors: DataFrame, every: int, k: int, scale: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: exactly the k largest integer inner products with each row whose id is divisible by `every`.

    With scale, components become floor(scale * x), in double precision; else they must be whole already. All rows but
    the query's own are candidates. Vectors that are null, empty, or hold null, NaN or infinity take no part; zero
    vectors do; rows of one id count once (the smallest vector); vectors of other lengths are no candidates; ties go
    to the smaller id; an empty table gives no rows; further columns are ignored.
    """
    clean = clean_vectors(vectors, id_col, vector_col, nonzero=False)
    if scale is not None:
        clean = clean.withColumn("vec", F.transform("vec", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))
    return search_blocks(clean, every, k, maxscore, negated_products, "long", ascending=False)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


SQL = """
WITH v AS (SELECT vec_id, list_transform(min(embedding), lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.vec, c.vec), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""
