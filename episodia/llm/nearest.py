"""Approximate nearest neighbours by collision counting over query-centred windows."""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .vectors import clean_vectors, first_k, search_blocks

#: Queries whose window ends are held at once.
BATCH = 1024


@dataclass(frozen=True)
class CollisionIndex:
    """Sorted arrays of a block's rows along random lines, in orthonormal sets.

    A row collides with a query on a line if their projections differ by at most the window's half width. A row that
    collides on at least the share `threshold` of the lines is verified: its exact distance is computed.

    Windows are widened in the steps of `widths` (virtual rehashing: only the arrays' newly covered ends are read),
    which are shares of the half width that the query's threshold asks for. A half width suits a distance if a row
    that far away collides on enough lines with `margin` standard deviations to spare. The search of a block ends when
    the windows suit the k-th best distance so far; those of the last step suit the query's threshold.
    """

    lines: int = 128
    threshold: float = 0.7
    margin: float = 1.5
    widths: tuple[float, ...] = (0.8, 0.87, 0.94, 1.0)
    seed: int = 20240

    def directions(self, dim: int) -> np.ndarray:
        """dim x lines: columns of random orthonormal bases, scaled so that a unit vector's projections have variance 1."""
        rng = np.random.default_rng(self.seed)
        bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-self.lines // dim))]
        return np.concatenate(bases, axis=1)[:, : self.lines] * np.sqrt(dim)

    def half_width(self) -> float:
        """The half width that suits distance 1."""
        p = np.linspace(0.001, 0.999, 5000)
        enough = p - self.margin * np.sqrt(p * (1 - p) / self.lines) >= self.threshold
        return NormalDist().inv_cdf((1 + float(p[enough][0])) / 2)

    def search(self, ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, thresholds: np.ndarray, k: int, verified: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query the row numbers and distances of up to k rows within its threshold. verified gets the number of distances computed for each."""
        directions = self.directions(rows.shape[1])
        projected = (rows @ directions).T
        order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        arrays = np.take_along_axis(projected, order, axis=1)
        unit, out = self.half_width(), []
        slack = 1e-9 * (1 + np.abs(arrays).max(initial=0))
        for a in range(0, len(query_ids), BATCH):
            centres, half = queries[a : a + BATCH] @ directions, unit * thresholds[a : a + BATCH]
            half[~np.isfinite(half)] = 1e300
            low, high = (
                np.stack([[np.searchsorted(x, centres[:, j] + sign * (w * half + slack), side) for j, x in enumerate(arrays)] for w in self.widths]).transpose(2, 0, 1)
                for sign, side in ((-1, "left"), (1, "right"))
            )
            for i, own in enumerate(query_ids[a : a + BATCH]):
                at, distances, work = self._one(ids, rows, own, queries[a + i], thresholds[a + i], order, low[i], high[i], k)
                out.append((at, distances))
                if verified is not None:
                    verified.append(work)
        return out

    def _one(self, ids: np.ndarray, rows: np.ndarray, own: int, query: np.ndarray, limit: float, order: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        n, done = len(ids), ids == own
        found, distances, work = np.empty(0, np.int64), np.empty(0), 0
        counts = None
        for step, width in enumerate(self.widths):
            lo, hi = low[step].tolist(), high[step].tolist()
            if counts is None:  # the first windows are read from their shorter side: what lies outside
                ends = [part for line, x, y in zip(order, lo, hi, strict=True) for part in (line[:x], line[y:])]
                counts = len(order) - np.bincount(np.concatenate(ends), minlength=n)
            else:
                ends = [part for line, x, y, x0, y0 in zip(order, lo, hi, before[0], before[1], strict=True) for part in (line[x:x0], line[y0:y])]
                counts += np.bincount(np.concatenate(ends), minlength=n)
            before = lo, hi
            fresh = np.flatnonzero((counts >= self.threshold * len(order)) & ~done)
            done[fresh] = True
            work += len(fresh)
            far = np.sqrt(((rows[fresh] - query) ** 2).sum(axis=1))
            inside = far <= limit
            found, distances = np.concatenate([found, fresh[inside]]), np.concatenate([distances, far[inside]])
            best = first_k(ids[found], distances, k)
            found, distances = found[best], distances[best]
            if len(found) == k and distances[-1] <= width * limit:
                break
        return found, distances, work


def distances(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Euclidean distances by matrix product, exact enough for a first threshold once the rounding's bound is added."""
    square = (queries**2).sum(axis=1)[:, None] + (rows**2).sum(axis=1) - 2 * queries @ rows.T
    return np.sqrt(np.maximum(square, 0) + 1e-12 * (queries**2).sum(axis=1)[:, None])


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, index: CollisionIndex | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: about the k nearest rows (Euclidean) to each row whose id is divisible by `every`.

    All rows are indexed and all but the query's own are candidates. Vectors that are null, empty, zero, or hold null,
    NaN or infinity take no part; rows of one id count once (the smallest vector); vectors of other lengths than the
    query's are no candidates; ties go to the smaller id; an empty table gives no rows; further columns are ignored.
    Fewer than k candidates are all returned. Scores are exact.
    """
    return search_blocks(clean_vectors(vectors, id_col, vector_col, nonzero=True), every, k, (index or CollisionIndex()).search, distances, "double", ascending=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
