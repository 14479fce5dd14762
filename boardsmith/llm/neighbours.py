"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks by a hash of their id.  A block's index is one array of projected values per random
projection, each sorted.  A query opens a window around its own projected value in every array and widens all
windows together, radius by radius (virtual rehashing: wider windows are unions of narrower ones, nothing is
hashed again).  A vector that falls into the windows of at least ``threshold`` projections is verified: its
distance is computed in double precision.  A query is done in a block when its k-th verified distance is
within the radius, times a margin, that the windows cover, or when all vectors are verified.

Queries meet the blocks in blocks: both sides carry a block number and one task holds one block of vectors and one
of queries, whose sizes are parameters.  Local winners (k per query and block) are merged by rank.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part; vectors of
different lengths are never compared; a vector is no neighbour of a query with the same id; equal vectors are
ranked by id; fewer candidates than k give fewer rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardsmith.llm.common import prepare

PROJECTIONS = 40
THRESHOLD = 20  # of 40: a vector at the radius itself falls into 27 windows on average
GROWTH = 1.4
MARGIN = 1.0
SEED = 20_231
VECTOR_BLOCK, QUERY_BLOCK = 65_536, 32_768


class Index:
    """One block: vectors, and per projection the order of the projected values and these values, sorted."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = SEED):
        self.ids, self.vectors = ids, vectors
        self.axes = np.random.default_rng(seed).standard_normal((vectors.shape[1], projections))
        values = vectors @ self.axes
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(values, order, 0).T)
        self.order = np.ascontiguousarray(order.T.astype(np.int32))
        with np.errstate(over="ignore"):
            self.small = vectors.astype(np.float32)  # only to rule candidates out before they are verified
            self.norm = (self.small**2).sum(1)

    def start_radius(self, centre: np.ndarray, k: int) -> float:
        """Half-width at which the median window holds about k values on either side."""
        n = self.sorted.shape[1]
        widths = []
        for values, c in zip(self.sorted, centre, strict=True):
            at = int(np.searchsorted(values, c))
            near = values[max(0, at - k):min(n, at + k)]
            widths.append(np.sort(np.abs(near - c))[min(k, len(near)) - 1])
        return float(np.median(widths)) or 1e-9

    def _possible(self, new: np.ndarray, query: np.ndarray, dist: np.ndarray, k: int) -> np.ndarray:
        """The candidates that single precision can't rule out, by a margin far above its rounding."""
        with np.errstate(over="ignore", invalid="ignore"):
            low, own = query.astype(np.float32), float((query**2).sum())
            rough = self.norm[new] - 2 * (self.small[new] @ low)
            least = dist[-1] ** 2 - own if len(dist) == k else np.inf
            if len(rough) >= k:
                least = min(least, float(np.partition(rough, k - 1)[k - 1]))
            return new[~(rough > least + 1e-4 * (float(self.norm.max()) + own))]

    def search(self, query_id: int, query: np.ndarray, k: int, threshold: int, growth: float, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest verified vectors other than the query's own id."""
        n, m = len(self.ids), len(self.order)
        centre = query @ self.axes
        lo = np.array([np.searchsorted(self.sorted[j], centre[j]) for j in range(m)])
        hi = lo.copy()
        hits, done = np.zeros(n, np.int64), np.zeros(n, bool)
        ids, dist = np.zeros(0, np.int64), np.zeros(0)
        radius = self.start_radius(centre, max(k, n // 16))
        while True:
            fresh = []
            for j in range(m):
                a, b = np.searchsorted(self.sorted[j], (centre[j] - radius, np.nextafter(centre[j] + radius, np.inf)))
                fresh += [self.order[j, a:lo[j]], self.order[j, hi[j]:b]]  # what the window has grown by
                lo[j], hi[j] = min(a, lo[j]), max(b, hi[j])
            hits += np.bincount(np.concatenate(fresh), minlength=n)
            new = np.flatnonzero((hits >= threshold) & ~done)
            done[new] = True
            new = self._possible(new[self.ids[new] != query_id], query, dist, k)
            ids = np.concatenate([ids, self.ids[new]])
            dist = np.concatenate([dist, np.sqrt(((self.vectors[new] - query) ** 2).sum(1))])
            best = np.lexsort((ids, dist))[:k]
            ids, dist = ids[best], dist[best]
            if (len(dist) == k and dist[-1] <= radius * margin) or ((lo <= 0) & (hi >= n)).all():
                return ids, dist
            radius *= growth


def _local(k: int, threshold: int, growth: float, margin: float):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            index = Index(vectors["vec_id"].to_numpy(np.int64), np.stack(vectors["vec"].to_numpy()).astype(np.float64))
            for q, vec in zip(queries["query_id"].to_numpy(np.int64), queries["vec"], strict=True):
                ids, dist = index.search(q, np.asarray(vec, np.float64), k, threshold, growth, margin)
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids, "score": dist}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, dim) of the rows that take part."""
    v = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).where(finite & F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            threshold: int = THRESHOLD, growth: float = GROWTH, margin: float = MARGIN) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each distinct query id, ties to the smaller id.

    A query id that stands on several rows is searched once, by its smallest vector.
    """
    spark = candidates.sparkSession
    prepare(spark)
    v = usable(candidates, id_col, vec_col)
    q = usable(queries, id_col, vec_col).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    n_v, n_q = v.count(), q.count()
    v_blocks = max(1, -(-n_v // VECTOR_BLOCK), min(spark.sparkContext.defaultParallelism, -(-n_v // 4096)))
    q_blocks = max(1, -(-n_q // QUERY_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    v = v.withColumn("vb", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(v_blocks)).cast("int")).withColumn("qb", every(q_blocks))
    q = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn("vb", every(v_blocks))
    found = v.groupBy("dim", "vb", "qb").cogroup(q.groupBy("dim", "vb", "qb")).applyInPandas(
        _local(k, threshold, growth, margin), "query_id bigint, vec_id bigint, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
