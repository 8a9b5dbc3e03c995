"""Approximate nearest neighbours by collision-counting hashing.

Every vector is projected on M random directions; each projection is kept as a
sorted array. A query opens a window around its own value in every array. In
round r all windows have the half-width that virtual rehashing gives them,
base * RATIO^r, and a vector collides with the query once per array whose window
holds it. Vectors with at least THRESHOLD * M collisions are verified by their
true distance. A query ends when the distance of its K-th id is within the round's
radius, or when every vector was verified.

The distinct pairs of id and vector are dealt out by their hash to groups of bounded
size, an id with many vectors to all of them; each group is indexed and answers all
queries with its nearest ids, which come in bounded broadcast blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

#: Projections, share of them that must collide, growth of the windows per round, bytes of a group and of a query block.
M, THRESHOLD, RATIO = 40, 0.65, 1.3
#: A window of half-width A * radius holds a vector at that distance with probability 0.75 or more per projection.
A = 1.15
GROUP_ROWS, QUERY_ROWS = 16384, 4096
K, EVERY = 10, 100


class SortedProjections:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, directions: np.ndarray):
        self.vectors = vectors
        self.ids, self.code = np.unique(ids, return_inverse=True)
        p = vectors @ directions.T
        self.n, self.m = p.shape
        order = np.argsort(p, axis=0)
        values = np.take_along_axis(p, order, axis=0)
        # the arrays one behind the other, far enough apart that one search finds a place in each
        self.apart = np.arange(self.m) * (4 * float(np.abs(p).max(initial=0)) + 1)
        self.order, self.values = order.T.ravel().astype(np.int32), (values + self.apart).T.ravel()

    def search(self, q: np.ndarray, at: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the ids found near q, the k nearest among them; q has the projections ``at``, its id ``own`` takes no part.

        An id has the distance of its nearest vector, and counts once.
        """
        n, m = self.n, self.m
        mine = self.ids == own
        k += int(mine.any())
        need = int(np.ceil(THRESHOLD * m))
        count = np.zeros(n, np.int64)
        first = np.arange(m) * n
        at = at + self.apart
        low = np.clip(np.searchsorted(self.values, at), first, first + n)
        high = low.copy()
        dist = np.full(len(self.ids), np.inf)
        checked = np.zeros(n, bool)
        # the first radius: the spread of the nearest values in the arrays
        step = max(1, min(n - 1, 2 * k))
        left, right = np.maximum(low - step, first), np.minimum(low + step, first + n - 1)
        radius = max(float(np.median(np.maximum(at - self.values[left], self.values[right] - at))) * 2, 1e-12)
        while True:
            a = np.clip(np.searchsorted(self.values, at - A * radius, "left"), first, low)
            z = np.clip(np.searchsorted(self.values, at + A * radius, "right"), high, first + n)
            size = np.r_[low - a, z - high]
            new = np.repeat(np.r_[a, high] - np.cumsum(size) + size, size) + np.arange(size.sum())
            count += np.bincount(self.order[new], minlength=n)
            low, high = a, z
            fresh = np.flatnonzero((count >= need) & ~checked)
            if len(fresh):
                checked[fresh] = True
                d = self.vectors[fresh] - q
                np.minimum.at(dist, self.code[fresh], np.sqrt((d * d).sum(axis=1)))
                dist[mine] = np.inf
            if checked.all() or (len(dist) >= k and np.partition(dist, k - 1)[k - 1] <= radius):
                break
            radius *= RATIO
        found = np.flatnonzero(np.isfinite(dist))
        return self.ids[found], dist[found]


def _clean(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part: not null, not zero, all components finite."""
    v = F.col("embedding").cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query by Euclidean distance in double precision.

    rows and queries: vec_id, embedding. A query's candidates are all rows but
    those of its own vec_id. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without vec_id; vectors of
    different lengths are never compared. Rows that repeat a vec_id and vector
    are one; ties go to the smaller vec_id. Queries without candidates give no
    rows. Extra columns are ignored.
    """
    spark = rows.sparkSession
    base = checkpoint(_clean(rows).distinct().withColumn("dim", F.size("v")))
    asked = checkpoint(_clean(queries).withColumn("dim", F.size("v")).distinct())
    n = base.count()
    groups = max(1, -(-n // GROUP_ROWS))
    dealt = base.withColumn("g", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int"))
    schema = "query_id long, vec_id long, score double"

    def search(shared) -> DataFrame:
        def run(key, table):
            dim = key[1].as_py()
            mine = [(q, np.array(v)) for q, d, v in shared.value if d == dim]
            out: list[tuple[int, int, float]] = []
            if mine:
                rng = np.random.default_rng(seed)
                directions = rng.standard_normal((M, dim))
                ids = table["vec_id"].to_numpy()
                index = SortedProjections(_matrix(table["v"], dim), ids, directions)
                at = np.array([v for _, v in mine]) @ directions.T
                for (q, v), p in zip(mine, at, strict=True):
                    found, dist = index.search(v, p, k, q)
                    best = np.lexsort((found, dist))[:k]
                    out += [(q, int(f), float(d)) for f, d in zip(found[best], dist[best], strict=True)]
            cols = list(zip(*out, strict=True)) if out else [[], [], []]
            return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "vec_id", "score"])

        return dealt.groupBy("g", "dim").applyInArrow(run, schema)

    out, block = spark.createDataFrame([], schema), []

    def answered(last: bool) -> DataFrame:
        """The block's answers; where more blocks come, one at a time is held by the executors."""
        shared = spark.sparkContext.broadcast(block)
        found = search(shared)
        if not last:
            found = checkpoint(found)
            shared.destroy()
        return out.unionByName(found)

    for r in asked.toLocalIterator():
        if len(block) >= QUERY_ROWS:
            out = answered(last=False)
            block = []
        block.append((r["vec_id"], r["dim"], r["v"]))
    if block:
        out = answered(last=True)
    best = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
