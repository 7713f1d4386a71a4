"""Exact top-k search by inner product with multi-resolution segment bounds.

Vectors are quantised to integers.  A vector has, for each of several
resolutions, the mean and the deviation of each of its segments.  With ``n``
components a segment,

    |q - x|^2  >=  sum over segments of n * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),

a bound that grows from coarse to fine.  As ``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2``
a lower bound of the distance is an upper bound of the score, so the same
pruning is exact for inner products: a candidate whose bound is below the
score of the k-th best found so far can't enter the result.  Survivors of all
resolutions are scored exactly, in integers.

Queries and candidates meet in tiles: rows of one id and vector are counted
first and searched as one, candidates are dealt to blocks by a hash of id and
vector, queries likewise, and each pair of blocks is one group of bounded size.
A tile gives the k best of each of its queries; the k best of those, each as
often as it was counted, are the result.

Defined cases: vectors that are null or empty, or hold null or non-finite
components, take no part; vectors of another length than the query's are not
candidates of it; a row of the same id as the query is the query's own row;
rows without an id take no part; ties go to the smaller id; fewer than k
candidates give all; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

K = 20
EVERY = 20
SCALE = 64
#: Segments of the resolutions, coarse to fine.
RESOLUTIONS = (8, 32)
#: Rows of a block of queries and of candidates.
QUERY_BLOCK, BLOCK = 1024, 8192
#: Queries compared at once in a tile; bounds a group's memory.
STEP = 32
#: Above this share of surviving pairs a bound is taken of all pairs at once.
DENSE = 0.02


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, dim, v)``: the vectors that take part, as integers."""
    x = F.col("embedding").cast("array<double>")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
            .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
            .select("vec_id", F.size("x").alias("dim"),
                    F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v")))


def counted(rows: DataFrame, k: int = K) -> DataFrame:
    """Each ``(vec_id, dim, v)`` once, with its ``copies``: at most ``k``, as a
    result holds no more rows."""
    return rows.groupBy("vec_id", "dim", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))


class Segments:
    """Means and deviations of the segments of vectors (rows) by resolution."""

    def __init__(self, rows: np.ndarray, resolutions: tuple[int, ...]):
        x = rows.astype(np.float64)
        self.norm = (x * x).sum(axis=1)
        self.levels = []
        for n in resolutions:
            edges = np.unique(np.linspace(0, x.shape[1], min(n, x.shape[1]) + 1).astype(int))
            width = np.diff(edges).astype(np.float64)
            mean = np.add.reduceat(x, edges[:-1], axis=1) / width
            square = np.add.reduceat(x * x, edges[:-1], axis=1) / width
            dev = np.sqrt(np.maximum(square - mean * mean, 0))
            # scaled by the root of the width, the bound is a plain distance
            self.levels.append((np.concatenate((mean, dev), axis=1) * np.sqrt(np.concatenate((width, width)))).astype(np.float32))

    def at(self, rows: np.ndarray) -> Segments:
        out = object.__new__(Segments)
        out.norm, out.levels = self.norm[rows], [x[rows] for x in self.levels]
        return out


def margin(norms: np.ndarray) -> np.ndarray:
    """More than the rounding of a bound (single precision, a few hundred
    terms), from the product of squared norms."""
    return 1e-4 * (1 + np.sqrt(norms)).astype(np.float32)


def score_bounds(q: Segments, x: Segments, level: int) -> np.ndarray:
    """Upper bounds of the inner products of the rows of ``q`` and ``x``.  The
    margin covers rounding, so that no candidate is lost to it."""
    # (|q|^2 + |x|^2 - |a - b|^2) / 2 where |a|^2 = |q|^2 and |b|^2 = |x|^2
    return q.levels[level] @ x.levels[level].T + margin(q.norm[:, None] * x.norm[None, :])


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows.  In doubles where they are exact
    there (all sums below 2**53), as those use the fast matrix product."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def pair_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of rows in pairs."""
    return np.einsum("ij,ij->i", q, x)


def tile_best(q_ids: np.ndarray, qs: np.ndarray, ids: np.ndarray, xs: np.ndarray, k: int,
              resolutions: tuple[int, ...] = RESOLUTIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query of a tile, as rows ``(query's index,
    candidate's index, score)``."""
    of_q, of_x = Segments(qs, resolutions), Segments(xs, resolutions)
    by_id = np.argsort(ids, kind="stable")
    first, last = (np.searchsorted(ids[by_id], q_ids, side) for side in ("left", "right"))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(qs), STEP):
        rows = np.arange(a, min(a + STEP, len(qs)))
        part, q = of_q.at(rows), qs[rows]
        live = np.ones((len(rows), len(xs)), bool)
        for n, r in enumerate(rows):
            live[n, by_id[first[r]:last[r]]] = False  # the query's own rows
        m = min(k, len(xs))
        full = live.sum(axis=1) >= k  # others have no score to beat
        floor = np.full(len(rows), -np.inf)
        for level in range(len(resolutions)):
            if live.mean() > DENSE:
                bound = score_bounds(part, of_x, level)
                if not level:
                    # the score to beat: the least of any k candidates, here those of the best bounds
                    bound[~live] = -np.inf
                    top = np.argpartition(bound, len(xs) - m, axis=1)[:, len(xs) - m:]
                    best = pair_scores(np.repeat(q, m, axis=0), xs[top.ravel()]).reshape(top.shape)
                    floor[full] = best.min(axis=1)[full]
                live &= bound >= floor[:, None]
            else:
                i, c = np.nonzero(live)
                own = part.levels[level][i] * of_x.levels[level][c]
                near = own.sum(axis=1) + margin(part.norm[i] * of_x.norm[c]) >= floor[i]
                live[i[~near], c[~near]] = False
        if live.mean() > DENSE:
            scores = exact_scores(q, xs)
            kth = np.where(live, scores, np.iinfo(np.int64).min)
            kth = np.partition(kth, len(xs) - m, axis=1)[:, len(xs) - m]
            live &= scores >= kth[:, None]
            i, c = np.nonzero(live)
            scores = scores[i, c]
        else:
            i, c = np.nonzero(live)
            scores = pair_scores(q[i], xs[c])
        order = np.lexsort((ids[c], -scores, i))
        i, c, scores = i[order], c[order], scores[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        keep = nth < k
        found.append((rows[i[keep]], c[keep], scores[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE,
          query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the best of all other rows for the
    rows whose id is divisible by ``every``."""
    x = written(counted(quantised(vectors, scale), k), "vectors")
    n = x.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    n_x, n_q = max(1, ceil(n["n"] / block)), max(1, ceil(n["q"] / query_block))

    def dealt(df: DataFrame, name: str, parts: int) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int"))

    def copied(df: DataFrame, name: str, parts: int) -> DataFrame:
        return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    # a repeated query row is one query; rows of one id but other vectors are queries of their own
    queries = x.where(F.col("vec_id") % every == 0).drop("copies").withColumn("qh", F.xxhash64("v"))
    queries = copied(dealt(queries, "bq", n_q), "bx", n_x)
    rows = copied(dealt(x, "bx", n_x), "bq", n_q)

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({x: pd.Series(dtype="int64") for x in ("query_id", "qh", "vec_id", "score", "copies")})
        qs, xs = (np.array(f["v"].tolist(), np.int64) for f in (q, c))
        i, at, scores = tile_best(q["vec_id"].to_numpy(), qs, c["vec_id"].to_numpy(), xs, k)
        return pd.DataFrame({"query_id": q["vec_id"].to_numpy()[i], "qh": q["qh"].to_numpy()[i], "vec_id": c["vec_id"].to_numpy()[at],
                             "score": scores, "copies": c["copies"].to_numpy()[at]})

    keys = ["dim", "bq", "bx"]
    found = queries.groupBy(keys).cogroup(rows.groupBy(keys)).applyInPandas(search, "query_id long, qh long, vec_id long, score long, copies int")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rank = F.row_number().over(Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(vectors: DataFrame) -> DataFrame:
    return top_k(vectors)


ORACLE = r"""
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM (SELECT vec_id, CAST(v AS DOUBLE[]) AS v FROM x WHERE vec_id % 20 = 0) q
  JOIN (SELECT vec_id, CAST(v AS DOUBLE[]) AS v FROM x) c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
