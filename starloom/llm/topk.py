"""Exact top-k inner-product search with multi-resolution segment statistics.

A vector is cut into segments; for a segment of n components with mean m and deviation s, the
inner product of two vectors there is at most n*m*m' + n*s*s' (Cauchy-Schwarz on what is left
of the means).  Summed over the segments, this bounds the score from above, that is, its
negative as a distance from below, by a product of short vectors.  Levels go from few segments
to many: a query's best candidates by the coarse bound are scored exactly and set a threshold;
who stays under it at some level is out; survivors of the finest level are scored exactly.
Where a level leaves most pairs of a block in, as it does on vectors whose energy is spread
evenly over their components, the next step is one product for the whole block instead of one
per pair, and only what reaches a query's ``k``-th score is sorted.

Queries and candidates meet in blocks: a grid of query blocks and candidate blocks is joined
by cell, each cell keeps every query's ``k`` best, and the best of those follow by a ranking
per query.  Block sizes are fixed, so a task's memory does not depend on the table.

Components become floor(scale * x).  Arithmetic is exact (64-bit floats while sums stay
below 2**53, whole numbers of any size beyond; results saturate at 64 bits).

Defined cases: a vector that is null or empty or has a null or non-finite component takes no
part; vectors only meet vectors of their own length; ties go to the smaller vec_id; a query
with fewer candidates returns them all; a repeated candidate row counts as often as it occurs (copies
beyond the ``k``-th can't be among the ``k`` best), a repeated query row once; rows without a vec_id take no part; an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Segments per level, coarse to fine.
LEVELS = (4, 16)
#: Vectors of a block of queries and of candidates.
QUERY_BLOCK, ROW_BLOCK = 2048, 4096
#: Queries that go through the levels together.
_TOGETHER = 256
#: Above this share of a block's pairs, one product for all is cheaper than one per pair.
MOST = 0.1


def segment_stats(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of every row's segments, scaled so that the dot product of two
    such rows bounds the inner product of the vectors from above."""
    parts = np.array_split(v, min(segments, v.shape[1]), axis=1)
    return np.column_stack([np.sqrt(p.shape[1]) * f for p in parts for f in (p.mean(1), p.std(1))])


def _pair_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """a[i] . b[j] for many pairs."""
    out = np.empty(len(i), dtype=np.result_type(a, b))
    for lo in range(0, len(i), 100_000):
        s = slice(lo, lo + 100_000)
        out[s] = (a[i[s]] * b[j[s]]).sum(1)
    return out


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th largest value (the least, if there are fewer)."""
    return np.partition(values, max(values.shape[1] - k, 0), axis=1)[:, max(values.shape[1] - k, 0)]


def _survivors(q, x, keep: np.ndarray, k: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, candidate, score) of the pairs in ``keep`` that can be among a row's ``k`` best."""
    if not exact or keep.mean() <= MOST:
        i, j = np.nonzero(keep)
        return i, j, _pair_products(q, x, i, j)
    score = np.where(keep, q @ x.T, -np.inf)
    i, j = np.nonzero(keep & (score >= _kth(score, k)[:, None]))
    return i, j, score[i, j]


def best_of_block(q_ids, q, x_ids, x, k: int, levels=LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's ``k`` best candidates."""
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    exact = largest ** 2 * q.shape[1] < 2 ** 53
    qe, xe = (q, x) if exact else (_whole(q), _whole(x))
    q_stats, x_stats = [segment_stats(q, s) for s in levels], [segment_stats(x, s) for s in levels]
    slack = 1e-9 * (1 + largest ** 2 * q.shape[1])
    found = []
    for lo in range(0, len(q), _TOGETHER):
        part = slice(lo, lo + _TOGETHER)
        other = q_ids[part][:, None] != x_ids[None, :]
        bound = np.where(other, q_stats[0][part] @ x_stats[0].T, -np.inf)
        n, seeds = len(bound), min(len(x), 2 * k)
        top = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
        first = _pair_products(qe[part], xe, np.repeat(np.arange(n), seeds), top.ravel()).astype(float).reshape(n, seeds)
        first[~np.take_along_axis(other, top, 1)] = -np.inf
        limit = (_kth(first, k) if seeds >= k else np.full(n, -np.inf)) - slack
        keep = other & (bound >= limit[:, None])
        for qs, xs in zip(q_stats[1:], x_stats[1:]):
            if keep.mean() > MOST:
                keep &= qs[part] @ xs.T >= limit[:, None]
            else:
                i, j = np.nonzero(keep)
                keep[i, j] = _pair_products(qs[part], xs, i, j) >= limit[i]
        i, j, score = _survivors(qe[part], xe, keep, k, exact)
        order = np.lexsort((x_ids[j], -score.astype(float), i)) if exact else \
            np.asarray(sorted(range(len(i)), key=lambda t: (i[t], -score[t], x_ids[j[t]])), dtype=np.int64)
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i, side="left")
        best = rank < k
        found.append((i[best] + lo, j[best], score[best]))
    return tuple(np.concatenate([f[c] for f in found]) for c in range(3))


def _whole(v: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(v)


def _vectors(pdf: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    own = pdf[pdf["length"] == length]
    return own["vec_id"].to_numpy(np.int64), np.stack(own["v"].to_list()).astype(float)


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` candidates of highest score of each query."""
    e = F.col("embedding").cast("array<double>")
    usable = vectors.select("vec_id", e.alias("e")).where(
        F.col("vec_id").isNotNull() & (F.size("e") > 0)
        & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    # Equal rows are one row that counts n times (counted map side first): copies never fill a block.
    rows = usable.groupBy("vec_id", "e").agg(F.count(F.lit(1)).alias("n")) \
        .select("vec_id", F.size("e").alias("length"), "e", "n", F.xxhash64("vec_id", "e").alias("h"))
    queries = rows.where(is_query)
    n_rows, n_queries = rows.agg(F.count(F.lit(1)), F.sum(is_query.cast("long"))).first()
    across = max(1, -(-(n_rows or 0) // ROW_BLOCK))
    down = max(1, -(-(n_queries or 0) // QUERY_BLOCK))

    def blocks(df, own, n_own, other, n_other):
        return (df.withColumn(own, F.pmod("h", F.lit(n_own)).cast("int"))
                  .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
                  .select("row", "col", "vec_id", "h", "length", "n",
                          F.transform("e", lambda x: F.lit(float(scale)) * x).alias("v")))

    def cell(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        for length in sorted(set(q["length"]) & set(x["length"])):
            qi, qv = _vectors(q, length)
            xi, xv = _vectors(x, length)
            qh = q.loc[q["length"] == length, "h"].to_numpy()
            i, j, score = best_of_block(qi, np.floor(qv), xi, np.floor(xv), k)
            score = np.asarray([min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in score], dtype=np.int64)
            xn = x.loc[x["length"] == length, "n"].to_numpy()
            out.append(pd.DataFrame({"query_id": qi[i], "h": qh[i], "vec_id": xi[j], "score": score, "n": xn[j]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("query_id", "h", "vec_id", "score", "n")}, dtype="int64")

    left = blocks(queries, "row", down, "col", across).groupBy("row", "col")
    right = blocks(rows, "col", across, "row", down).groupBy("row", "col")
    best = left.cogroup(right).applyInPandas(cell, "query_id long, h long, vec_id long, score long, n long")
    order = Window.partitionBy("query_id", "h").orderBy(F.col("score").desc(), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    copies = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    return copies.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
