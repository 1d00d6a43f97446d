"""Hard-negative mining with Kronecker-packed products.

Components become floor(scale * x), exact integers.  Several candidates' components of one
dimension are biased to be non-negative and laid side by side into separated fields of one wide
integer.  Multiplying that by an anchor's (biased) component multiplies all its fields at once;
the sum over the dimensions holds, per field, a candidate's whole inner product, because a field
is as wide as the largest possible sum.  Fields are then cut apart and the bias taken off, so
scores are exact.  Words have 64 bits; components too large for that go through integers of any
size, packed alike.

Anchors and candidates meet in a grid of blocks of fixed size, twice: first for each anchor's
best rows of its own label (its positives), then, with the positives' scores known, for the rows
of other labels whose score lies between two shares of a positive's.  Every cell keeps the few
best of an anchor (and positive), which are ranked per anchor afterwards.

Defined cases: rows whose id or label is null, whose vector is null, empty or holds a null or
non-finite component take no part; vectors only meet vectors of their own length; rows equal in
id, label and vector are one row, rows that share only the id are different rows; a row is not
its own candidate; ties go to the smaller id, then to a hash of the row; a positive of negative
score has no negatives; scores that 64 bits can't hold become the largest (or least) that
they can; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Vectors of a block of anchors and of candidates.
ANCHOR_BLOCK, ROW_BLOCK = 2048, 8192
#: Anchors whose scores with a block are in memory at once.
_TOGETHER = 256
#: Fields of an integer of any size.
_BIG_FIELDS = 8

#: Scores are held within these.
_LIMIT = 2 ** 63 - 1


class Packed:
    """Candidates (rows of integers) packed for products with any anchors up to ``reach``."""

    def __init__(self, rows: np.ndarray, reach: int):
        self.n, length = rows.shape
        self.bias = max(0, -int(rows.min(initial=0)))
        self.reach = reach                                 # anchors' components lie in [-reach, reach]
        top = int(rows.max(initial=0)) + self.bias
        self.width = max(1, (length * top * 2 * reach).bit_length())
        self.big = self.width > 62
        self.fields = _BIG_FIELDS if self.big else 64 // self.width
        kind = object if self.big else np.uint64
        groups = -(-self.n // self.fields)
        padded = np.zeros((groups * self.fields, length), dtype=kind)
        padded[:self.n] = rows.astype(object) + self.bias if self.big else (rows + self.bias).astype(np.uint64)
        self.words = np.zeros((groups, length), dtype=kind)
        for k in range(self.fields):
            self.words += padded[k::self.fields] << self._shift(k)
        self.sums = rows.astype(object).sum(1) if self.big else rows.sum(1)

    def _shift(self, k: int):
        return k * self.width if self.big else np.uint64(k * self.width)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products (anchors x candidates), exact up to the limit of 64 bits."""
        kind = object if self.big else np.uint64
        lifted = anchors.astype(object) + self.reach if self.big else (anchors + self.reach).astype(np.uint64)
        wide = lifted.astype(kind) @ self.words.T          # one product per dimension and word
        mask = (1 << self.width) - 1
        out = np.empty((len(anchors), self.words.shape[0] * self.fields), dtype=object if self.big else np.int64)
        for k in range(self.fields):
            out[:, k::self.fields] = (wide >> self._shift(k)) & (mask if self.big else np.uint64(mask))
        # (a + r)(c + b) summed = a.c + b sum(a) + r sum(c) + length * r * b
        own = anchors.astype(object).sum(1) if self.big else anchors.sum(1)
        length = anchors.shape[1]
        out = out[:, :self.n] - self.bias * own[:, None] - (self.reach * self.sums + length * self.reach * self.bias)[None, :]
        return np.clip(out, -_LIMIT, _LIMIT).astype(np.int64) if self.big else out


def _integers(vectors: list) -> np.ndarray:
    """Whole numbers; 64 bits where squares of the components can't leave them."""
    v = np.floor(np.stack(vectors).astype(float))
    if np.abs(v).max(initial=0) < 2 ** 24:
        return v.astype(np.int64)
    return np.vectorize(int, otypes=[object])(v)


def _best(i: np.ndarray, j: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Positions of each i's ``k`` best by score (descending), id and key."""
    order = np.lexsort((keys[j], ids[j], -score, i))
    rank = np.arange(len(i)) - np.searchsorted(i[order], i[order], side="left")
    return order[rank < k]


def _lengths(a: pd.DataFrame, x: pd.DataFrame):
    """Anchors and candidates of the lengths that both have, as integer arrays."""
    for length in sorted(set(a["length"]) & set(x["length"])):
        some, rows = a[a["length"] == length], x[x["length"] == length]
        av, xv = _integers(some["v"].to_list()), _integers(rows["v"].to_list())
        if object in (av.dtype, xv.dtype):
            av, xv = av.astype(object), xv.astype(object)
        yield some, av, rows, Packed(xv, max(1, int(np.abs(av).max(initial=0))))


def _strips(some: pd.DataFrame, av: np.ndarray, rows: pd.DataFrame, packed: Packed):
    """(first anchor, scores, whether labels agree, whether it is the anchor itself) in strips."""
    ids, keys, labels = (rows[c].to_numpy() for c in ("vec_id", "key", "label"))
    for lo in range(0, len(av), _TOGETHER):
        part = slice(lo, lo + _TOGETHER)
        own = (some["vec_id"].to_numpy()[part, None] == ids) & (some["key"].to_numpy()[part, None] == keys)
        yield lo, packed.scores(av[part]), some["label"].to_numpy()[part, None] == labels, own


def _frame(parts: list[dict], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in columns})


_POSITIVE = ["anchor_id", "anchor", "vec_id", "key", "score"]
_NEGATIVE = ["anchor_id", "anchor", "slot", "positive_id", "positive_score", "negative_id", "key", "negative_score"]


def _schema(columns: list[str]) -> str:
    return ", ".join(f"{c} long" for c in columns)


def _positives(k: int):
    def cell(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        for some, av, rows, packed in _lengths(a, x):
            ids, keys = rows["vec_id"].to_numpy(), rows["key"].to_numpy()
            for lo, score, same, own in _strips(some, av, rows, packed):
                i, j = np.nonzero(same & ~own)
                keep = _best(i, j, score[i, j], ids, keys, k)
                i, j = i[keep], j[keep]
                out.append({"anchor_id": some["vec_id"].to_numpy()[i + lo], "anchor": some["key"].to_numpy()[i + lo],
                            "vec_id": ids[j], "key": keys[j], "score": score[i, j]})
        return _frame(out, _POSITIVE)
    return cell


def _bounds(score: int, low: int, high: int, whole: int) -> tuple[int, int]:
    """The whole numbers s with low * score <= whole * s <= high * score lie between these."""
    least, most = -(-low * score // whole), high * score // whole
    return min(max(least, -_LIMIT), _LIMIT), min(max(most, -_LIMIT), _LIMIT)


def _negatives(k: int, low: int, high: int, whole: int):
    def cell(a: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        out = []
        for some, av, rows, packed in _lengths(a, x):
            ids, keys = rows["vec_id"].to_numpy(), rows["key"].to_numpy()
            found = [list(zip(*p)) for p in zip(some["positive_ids"], some["positive_scores"])]
            slots = max(map(len, found))
            # A slot that an anchor lacks takes no score: its least is above its most.
            span = np.array([[_bounds(int(p[s][1]), low, high, whole) if s < len(p) else (1, 0) for s in range(slots)]
                             for p in found], dtype=np.int64)
            known = np.array([[p[s] if s < len(p) else (0, 0) for s in range(slots)] for p in found], dtype=np.int64)
            for lo, score, same, _ in _strips(some, av, rows, packed):
                least, most = span[lo:lo + len(score), :, 0], span[lo:lo + len(score), :, 1]
                i, j = np.nonzero(~same & (score >= least.min(1)[:, None]) & (score <= most.max(1)[:, None]))
                s = score[i, j]
                for slot in range(slots):
                    at = np.flatnonzero((s >= least[i, slot]) & (s <= most[i, slot]))
                    at = at[_best(i[at], j[at], s[at], ids, keys, k)]
                    who = i[at] + lo
                    out.append({"anchor_id": some["vec_id"].to_numpy()[who], "anchor": some["key"].to_numpy()[who],
                                "slot": np.full(len(at), slot), "positive_id": known[who, slot, 0],
                                "positive_score": known[who, slot, 1], "negative_id": ids[j[at]], "key": keys[j[at]],
                                "negative_score": s[at]})
        return _frame(out, _NEGATIVE)
    return cell


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100, whole: int = 100, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor
    and each of its best ``positives`` rows of equal label, the best ``negatives`` rows of other
    labels with low * positive_score <= whole * negative_score <= high * positive_score.

    Reads the columns vec_id, label and embedding; ``is_anchor`` may use vec_id and label."""
    e = F.col("embedding").cast("array<double>")
    usable = vectors.select("vec_id", F.col("label").cast("long").alias("label"), e.alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0)
        & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    # Equal rows are one row (dropped map side first), so copies of a row never fill a block.
    rows = stage(usable.distinct().select("vec_id", "label", F.size("e").cast("long").alias("length"),
                                          F.xxhash64("vec_id", "label", "e").alias("key"), "e"), "vectors")
    anchors = rows.where(is_anchor)
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.sum(is_anchor.cast("long"))).first()
    across, down = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-(n_anchors or 0) // ANCHOR_BLOCK))

    def blocks(df, own, n_own, other, n_other, *more):
        return (df.withColumn(own, F.pmod(F.xxhash64("key"), F.lit(n_own)).cast("int"))
                  .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
                  .select("row", "col", "vec_id", "label", "length", "key",
                          F.transform("e", lambda x: F.lit(float(scale)) * x).alias("v"), *more).groupBy("row", "col"))

    right = blocks(rows, "col", across, "row", down)
    found = blocks(anchors, "row", down, "col", across).cogroup(right).applyInPandas(_positives(positives), _schema(_POSITIVE))
    order = Window.partitionBy("anchor_id", "anchor").orderBy(F.col("score").desc(), "vec_id", "key")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives) \
        .groupBy("anchor_id", "anchor").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("p"))
    best = best.select(F.col("anchor_id").alias("vec_id"), F.col("anchor").alias("key"),
                       F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))
    ready = stage(anchors.join(best, ["vec_id", "key"]), "anchors")
    found = blocks(ready, "row", down, "col", across, "positive_ids", "positive_scores").cogroup(right) \
        .applyInPandas(_negatives(negatives, low, high, whole), _schema(_NEGATIVE))
    order = Window.partitionBy("anchor_id", "anchor", "slot").orderBy(F.col("negative_score").desc(), "negative_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
