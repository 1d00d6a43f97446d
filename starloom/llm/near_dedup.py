"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set: its shingles (five words, ASCII lower case; a shorter text is one
shingle), weighted by their count times an inverse document frequency

    idf = ln(1 + N / (df + N / 4)) / ln 5

which is 1 for a rare shingle and falls to about 0.37 for one in every document, so that shared
boilerplate counts less.  Document frequencies cover all documents: they are kept in a count-min
table of fixed size, whose error is a fixed small share of N (about the mean number of shingles of a
document over the table's width) at any number of documents.

1. Equal texts form one node, named by their smallest doc_id.
2. Each node gets ``BANDS * ROWS`` consistent weighted samples: two texts agree in one with
   probability equal to their weighted Jaccard similarity.  Bands of samples are bucket keys.
   A band whose samples all are shingles that very many documents share would put all of these
   in one bucket; it goes on with further samples, one more for every doubling of the number of
   documents that share its rarest one.  Such a text is marked, because longer keys lose pairs.
3. In each bucket one node is compared with the others (a star, no pairs among the others): the
   exact weighted Jaccard similarity decides.  The center is drawn by a hash of node and bucket,
   so the buckets of a large group have different centers.  Links make components.
4. Nodes of buckets that still hold several components, and marked nodes, go into an exact join.
   Each lists its rarest shingles, as many as hold 1 - s of its weight (and one more) for the
   similarity s: two texts of at least s have one of these in common, and from the first one on
   both have enough weight left.  In each list the nodes outside its largest component first meet
   one node of that; then all nodes meet those of other components, but for pairs tried before.
   Lists of one component cost nothing, so a group of any size costs a few comparisons a member.
   A link is lost only if its texts share no bucket that five samples make, and no path of other
   links connects them.

A class is a component; its id is the smallest doc_id in it.

Defined cases: null text counts as empty; texts without a word are near only to equal texts
(the empty texts are one class if they are equal); rows with one id are one document, and
repeated rows get equal results; a row without an id belongs to the class of its text if a
document with an id has the same text, else its class is null; an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage, unstage
from .components import components
from .recompression import hashed_words

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: A band whose samples are all shared by more documents than this times 2**ROWS gets more rows.
SHARED_BY = 16
#: Nodes of a shingle's list that one task compares with the others.
LIST_PART = 1024
#: Width (a power of two) and slices of the table of document frequencies.
DF_BITS, DF_SLICES = 18, 32
#: Entries of the tables of random variates; shingles pick theirs by hash.
_VARIATES = 16
#: Shingles sampled together.
_TOGETHER = 1 << 16
#: Texts whose shingles a comparing task keeps.
_KNOWN_TEXTS = 1024


# --- shingles -----------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chained(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` words that follow each other."""
    n = len(w) - size + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        h = _mix(h + w[k:k + n] + np.uint64(k + 1))
    return h


def shingles_of(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of each text, ascending, and their counts."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    w, start = hashed_words(b"\n".join(raw))
    first = np.searchsorted(start, np.cumsum([0, *(len(r) + 1 for r in raw)]))
    h = _chained(w, WORDS)
    return [np.unique(h[lo:hi - WORDS + 1] if hi - lo >= WORDS else _chained(w[lo:hi], max(hi - lo, 1)), return_counts=True)
            for lo, hi in zip(first, first[1:])]


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return shingles_of([text])[0]


# --- document frequencies -----------------------------------------------------------------

def _cells(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - DF_BITS)).astype(np.int64), (h & np.uint64((1 << DF_BITS) - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Count-min table (2 x 2**DF_BITS) over all documents: a fixed size at any input."""
    width = 2 << DF_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            cells = [_cells(h) for h, _ in shingles_of(batch.column(0).to_pylist())]
            for row in (0, 1):
                total[row << DF_BITS:(row + 1) << DF_BITS] += np.bincount(
                    np.concatenate([c[row] for c in cells] or [np.zeros(0, np.int64)]), minlength=1 << DF_BITS)
        parts = np.split(total, DF_SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(DF_SLICES), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
            names=["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in table.column("counts").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    schema = "slice int, counts binary"
    partial = docs.select("text").mapInArrow(count, schema)
    rows = partial.groupBy("slice").applyInArrow(add, schema).collect()
    total = np.zeros(width, np.int64)
    for r in rows:
        size = width // DF_SLICES
        total[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return total.reshape(2, -1)


@dataclass
class Weights:
    """Weights of a text's shingles."""
    table: np.ndarray
    n_docs: int

    @functools.cached_property
    def _others(self) -> float:
        return self.table[0].mean()

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        h, w, _ = self._frequencies(text)
        return h, w

    def with_rows(self, text: str | None, found=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles, weights, and the samples that a band of each shingle's kind needs."""
        h, w, df = self._frequencies(text, found)
        # What other shingles add to a cell, and how much that varies, is no frequency.
        others = self._others
        surely = np.maximum(1, df - others - 4 * np.sqrt(others))
        rows = np.ceil(np.log2(surely / SHARED_BY))
        return h, w, rows.astype(np.int64)

    def _frequencies(self, text: str | None, found=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shingles, weights and document frequencies; ``found``: the text's shingles and counts."""
        h, tf = found or shingles(text)
        a, b = _cells(h)
        df = np.minimum(self.table[0][a], self.table[1][b])
        n = max(1, self.n_docs)
        return h, tf * np.log1p(n / (df + n / 4)) / np.log(5), df

    def rarest(self, text: str | None, similarity: float, found=None) -> tuple[np.ndarray, np.ndarray, float]:
        """The shingles of which a text of at least ``similarity`` must have one, rarest first, the
        weight from each to the last of all, and the total weight."""
        h, w, df = self._frequencies(text, found)
        order = np.lexsort((h, df))
        rest = np.cumsum(w[order][::-1])[::-1]
        n = int((rest >= similarity * w.sum() * (1 - 1e-9)).sum())
        return h[order[:n]], rest[:n], float(w.sum())

    def similarity(self, x: str | None, y: str | None, of=None) -> float:
        """Weighted Jaccard similarity of two texts; ``of`` may be a cached form of that method."""
        of = of or self.of
        (hx, wx), (hy, wy) = of(x), of(y)
        if not len(hx) or not len(hy):
            return float(x == y)
        _, i, j = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
        shared = np.minimum(wx[i], wy[j]).sum()
        return float(shared / (wx.sum() + wy.sum() - shared))


# --- consistent weighted sampling ---------------------------------------------------------

class Sampler:
    """Improved consistent weighted sampling: r, c ~ Gamma(2, 1) and beta ~ U(0, 1) belong to a
    shingle and a sample number; with t = floor(ln w / r + beta), the shingle of the least
    ln c - r * (t - beta) - r is the sample, together with its t."""

    def __init__(self, seed: int = 20_11):
        rng, n = np.random.default_rng(seed), 1 << _VARIATES
        self.r = rng.gamma(2, 1, n).astype(np.float32)
        self.beta = rng.random(n).astype(np.float32)
        # ln c - r, lifted by a constant, which changes no order.
        self.lifted = (np.log(rng.gamma(2, 1, n)) - self.r + 128).astype(np.float32)
        self.odd = rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(self, hashes: np.ndarray, weights: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Band keys (texts x BANDS) of texts whose shingles begin at ``starts``."""
        return self.bands_and_marks(hashes, weights, rows, starts)[0]

    def bands_and_marks(self, hashes: np.ndarray, weights: np.ndarray, rows: np.ndarray,
                        starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys, and whether some band of a text has more than ``ROWS`` samples."""
        log_w, n = np.log(weights).astype(np.float32), len(hashes)
        lengths = np.diff(np.append(starts, n))
        samples = np.zeros((BANDS * ROWS, len(starts)), np.uint64)
        needs = np.zeros((BANDS * ROWS, len(starts)), np.int64)
        # Every step writes into the same few arrays.
        pick, (r, beta, t, a) = np.empty(n, np.uint64), np.empty((4, n), np.float32)
        at = pick.view(np.intp)
        for s, odd in enumerate(self.odd):
            np.multiply(hashes, odd, out=pick)
            np.right_shift(pick, np.uint64(64 - _VARIATES), out=pick)
            for table, out in ((self.r, r), (self.beta, beta), (self.lifted, a)):
                np.take(table, at, out=out, mode="clip")
            np.divide(log_w, r, out=t)
            np.floor(np.add(t, beta, out=t), out=t)
            np.subtract(t, beta, out=beta)
            np.subtract(a, np.multiply(beta, r, out=beta), out=a)
            # The first place of each text's least value.
            hits = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), lengths))
            least = hits[np.searchsorted(hits, starts)]
            samples[s] = _mix(hashes[least] + t[least].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            needs[s] = rows[least]
        keys = np.zeros((len(starts), BANDS), np.uint64)
        longer_keys = np.zeros(len(starts), bool)
        for band in range(BANDS):
            first = band * ROWS
            need = needs[first:first + ROWS].min(0)
            longer_keys |= need > ROWS
            for k in range(max(ROWS, need.max(initial=0))):
                s = (first + k) % len(samples)
                longer = _mix(keys[:, band] + samples[s] + np.uint64(first + k + 1))
                keys[:, band] = longer if k < ROWS else np.where(k < need, longer, keys[:, band])
        return keys, longer_keys


def _groups(found: list[tuple]):
    """Texts' shingles in groups of about _TOGETHER."""
    group, size = [], 0
    for f in found:
        group.append(f)
        size += len(f[1])
        if size >= _TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """``docs`` with the band keys, the total weight and the mark of each text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("bands array<long>, weight double, marked boolean")
    def signature(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        sampler = Sampler()
        for texts in parts:
            bands, totals, marks = [np.zeros(0, np.int64)] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            found = ((i, *shared.value.with_rows(None, f)) for i, f in enumerate(shingles_of(list(texts))))
            for group in _groups([f for f in found if len(f[1])]):
                lengths = np.asarray([len(f[1]) for f in group])
                keys, longer = sampler.bands_and_marks(*(np.concatenate([f[c] for f in group]) for c in (1, 2, 3)),
                                                       np.cumsum(lengths) - lengths)
                for (i, _, w, _), k, m in zip(group, keys.view(np.int64), longer):
                    bands[i], totals[i], marks[i] = k, w.sum(), m
            yield pd.DataFrame({"bands": bands, "weight": totals, "marked": marks})

    return docs.withColumn("s", signature("text")).select(*docs.columns, "s.bands", "s.weight", "s.marked")


# --- classes ------------------------------------------------------------------------------

def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def _verified(pairs: DataFrame, texts: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least ``similarity``."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def jaccard(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        # Pairs come ordered by one of their texts, and a text stands in many pairs.
        weights = shared.value
        of = functools.lru_cache(_KNOWN_TEXTS)(weights.of)
        for x, y in parts:
            yield pd.Series([weights.similarity(a, b, of) for a, b in zip(x, y)], dtype=float)

    of = texts.select("node", "text")
    joined = pairs.join(of.withColumnsRenamed({"node": "a", "text": "text_a"}), "a") \
        .join(of.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    return joined.withColumn("similarity", jaccard("text_a", "text_b")) \
        .where(F.col("similarity") >= similarity).select("a", "b")


def _centers(members: DataFrame) -> DataFrame:
    """One node of each bucket."""
    draw = F.min(F.struct(F.xxhash64("node", "bucket", F.lit(0)).alias("d"), "node", "weight"))
    return members.groupBy("bucket").agg(draw.alias("f")) \
        .select("bucket", F.col("f.node").alias("center"), F.col("f.weight").alias("w"))


def _pairs(meet: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of nodes that meet a center.  Total weights further apart than the similarity rule
    a pair out."""
    close = F.least("weight", "w") >= similarity * F.greatest("weight", "w") * (1 - 1e-9)
    return meet.where((F.col("node") != F.col("center")) & close) \
        .select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct()


def _with_components(nodes: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return nodes.withColumn("component", F.col("node"))
    return nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _unsettled(members: DataFrame, marked: DataFrame, comps: DataFrame | None) -> DataFrame:
    """(node, component) of marked nodes and of buckets that still hold several components."""
    own = _with_components(members.select("bucket", "node"), comps)
    mixed = own.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
        .where("x <> y").select("bucket")
    return own.join(mixed, "bucket").select("node", "component") \
        .unionByName(_with_components(marked, comps).select("node", "component")).distinct()


def _lists(texts: DataFrame, weights: Weights, similarity: float) -> DataFrame:
    """For the rarest shingles of each of ``texts`` (node, component, text): the weight ``rest`` from
    that shingle on, and the total weight; without shingles that only one component lists."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)
    kind = texts.schema["node"].dataType.simpleString()

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.rarest(None, similarity, f) for f in shingles_of(batch.column("text").to_pylist())]
            sizes = [len(h) for h, _, _ in found]
            at = pa.array(np.repeat(np.arange(len(found)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([h for h, _, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)),
                 batch.column("node").take(at), batch.column("component").take(at),
                 pa.array(np.concatenate([r for _, r, _ in found] or [np.zeros(0)])),
                 pa.array(np.repeat([w for _, _, w in found], sizes).astype(float))],
                names=["shingle", "node", "component", "rest", "weight"])

    rows = stage(texts.select("node", "component", "text").mapInArrow(
        rarest, f"shingle long, node {kind}, component {kind}, rest double, weight double"), "rarest-shingles")
    mixed = rows.groupBy("shingle").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
        .where("x <> y").select("shingle")
    lists = stage(rows.join(mixed, "shingle").drop("component"), "lists")
    unstage(rows)
    return lists


def _with_largest(lists: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Rows of the lists that hold several components: their ``component``, the list's ``size``, its
    largest component and a node of that."""
    own = _with_components(lists, comps)
    parts = own.groupBy("shingle", "component").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "rest", "weight")).alias("f"))
    most = parts.groupBy("shingle").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"),
                                        F.max(F.struct("n", "component", "f")).alias("m")).where("parts > 1")
    return own.join(most.select("shingle", "size", F.col("m.component").alias("largest"), F.col("m.f").alias("f")), "shingle")


def _enough(similarity: float) -> Column:
    """From the shingle on, both texts have the weight that a pair of that similarity shares."""
    return F.least("rest", "r") >= similarity / (1 + similarity) * (F.col("weight") + F.col("w")) * (1 - 1e-9)


def _to_largest(lists: DataFrame, comps: DataFrame | None, similarity: float) -> DataFrame:
    """Pairs of one node of a list's largest component and the list's nodes of other components."""
    meet = _with_largest(lists, comps).where("component <> largest").select(
        "node", "rest", "weight", F.col("f.node").alias("center"), F.col("f.rest").alias("r"), F.col("f.weight").alias("w"))
    return _pairs(meet.where(_enough(similarity)), similarity)


def _across(lists: DataFrame, comps: DataFrame | None, similarity: float) -> DataFrame:
    """All pairs of nodes of different components that share a list.  Nodes outside the largest
    component meet all: within components, no more pairs arise than across them."""
    own = _with_largest(lists, comps).withColumn("parts", F.ceil(F.col("size") / LIST_PART).cast("int"))
    few = own.where("component <> largest").select(
        "shingle", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "component", "node", "rest", "weight")
    every = own.select("shingle", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "largest",
                       F.col("component").alias("other"), F.col("node").alias("center"), F.col("rest").alias("r"),
                       F.col("weight").alias("w"))
    meet = few.join(every, ["shingle", "part"]).where(
        (F.col("component") != F.col("other")) & ((F.col("other") == F.col("largest")) | (F.col("component") < F.col("other"))))
    return _pairs(meet.where(_enough(similarity)), similarity)


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text key (k1, k2) and class_id of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    small_batches(docs.sparkSession)
    weights = Weights(document_frequencies(docs), docs.count())
    signed = signatures(docs.select("doc_id", "text", *_text_key(F.col("text"))), weights).drop("text")
    signed = stage(signed, "signatures")
    nodes = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"),
                                           F.first("weight").alias("weight"), F.first("marked").alias("marked"))
    nodes = nodes.where(F.col("node").isNotNull())
    keys = nodes.select("node", "k1", "weight", F.explode("bands").alias("bucket"))
    shared = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    members = stage(keys.join(shared, "bucket").distinct(), "bucket-members")
    # Texts of the nodes that share a bucket or are marked, found once for all rounds.
    marked = nodes.where("marked").select("node", "k1")
    wanted = members.select("node", "k1").unionByName(marked).withColumnRenamed("node", "doc_id").distinct()
    texts = stage(docs.withColumn("k1", F.xxhash64("text")).join(wanted, ["doc_id", "k1"])
                  .dropDuplicates(["doc_id", "k1"]).select(F.col("doc_id").alias("node"), "text"), "bucket-texts")
    members_only = members.select("bucket", "node", "weight")
    tried = stage(_pairs(members_only.join(_centers(members_only), "bucket"), similarity), "pairs")
    links = stage(_verified(tried, texts, weights, similarity), "links")
    comps = None if links.isEmpty() else stage(components(links), "components")
    unsettled = _unsettled(members_only, marked.select("node"), comps)
    lists = _lists(texts.join(unsettled, "node"), weights, similarity)
    for meeting in (_to_largest, _across):
        pairs = stage(meeting(lists, comps, similarity).join(tried, ["a", "b"], "left_anti"), "pairs")
        new = stage(_verified(pairs, texts, weights, similarity), "links")
        tried, links = tried.unionByName(pairs), links.unionByName(new)
        if not new.isEmpty():
            comps = stage(components(links), "components")
    unstage(lists)
    unstage(texts)
    named = nodes.select("k1", "k2", "node")
    if comps is None:
        named = named.withColumn("class_id", F.col("node"))
    else:
        named = named.join(comps, "node", "left").withColumn("class_id", F.coalesce("component", "node"))
    return signed.select("doc_id", "k1", "k2").join(named.select("k1", "k2", "class_id"), ["k1", "k2"], "left")


def report(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, and whether the document stands for its class."""
    return classes(docs, similarity).select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("stays"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without those that another document of their class stands for.
    A row whose class is null stays."""
    leave = classes(docs, similarity).where(
        F.col("class_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("class_id"))) \
        .select(F.col("doc_id").alias("__doc"), F.col("k1").alias("__k1")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.join(leave, F.col("doc_id").eqNullSafe(F.col("__doc")) & (key == F.col("__k1")), "left_anti")
