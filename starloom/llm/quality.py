"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a few bounded shape features.  Training (on a bounded sample of labelled
rows) cycles through the features; in each turn a shallow regression tree on one feature's
bins is fitted to the log-loss gradient and added, shrunk, to that feature's lookup table.
The pairs of features whose joint bins explain most of what is left get two-way tables the
same way.  Scoring adds up table entries of the bins and applies the logistic function.

Defined cases: null text counts as empty, and empty texts have a score like any other; with no
labelled rows, or one class only, the score is the (smoothed) share of that class; repeated
rows and ties are rows like any other; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

import itertools
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import code_points, lowest_hashes, small_batches

#: Labelled rows to learn from.
SAMPLE_ROWS = 12_000
BINS, PAIR_BINS, PAIRS = 32, 8, 10
ROUNDS, PAIR_ROUNDS, RATE = 120, 60, 0.12

# --- features -----------------------------------------------------------------------------

FEATURES = ["log_chars", "letters", "upper", "digits", "blanks", "newlines", "marks", "symbols", "exclamations",
            "repeated_char", "repeated_symbol", "lone_symbol", "log_words", "word_length", "distinct_words",
            "top_word", "repeated_word", "upper_words", "distinct_lines", "log_line_length"]

_LOWER, _UPPER, _DIGIT, _BLANK, _NEWLINE, _MARK, _SHOUT, _SYMBOL = range(8)
_kinds: list[np.ndarray] = []


def _kind(c: str) -> int:
    if c.isalpha():
        return _UPPER if c.isupper() else _LOWER
    if c.isdigit():
        return _DIGIT
    if c == "\n":
        return _NEWLINE
    if c.isspace():
        return _BLANK
    if c == "!":
        return _SHOUT
    return _MARK if c in ".,;:?'\"()-" else _SYMBOL


def _kind_of(codes: np.ndarray) -> np.ndarray:
    if not _kinds:
        _kinds.append(np.fromiter((_kind(chr(c)) for c in range(1 << 16)), np.uint8, 1 << 16))
    return _kinds[0][np.minimum(codes, 0xFFFF)]


def text_features(text: str | None, segment: int = 1 << 20) -> list[float]:
    text = text or ""
    n = max(1, len(text))
    counts, same, same_symbol, lone = np.zeros(8), 0, 0, 0
    for lo in range(0, len(text), segment):
        # One character of context on either side of a segment.
        codes = code_points(text[max(0, lo - 1):lo + segment + 1])
        kinds = _kind_of(codes)
        own = slice(lo > 0, (lo > 0) + min(segment, len(text) - lo))
        counts += np.bincount(kinds[own], minlength=8)
        symbol = kinds >= _MARK
        equal = codes[1:] == codes[:-1]
        pair = slice(max(0, own.start - 1), own.stop - 1)
        same += int(equal[pair].sum())
        same_symbol += int((equal & symbol[1:])[pair].sum())
        blank = (kinds == _BLANK) | (kinds == _NEWLINE)
        alone = symbol.copy()
        alone[1:] &= blank[:-1]
        alone[:-1] &= blank[1:]
        lone += int(alone[own].sum())
    letters = counts[_LOWER] + counts[_UPPER]
    words = text.split()
    w = max(1, len(words))
    by_word = Counter(words)
    lines = text.split("\n")
    return [np.log1p(len(text)), letters / n, counts[_UPPER] / max(1.0, letters), counts[_DIGIT] / n,
            counts[_BLANK] / n, counts[_NEWLINE] / n, counts[_MARK] / n, counts[_SYMBOL] / n, counts[_SHOUT] / n,
            same / n, same_symbol / n, lone / w, np.log1p(len(words)),
            (len(text) - counts[_BLANK] - counts[_NEWLINE]) / w, len(by_word) / w,
            max(by_word.values(), default=0) / w, sum(map(operator.eq, words, words[1:])) / w,
            sum(map(str.isupper, words)) / w, len(set(lines)) / len(lines), np.log1p(len(text) / len(lines))]


# --- model --------------------------------------------------------------------------------

@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            z += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            z += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best place to split bins lo..hi-1 in two, and its gain."""
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    if not len(gl):
        return 0.0, -1
    gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
    gain[(hl < 1) | (ht - hl < 1)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), lo + k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Values per bin of the tree of at most ``leaves`` leaves grown best cut first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max((*_cut(g, h, *p), i) for i, p in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts[k]
        parts[k:k + 1] = [(lo, at), (at, hi)]
    out = np.empty(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Two-level tree on two features' bins: a cut on the first, then one on the second in
    each half."""
    best, values = -1.0, np.zeros_like(g)
    for at in range(1, g.shape[0]):
        halves, gain = [], 0.0
        for half in (slice(0, at), slice(at, g.shape[0])):
            gs, hs = g[half].sum(0), h[half].sum(0)
            k, c = _cut(gs, hs, 0, len(gs))
            gain += k + gs.sum() ** 2 / (hs.sum() + 1)
            halves.append((half, gs, hs, c if k > 1e-9 else len(gs)))
        if gain > best:
            best, values = gain, np.zeros_like(g)
            for half, gs, hs, c in halves:
                values[half, :c] = gs[:c].sum() / (hs[:c].sum() + 1)
                if c < len(gs):
                    values[half, c:] = gs[c:].sum() / (hs[c:].sum() + 1)
    return values, best - g.sum() ** 2 / (h.sum() + 1)


def train(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """``x``: rows of features, ``y``: 0 or 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return model
    n_features = x.shape[1]
    model.edges = [_edges(x[:, f], BINS) for f in range(n_features)]
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(n_features)]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.intercept)

    def gradient():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = gradient()
            n = len(table)
            step = RATE * _shallow_tree(np.bincount(bins[f], g, n), np.bincount(bins[f], h, n))
            table += step
            z += step[bins[f]]

    def joint(a, b, v):
        shape = len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], v, shape[0] * shape[1]).reshape(shape)

    g, h = gradient()
    gains = {(a, b): _pair_tree(joint(a, b, g), joint(a, b, h))[1]
             for a, b in itertools.combinations(range(n_features), 2)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            g, h = gradient()
            step = RATE * _pair_tree(joint(a, b, g), joint(a, b, h))[0]
            table += step
            z += step[coarse[a], coarse[b]]
    return model


# --- operator -----------------------------------------------------------------------------

def learn(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Learn from at most ``sample_rows`` labelled, ``usable`` rows, those of the lowest hash of
    the id.  An id labelled both ways counts for either."""
    small_batches(docs.sparkSession)
    marks = labels.select("doc_id", F.col(label).alias("mark")).where(F.col("mark").isin(0, 1)).distinct()
    ids = docs.select("doc_id").where(usable).join(marks, "doc_id").select("doc_id", "mark", F.xxhash64("doc_id").alias("h"))
    # Ids beyond this hash can't be among the lowest: what is sorted is bounded, however often an
    # id is repeated.
    n = ids.agg(F.approx_count_distinct(F.struct("doc_id", "mark"))).first()[0]
    picked = ids.where(F.col("h") <= lowest_hashes(n, sample_rows)).distinct().orderBy("h", "doc_id", "mark").limit(sample_rows) \
        .select("doc_id", "mark")

    @F.pandas_udf("array<double>")
    def shape(texts: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in texts])

    # At most sample_rows ids: a broadcast of bounded size.  Of rows with the same id one is learned
    # from for each label, that of the lowest hash of the text.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id") \
        .groupBy("doc_id", "mark").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")) \
        .select("doc_id", "mark", shape("t.text").alias("x")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["mark"], r["x"]))
    return train(np.asarray([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES)),
                 np.asarray([r["mark"] for r in rows], float))


def score(docs: DataFrame, model: AdditiveModel, out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 as ``out``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            x = np.asarray([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x))

    return docs.withColumn(out, probability("text"))
