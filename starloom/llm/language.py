"""Hierarchical language identification: the family first, then one-versus-one linear support
vector machines between the languages of that family.

A text becomes the mean over its character n-grams (1 to 3, lower-cased, every run of other
characters one blank), hashed to ``DIMS`` dimensions.  Both levels are linear SVMs between two
classes, trained by dual coordinate descent on a bounded sample of labelled rows; a class wins
by votes, then by margin.  The score is the product over both levels of the winner's least
probability against another class (a logistic curve fitted to the margins of each machine).

Defined cases: null text or text without a letter is ``und`` with score 0; so is every text
when no labelled row could be learned from; a single learned language wins with score 1.
Repeated rows and ties are rows like any other (a tie goes to the smaller name); an empty table
gives no rows; other columns are ignored, and never inputs.
"""
from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import code_points, lowest_hashes, small_batches, text_chunks

#: Hashed dimensions of the n-grams; one more, of weight 0, takes what is not an n-gram.
DIMS = 1 << 15
#: Labelled rows to learn from, over all languages.
SAMPLE_ROWS = 4000
UNDETERMINED = "und"

# Families of languages by ISO 639-1 code.  A language not listed is a family.
FAMILIES = {
    "Germanic": "af da de en fy is lb nb nl nn no sv yi",
    "Romance": "ca es fr gl it la oc pt ro",
    "Slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "Baltic": "lt lv",
    "Celtic": "br cy ga gd",
    "Uralic": "et fi hu",
    "Indo-Iranian": "bn fa gu hi mr ne pa ps si ur",
    "Turkic": "az kk ky tr tt ug uz",
    "Semitic": "am ar he mt",
    "Dravidian": "kn ml ta te",
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang, lang)


# --- features -----------------------------------------------------------------------------

_BLANK, _GAP = 32, 0
_is_letter: list[np.ndarray] = []


def _letters(codes: np.ndarray) -> np.ndarray:
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    out = _is_letter[0][np.minimum(codes, 0xFFFF)]
    for c in np.unique(codes[codes > 0xFFFF]):
        out[codes == c] = chr(c).isalpha()
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _ngrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions of the 1-, 2- and 3-grams at each place of the joined parts (3 x places),
    and each part's first place.  N-grams never reach into another part."""
    pieces, starts, at = [], [], 0
    for p in parts:
        codes = code_points(f" {p} ".lower())
        codes = np.where(_letters(codes), codes, _BLANK).astype(np.uint32)
        codes = codes[np.r_[True, (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)]]
        pieces += [codes, np.asarray([_GAP, _GAP], np.uint32)]
        starts.append(at)
        at += len(codes) + 2
    c = np.concatenate(pieces)
    h = np.empty((3, len(c)), np.uint32)
    h[0] = c * np.uint32(0x9E3779B1) + np.uint32(1)
    two = np.append(c[1:], np.uint32(_GAP))
    three = np.append(two[1:], np.uint32(_GAP))
    h[1] = (c * np.uint32(0x85EBCA6B)) ^ (two * np.uint32(0xC2B2AE35)) + np.uint32(2)
    h[2] = (h[1] * np.uint32(0x27D4EB2F)) ^ (three * np.uint32(0x165667B1)) + np.uint32(3)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    dims = (h >> np.uint32(17)).astype(np.int64)
    gap = c == _GAP
    dims[0][gap] = DIMS
    gap |= two == _GAP
    dims[1][gap] = DIMS
    gap |= three == _GAP
    dims[2][gap] = DIMS
    return dims, np.asarray(starts)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and shares of a text's n-grams."""
    total = np.zeros(DIMS + 1)
    for _, parts in text_chunks([text]):
        dims, _ = _ngrams(parts)
        total += np.bincount(dims.ravel(), minlength=DIMS + 1)
    total[DIMS] = 0
    at = np.flatnonzero(total)
    return at, total[at] / max(1.0, total.sum())


# --- machines -----------------------------------------------------------------------------

@dataclass
class Machine:
    """A linear SVM; a positive margin speaks for ``one``."""
    one: str
    other: str
    weights: np.ndarray
    bias: float
    slope: float


def train_svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, epochs: int = 12,
              seed: int = 1) -> tuple[np.ndarray, float]:
    """L2-loss linear SVM by dual coordinate descent.  Features are scaled to unit order."""
    scale = 1.0 / np.sqrt(np.mean([v @ v for _, v in x]))
    x = [(i, v * scale) for i, v in x]
    w, bias, rng = np.zeros(DIMS + 1), 0.0, np.random.default_rng(seed)
    alpha, diag = np.zeros(len(x)), 0.5 / cost
    norm = np.asarray([v @ v + 1.0 + diag for _, v in x])
    for _ in range(epochs):
        for k in rng.permutation(len(x)):
            at, v = x[k]
            g = y[k] * (w[at] @ v + bias) - 1 + diag * alpha[k]
            new = max(0.0, alpha[k] - g / norm[k])
            if new != alpha[k]:
                d = (new - alpha[k]) * y[k]
                w[at] += d * v
                bias += d
                alpha[k] = new
    return w * scale, bias


def _slope(margins: np.ndarray, y: np.ndarray) -> float:
    """Slope of the logistic curve through 0 that fits the margins best."""
    grid = np.geomspace(0.5, 16, 24)
    loss = [np.logaddexp(0, -s * np.clip(y * margins, -4, 4)).mean() for s in grid]
    return float(grid[int(np.argmin(loss))])


def _machine(one: str, other: str, rows: list[tuple[str, tuple]]) -> Machine:
    x = [f for _, f in rows]
    y = np.asarray([1.0 if c == one else -1.0 for c, _ in rows])
    w, b = train_svm(x, y)
    margins = np.asarray([w[at] @ v + b for at, v in x])
    return Machine(one, other, w.astype(np.float32), b, _slope(margins, y))


@dataclass
class LanguageModel:
    languages: list[str]
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]

    @staticmethod
    def train(rows: list[tuple[str, tuple]]) -> "LanguageModel":
        """``rows``: (language, features)."""
        languages = sorted({lang for lang, _ in rows})
        families: dict[str, list[str]] = {}
        for lang in languages:
            families.setdefault(family_of(lang), []).append(lang)
        by_family = [(family_of(lang), f) for lang, f in rows]

        def machines(classes, labelled):
            return [_machine(a, b, [r for r in labelled if r[0] in (a, b)])
                    for a, b in itertools.combinations(sorted(classes), 2)]

        return LanguageModel(languages, families, machines(families, by_family),
                             {f: machines(langs, rows) for f, langs in families.items()})

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        all_machines = self.between + [m for ms in self.within.values() for m in ms]
        known = np.asarray([has_letter(t) for t in texts], bool)
        if not self.languages:
            known[:] = False
        rows = np.flatnonzero(known)
        sums, n = np.zeros((len(all_machines), len(rows))), np.zeros(len(rows))
        weights = np.stack([m.weights for m in all_machines]) if all_machines else None
        if weights is not None:
            weights[:, DIMS] = 0
            for at, parts in text_chunks([texts[i] for i in rows], overlap=2):
                dims, starts = _ngrams(parts)
                np.add.at(n, at, np.add.reduceat((dims != DIMS).sum(0), starts))
                for m, w in enumerate(weights):
                    np.add.at(sums[m], at, np.add.reduceat(w[dims].sum(0), starts))
            sums = sums / np.maximum(n, 1) + np.asarray([m.bias for m in all_machines])[:, None]
        margin = {id(m): sums[k] for k, m in enumerate(all_machines)}
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        for k, row in enumerate(rows):
            family, p = self._winner(sorted(self.families), self.between, margin, k)
            labels[row], q = self._winner(self.families[family], self.within[family], margin, k)
            scores[row] = p * q
        return labels, scores

    @staticmethod
    def _winner(classes, machines, margin, k) -> tuple[str, float]:
        if not machines:
            return classes[0], 1.0
        votes, sure, least = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0), dict.fromkeys(classes, 1.0)
        for m in machines:
            x = margin[id(m)][k]
            p = 1 / (1 + np.exp(-m.slope * np.clip(x, -40, 40)))
            votes[m.one if x >= 0 else m.other] += 1
            sure[m.one] += x
            sure[m.other] -= x
            least[m.one], least[m.other] = min(least[m.one], p), min(least[m.other], 1 - p)
        best = max(sorted(classes), key=lambda c: (votes[c], sure[c]))
        return best, float(least[best])


# --- operator -----------------------------------------------------------------------------

def learn(docs: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from at most ``sample_rows`` rows of ``docs`` that are ``usable`` and have a
    language, the same number of each language, those of the lowest hash of the id."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "text")
    labelled = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()    # a row per language
    if not counts:
        return LanguageModel([], {}, [], {})
    per_lang = max(20, sample_rows // len(counts))
    # Ids beyond these hashes can't be among the lowest: what is ranked is bounded, however often
    # an id is repeated.
    bound = F.lit(None).cast("long")
    for r in counts:
        bound = F.when(F.col("lang") == r["lang"], lowest_hashes(r["n"], per_lang)).otherwise(bound)
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = labelled.where(F.col("h") <= bound).distinct().withColumn("r", F.row_number().over(first)) \
        .where(F.col("r") <= per_lang).select(F.col("doc_id").alias("picked"), F.col("lang").alias("as_lang"))

    @F.pandas_udf("at binary, share binary")
    def ngram_shares(texts: pd.Series) -> pd.DataFrame:
        found = [features(t) if has_letter(t) else (np.zeros(0, np.int64), np.zeros(0)) for t in texts]
        return pd.DataFrame({"at": [a.astype(np.int32).tobytes() for a, _ in found], "share": [v.tobytes() for _, v in found]})

    # At most sample_rows ids: a broadcast of bounded size.  Of rows with the same id and language
    # one is learned from, that of the lowest hash of the text.  One task trains on them, so the
    # driver only gets the model.
    rows = docs.join(F.broadcast(picked), (F.col("doc_id") == F.col("picked")) & (F.col("lang") == F.col("as_lang"))) \
        .groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")) \
        .select("doc_id", "lang", ngram_shares("t.text").alias("f")).select(F.lit(0).alias("all"), "doc_id", "lang", "f.at", "f.share")
    trained = rows.groupBy("all").applyInArrow(_trained, "model binary").first()
    return pickle.loads(trained["model"]) if trained else LanguageModel([], {}, [], {})


def _trained(rows: pa.Table) -> pa.Table:
    at, share = (rows[c].combine_chunks() for c in ("at", "share"))
    order = sorted(zip(rows["lang"].to_pylist(), rows["doc_id"].to_pylist(), range(rows.num_rows)))
    learned = [(lang, (np.frombuffer(at[k].as_buffer(), np.int32), np.frombuffer(share[k].as_buffer(), np.float64)))
               for lang, _, k in order if at[k].as_buffer().size]
    return pa.table({"model": pa.array([pickle.dumps(LanguageModel.train(learned))], pa.binary())})


def predict(docs: DataFrame, model: LanguageModel, out: str = "lang_id") -> DataFrame:
    """``docs`` with a struct ``out`` of lang_pred and score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def lang_id(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            labels, scores = shared.value.predict(list(texts))
            yield pd.DataFrame({"lang_pred": labels, "score": scores})

    return docs.withColumn(out, lang_id("text"))
