"""Language-model scoring with a weighted backoff automaton of order three.

States are contexts: the two words before, the word before, and the empty context (a text starts
in the state of its end token, as if another text had just ended).  A seen n-gram is an arc from
the state of its context, weighted with the smoothed log-probability of its last word.  Every
state has a failure arc to the state of its shorter context, weighted with the log of its backoff
mass; the empty context has an arc for every token.  A text is traversed once from left to right:
from the state it is in, failure arcs are followed until a state has an arc for the token; the
weights on the way add up, and the arc leads to the longest seen context that the token ends.

Smoothing: p(w) is the smoothed share of w among all tokens.  A state whose context h was seen
c(h) times keeps 1 - back(h) for what followed it, and leaves the share
    back(h) = (MU + FLOOR * c(h)) / (MU + c(h))
to the shorter context h' (MU and FLOOR by the length of h):
    P(w | h) = (1 - back(h)) * c(h, w) / c(h) + back(h) * P(w | h').
It sums to one over known tokens and one unknown token.  The discount needs the count of a context
only, not the number of words that follow it, so a very frequent context is one entry.

The automaton has about as many arcs as the corpus has different n-grams, so no task holds it.
Blocks of documents ask for the counts of their own distinct words, pairs and triples, a request
per range of hashes; there the counts of all training documents are added up and sent back (only
what other blocks add to a block's own count); each block then has the part of the automaton
that its texts can reach.  The number of blocks and ranges follows from the bytes of text.
Everything is one Spark plan that shuffles the texts once.

Tokens: A-Z in lower case, split at space and U+0009 to U+000D, then one end token per text.
Words are told apart by 64-bit hashes, pairs and triples by 38 bits within a range of about 5 million.

Defined cases: null text counts as empty (the end token only); with no training text every
count is 0; repeated rows count as often as they occur; ids play no part in scores; an empty
table gives no rows; other columns are ignored.  ``docs`` must be a stored table (its rows come
in the same order again when a task is repeated).
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import recompression
from .common import shuffle_partitions
from .recompression import named

#: Weight of backing off from one word to the empty context, and from two words to one: for rare
#: contexts, in counts, and for frequent ones.  Chosen on a fifth of the training texts.
MU, FLOOR = (60.0, 0.3), (0.7, 0.3)
#: Bytes of text of a block, and of the text that asks one range of hashes.
BLOCK_BYTES, RANGE_BYTES = 8 << 20, 24 << 20
#: Blocks and ranges of small inputs stand for at least this much text.
LEAST_BYTES = 1 << 18
#: A task works on this many blocks, or ranges, one after the other.
BLOCKS_OF_A_TASK, RANGES_OF_A_TASK = 8, 2
#: Tokens that are traversed one after the other.
SEGMENT = 512

_END = np.uint64(0x51A7E0FACADE0001)               # the end token's hash
_GRAM_BITS = np.uint64(38)                         # of an n-gram's hash, beside its range
_GRAM_MASK = np.uint64((1 << 38) - 1)


def packed(keys: np.ndarray) -> bytes:
    """Ascending whole numbers as gaps of as few bytes as most of them need, longer gaps apart."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    mean = max(1.0, float(keys[-1]) / len(keys)) if len(keys) else 1.0
    width = min(range(1, 6), key=lambda w: w + 8 * math.exp(-2.0 ** (8 * w) / mean))
    mark = np.uint64((1 << 8 * width) - 1)
    short = np.minimum(gaps, mark).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + len(keys).to_bytes(4, "little") + short.tobytes() + gaps[gaps >= mark].astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width, n = data[0], int.from_bytes(data[1:5], "little")
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8, n * width, 5).reshape(-1, width)
    gaps = wide.view("<u8").ravel()
    gaps[gaps == np.uint64((1 << 8 * width) - 1)] = np.frombuffer(data[5 + n * width:], "<u8")
    return np.cumsum(gaps)


def coded(counts: np.ndarray) -> bytes:
    """Counts, most of them small, as compressed bytes; 255 and more apart."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return len(small).to_bytes(4, "little") + zlib.compress(small.tobytes() + counts[counts >= 255].astype("<i8").tobytes(), 1)


def uncoded(data: bytes) -> np.ndarray:
    n, raw = int.from_bytes(data[:4], "little"), zlib.decompress(data[4:])
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[n:], "<i8")
    return counts


class Block:
    """Distinct words and n-grams of a block's texts, in the order of their ranges."""

    def __init__(self, docs: pa.Table, n_ranges: int):
        w = recompression.Block(docs, 1, fold=True)
        self.lengths = w.lengths + 1
        self.first = np.cumsum(self.lengths) - self.lengths
        hashes = np.full(int(self.lengths.sum()), _END)
        hashes[np.arange(len(w.name)) + w.doc] = w.name
        words, token = np.unique(hashes, return_inverse=True)
        order = np.argsort(words % np.uint64(n_ranges), kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.words, self.token = words[order], place[token]
        self.word_at = np.searchsorted(self.words % np.uint64(n_ranges), np.arange(n_ranges + 1, dtype=np.uint64))
        before = np.empty_like(hashes)
        before[1:], before[self.first] = hashes[:-1], _END
        pair = named(before, hashes, 2)
        triple = named(np.concatenate([pair[:1], pair[:-1]]), hashes, 3)
        triple[self.first] = pair[self.first]            # a text's first token has one word before it, the end
        grams, gram = np.unique(self._keys(np.concatenate([pair, triple]), n_ranges), return_inverse=True)
        self.grams, self.gram_at = grams, np.searchsorted(grams >> _GRAM_BITS, np.arange(n_ranges + 1, dtype=np.uint64))
        self.pair, self.triple = gram[:len(pair)], gram[len(pair):]
        self.has_triple = np.ones(len(pair), dtype=bool)
        self.has_triple[self.first] = False

    @staticmethod
    def _keys(hashes: np.ndarray, n_ranges: int) -> np.ndarray:
        return ((hashes >> _GRAM_BITS) % np.uint64(n_ranges)) << _GRAM_BITS | hashes & _GRAM_MASK

    def training(self, in_training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words and n-grams in the texts that are learned from."""
        own = np.repeat(in_training, self.lengths)
        grams = np.concatenate([self.pair[own], self.triple[own & self.has_triple]])
        return np.bincount(self.token[own], minlength=len(self.words)), np.bincount(grams, minlength=len(self.grams))

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else values[:0]


_REQUEST = "range int, block long, words binary, word_counts binary, grams binary, gram_counts binary"
_ANSWER = "block long, range int, words binary, grams binary, n_tokens long, n_words long"


def _requests(n_ranges: int):
    def ask(docs: pa.Table) -> pa.Table:
        b = Block(docs, n_ranges)
        words, grams = b.training(docs.column("in_training").to_numpy().astype(bool))
        asked = np.flatnonzero(np.diff(b.word_at) + np.diff(b.gram_at))

        def cut(made, values, at):
            return pa.array([made(values[at[k]:at[k + 1]]) for k in asked], pa.binary())

        return pa.table({
            "range": pa.array(asked, pa.int32()), "block": pa.array([docs.column("block")[0].as_py()] * len(asked), pa.int64()),
            "words": cut(np.ndarray.tobytes, b.words, b.word_at), "word_counts": cut(coded, words, b.word_at),
            "grams": cut(packed, b.grams & _GRAM_MASK, b.gram_at), "gram_counts": cut(coded, grams, b.gram_at)})
    return ask


def _added(keys: list[np.ndarray], counts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """What the other requests add to each request's counts, and the totals of all keys."""
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    own = np.concatenate([uncoded(c) for c in counts])
    totals = np.bincount(at, weights=own, minlength=len(distinct)).astype(np.int64)
    more = totals[at] - own
    ends = np.cumsum([0, *map(len, keys)])
    return [coded(more[lo:hi]) for lo, hi in zip(ends, ends[1:])], totals


def _answers(requests: pa.Table) -> pa.Table:
    col = {c: requests.column(c).to_pylist() for c in ("words", "word_counts", "grams", "gram_counts")}
    words, totals = _added([np.frombuffer(k, np.uint64) for k in col["words"]], col["word_counts"])
    grams, _ = _added([unpacked(k) for k in col["grams"]], col["gram_counts"])
    n = requests.num_rows
    return pa.table({
        "block": requests.column("block"), "range": requests.column("range"),
        "words": pa.array(words, pa.binary()), "grams": pa.array(grams, pa.binary()),
        "n_tokens": pa.array([int(totals.sum())] * n, pa.int64()),
        "n_words": pa.array([int((totals > 0).sum())] * n, pa.int64())})


class Automaton:
    """The part of the automaton that a block's texts can reach."""

    def __init__(self, block: Block, words: np.ndarray, grams: np.ndarray, n_tokens: int, n_words: int,
                 mu: tuple[float, float], floor: tuple[float, float]):
        self.block, self.words, self.grams = block, words, grams
        share = (words + 0.5) / (n_tokens + 0.5 * (n_words + 1))
        self.empty_arc = np.log10(share)
        # States of one word (by word) and of two (by pair): what they leave to the shorter context.
        back_1 = (mu[0] + floor[0] * words) / (mu[0] + words)
        back_2 = (mu[1] + floor[1] * grams) / (mu[1] + grams)
        self.failure_1, self.failure_2 = np.log10(back_1), np.log10(back_2)
        token, pair, triple = block.token, block.pair, block.triple
        before = np.empty_like(token)                    # the word before, or the end
        end = int(np.flatnonzero(block.words == _END)[0]) if len(token) else 0
        before[1:] = token[:-1]
        before[block.first] = end
        two = np.concatenate([pair[:1], pair[:-1]])      # the pair before
        p = (1 - back_1[before]) * grams[pair] / np.maximum(words[before], 1) + back_1[before] * share[token]
        p = np.where(words[before] > 0, p, share[token])
        q = (1 - back_2[two]) * grams[triple] / np.maximum(grams[two], 1) + back_2[two] * p
        # Arcs by place, as every place of an n-gram gives the same weight.
        self.arc_1, self.arc_2 = np.log10(p), np.log10(q)
        self.start = end

    def scores(self) -> np.ndarray:
        """Log-probability of each text.  Segments of texts are traversed side by side, each from the
        state that the tokens before it lead to."""
        b, out = self.block, np.zeros(len(self.block.token))
        lo = np.concatenate([np.arange(f, f + n, SEGMENT) for f, n in zip(b.first, b.lengths)] or [np.zeros(0, int)])
        text_end = np.repeat(b.first + b.lengths, -(-b.lengths // SEGMENT))
        size = np.minimum(lo + SEGMENT, text_end) - lo
        order = np.argsort(-size, kind="stable")
        at, size = lo[order], size[order]
        fresh = ~b.has_triple[at]                        # segments that begin a text
        one = np.where(fresh, self.start, b.token[at - 1])
        two = np.where(fresh, -1, b.pair[at - 1])
        one, two = self._seen(one, two)
        for step in range(size.max(initial=0)):
            n = int(np.searchsorted(-size, -step, side="left"))      # segments with a token left
            place, one, two = at[:n] + step, one[:n], two[:n]
            pair, triple = b.pair[place], b.triple[place]
            arc_2 = (two >= 0) & (self.grams[triple] > 0)
            arc_1 = (one >= 0) & (self.grams[pair] > 0)
            low = np.where(arc_1, self.arc_1[place], np.where(one >= 0, self.failure_1[one], 0) + self.empty_arc[b.token[place]])
            out[place] = np.where(arc_2, self.arc_2[place], np.where(two >= 0, self.failure_2[two], 0) + low)
            one, two = self._seen(b.token[place], pair)
        return b.sums(out)

    def _seen(self, word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a token: those of contexts that were seen in training, else -1."""
        return np.where(self.words[word] > 0, word, -1), np.where((pair >= 0) & (self.grams[pair] > 0), pair, -1)


def _scorer(n_ranges: int, mu, floor):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.sort_by("row")
        b = Block(docs, n_ranges)
        words, grams = b.training(docs.column("in_training").to_numpy().astype(bool))
        for r in answers.to_pylist():
            k = r["range"]
            words[b.word_at[k]:b.word_at[k + 1]] += uncoded(r["words"])
            grams[b.gram_at[k]:b.gram_at[k + 1]] += uncoded(r["grams"])
        n_tokens, n_words = answers.column("all_tokens")[0].as_py(), answers.column("all_words")[0].as_py()
        model = Automaton(b, words, grams, n_tokens, n_words, mu, floor)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(b.lengths, pa.int64()),
            "n_known": pa.array(b.sums((words > 0)[b.token].astype(np.int64)), pa.int64()),
            "train_tokens": pa.array([n_tokens] * docs.num_rows, pa.int64()),
            "base_score": pa.array(b.sums(model.empty_arc[b.token]), pa.float64()),
            "score": pa.array(model.scores(), pa.float64())})
    return score


def score(docs: DataFrame, held_out: Column, mu: tuple[float, float] = MU, floor: tuple[float, float] = FLOOR,
          block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text;
    learned from the texts that are not ``held_out``."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    partitions = shuffle_partitions(docs.sparkSession)
    parts = min(partitions, -(-size // LEAST_BYTES))
    n_blocks, n_ranges = max(1, parts, -(-size // block_bytes)), max(1, parts, -(-size // range_bytes))
    held = F.coalesce(held_out, F.lit(False))
    # Used twice: the plan shuffles the texts once and reads that exchange for both.
    blocks = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text"),
                         held.alias("held_out"), (~held).alias("in_training")) \
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("long")) \
        .repartition(max(partitions, -(-n_blocks // BLOCKS_OF_A_TASK)), "block")
    asked = blocks.groupBy("block").applyInArrow(_requests(n_ranges), _REQUEST) \
        .repartition(max(partitions, -(-n_ranges // RANGES_OF_A_TASK)), "range")
    answers = asked.groupBy("range").applyInArrow(_answers, _ANSWER)
    # One row: tokens and different words of all training texts.
    totals = answers.groupBy("range").agg(F.max("n_tokens").alias("t"), F.max("n_words").alias("w")) \
        .agg(F.sum("t").alias("all_tokens"), F.sum("w").alias("all_words"), (F.min("range") * 0).alias("same"))
    answers = answers.withColumn("same", F.col("range") * 0).join(F.broadcast(totals), "same")
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, "
              "n_known long, train_tokens long, base_score double, score double")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scorer(n_ranges, mu, floor), schema)
