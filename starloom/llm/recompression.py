"""Removal of passages that repeat across documents, found by recompression.

Words are symbols.  One round names maximal runs of a word, the following rounds split all
symbols into left and right ones (a bit of their name) and name every pair of a left symbol
followed by a right one.  A name is a hash of what it stands for, so all tasks give equal runs
and pairs equal names, and a substring gets the same symbols wherever it stands, but for those
at its two ends that context may pair otherwise.  For every window of words the ends that are
not sure are taken off, round by round; the symbols of the last round that has any left depend
on the window's words alone.  They are its key.

Neighbouring windows share keys, so there are far fewer keys than windows, and a key of a few
words that one document alone holds rules all its windows out.  Two exchanges follow:

1. reveal: blocks of documents send their distinct keys, 5 bytes each, to buckets of keys, and
   get back a bit per key: whether another block has it;
2. verify: windows of shared keys are named whole (names of pairs of pairs, 96 bits) and sent
   with the smallest doc_id of the block that holds them; the answer is a bit per name: whether
   a smaller doc_id holds it elsewhere.  Which windows they are goes along, a bit per window.

A block sends a key or name once, however often it holds it, so a passage that stands in a
third of all documents is a few rows.  Blocks are dealt by row, so copies of one row spread.
The number of blocks and buckets follows from the bytes of text, and the memory of a task with
them.  One plan shuffles the texts once and reads that exchange for all three uses.

Two different windows are taken for equal only if 96-bit hashes agree: below 1e-9 for all
windows of 1 TB of text.

Defined cases: a null text has no words; a document with fewer words than a window keeps all;
rows of equal doc_id never remove words from each other; a null doc_id neither loses words nor
takes any from others; repeated rows are returned each; an empty table has no rows; other
columns are ignored.  ``docs`` must be a stored table (its rows come in the same order again
when a task is repeated).
"""
from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions

#: Words of a window.
WINDOW = 13
#: Rounds of pairing after the round of runs.
ROUNDS = 6
#: Bytes of text of a block, and of the text that sends its keys to one bucket.
BLOCK_BYTES, BUCKET_BYTES = 6 << 20, 24 << 20
#: A task works on this many blocks, one after the other.
BLOCKS_OF_A_TASK = 8
#: Blocks and buckets of small inputs hold at least this much text.
LEAST_BYTES = 1 << 18

_KEY_BYTES = 5
_KEY_MASK = np.uint64((1 << 8 * _KEY_BYTES) - 1)
_KEY_BITS = np.uint64(8 * _KEY_BYTES)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit numbers (multiply and shift, odd constants)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA5CB3A1D2F8E4B67)
    return x ^ (x >> np.uint64(32))


def named(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Names of pairs."""
    return _mixed(a * np.uint64(0x9FB21C651E98DF25) + _mixed(b + np.uint64(salt)))


# White space between words.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLDED = np.frombuffer(bytes(range(256)).lower(), np.uint8)


#: Words are hashed in stretches of so many bytes; longer words than _LONG go to xxhash.
_STRETCH, _LONG = 1 << 17, 64


class _WordHash:
    """64-bit hashes of all words of a byte array at once: a word is a polynomial in an odd base,
    with a random number for each byte value as coefficient, taken from running sums."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of_byte = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 62)) * 8 + 3
        self.power, self.inverse = (np.full(_STRETCH, b % (1 << 64), dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for p in (self.power, self.inverse):
            p[0] = 1
            np.multiply.accumulate(p, out=p)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, length = np.zeros(len(start), np.uint64), end - start
        k = 0
        while k < len(start):
            m = max(k + 1, int(np.searchsorted(end, start[k] + _STRETCH, side="right")))
            a, b = start[k:m] - start[k], end[k:m] - start[k]
            if b[-1] <= _STRETCH:
                sums = np.zeros(b[-1] + 1, np.uint64)
                np.cumsum(self.of_byte[data[start[k]:end[m - 1]]] * self.power[:b[-1]], out=sums[1:])
                out[k:m] = (sums[b] - sums[a]) * self.inverse[a]
            k = m
        out = _mixed(out + length.astype(np.uint64) * self.of_byte[0])
        for k in np.flatnonzero(length > _LONG):
            out[k] = xxhash.xxh3_64_intdigest(data[start[k]:end[k]].tobytes(), seed=int(self.of_byte[1]))
        return out


_HASHES = functools.cache(lambda lane: _WordHash(131 + lane))


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of a text's words, in their order, and where they start."""
    data = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8))
    start = np.flatnonzero(edge == -1)
    return _HASHES(0)(data, start, np.flatnonzero(edge == 1)), start


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1,
                                       [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class Block:
    """The documents of a block as one row of word names."""

    def __init__(self, docs: pa.Table, window: int, fold: bool = False):
        self.window, self.n_docs = window, docs.num_rows
        text = pa.concat_arrays(pc.fill_null(docs.column("text"), b"").cast(pa.binary()).chunks)
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int32)[text.offset:text.offset + self.n_docs + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.zeros(0, np.uint8)
        data = _FOLDED[data] if fold else data           # A-Z in lower case
        self.data, self.offsets = data, (offsets - offsets[0]).astype(np.int64)
        ids = docs.column("doc_id")
        self.has_id, self.doc_ids = ids.is_valid().to_numpy(), pc.fill_null(ids, 0).to_numpy()
        # A word starts after white space or where a document starts, and ends alike.
        self.space = _SPACE[data]
        start, end = ~self.space, ~self.space
        start[1:] &= self.space[:-1]
        end[:-1] &= self.space[1:]
        border = self.offsets[1:-1]
        first, last = border[border < len(data)], border[border > 0] - 1
        start[first] = ~self.space[first]
        end[last] = ~self.space[last]
        self.word_start, self.word_end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.starts = np.searchsorted(self.word_start, self.offsets)      # each document's first word
        self.lengths = np.diff(self.starts)
        n = len(self.word_start)
        self.name = self.word_names(0)
        self.doc = np.repeat(np.arange(self.n_docs, dtype=np.int32), self.lengths)
        # Where windows start: within one document.
        first = np.arange(max(0, n - window + 1), dtype=np.int32)
        self.at = first[self.doc[:len(first)] == self.doc[window - 1:]] if len(first) else first

    def word_names(self, lane: int) -> np.ndarray:
        return _HASHES(lane)(self.data, self.word_start, self.word_end)

    def kept(self, gone: np.ndarray) -> pa.Array:
        """Each document's words that are not ``gone``, joined by one space."""
        stay = np.flatnonzero(~gone)
        followed = np.zeros(len(stay), dtype=bool)       # by another word that stays
        followed[:-1] = self.doc[stay[1:]] == self.doc[stay[:-1]]
        edge = np.zeros(len(self.data) + 1, dtype=np.int8)
        edge[self.word_start[stay]] += 1
        edge[self.word_end[stay] + followed] -= 1        # with the white space after the word
        mask = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        return _binary(np.concatenate([[0], np.cumsum(mask)])[self.offsets], np.where(self.space, 0x20, self.data).astype(np.uint8)[mask])

    def keys(self) -> np.ndarray:
        """Each window's key: the outermost of the symbols that its words alone settle."""
        key = np.zeros(len(self.at), dtype=np.uint64)
        todo = np.arange(len(self.at))
        symbol, doc = self.name, self.doc
        low, high = self.at, self.at + self.window       # the settled symbols of each window
        for r in range(ROUNDS + 1):
            if not len(todo):
                return key
            new = np.ones(len(symbol), dtype=bool)       # symbols that start one of the next round
            if r == 0:
                new[1:] = (symbol[1:] != symbol[:-1]) | (doc[1:] != doc[:-1])
                place = np.cumsum(new, dtype=np.int32) - 1
                size = np.diff(np.append(np.flatnonzero(new), len(symbol)))
                following = symbol[new]
                runs = size > 1
                following[runs] = named(following[runs], size[runs].astype(np.uint64), 0)
                # The runs at both ends can go on outside.
                next_low, next_high = place[low] + 1, place[high - 1]
            else:
                right = (_mixed(symbol + np.uint64(r)) >> np.uint64(63)).astype(bool)
                pair = np.flatnonzero(~right[:-1] & right[1:] & (doc[1:] == doc[:-1]))
                new[pair + 1] = False
                place = np.cumsum(new, dtype=np.int32) - 1
                following = symbol[new]
                following[place[pair]] = named(symbol[pair], symbol[pair + 1], r)
                # A right symbol at the left end, or a left one at the right end, can pair outside.
                next_low, next_high = low + right[low], high - ~right[high - 1]
            done = next_low >= next_high
            key[todo[done]] = named(symbol[low[done]], symbol[high[done] - 1], 64)
            todo, low, high = todo[~done], next_low[~done], next_high[~done]
            if r:
                low, high = place[low], place[high - 1] + 1
            symbol, doc = following, doc[new]
        key[todo] = named(symbol[low], symbol[high - 1], 64)
        return key

    def names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of the windows that start at ``at``, 64 and 32 bits."""
        out = []
        for lane, name in enumerate((self.name, self.word_names(1))):
            span = 1
            while 2 * span <= self.window:               # name[i]: the span words from i on
                name = named(name[:-span], name[span:], 128 + 2 * span + lane)
                span *= 2
            out.append(named(name[at], name[at + self.window - span], 256 + lane))
        return out[0], out[1].astype(np.uint32)

    def distinct_keys(self, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys in order of their buckets, where each bucket starts, and each window's key."""
        key = self.keys()
        keys, of = np.unique(((key >> _KEY_BITS) % np.uint64(n_buckets)) << _KEY_BITS | key & _KEY_MASK, return_inverse=True)
        return keys, np.searchsorted(keys >> _KEY_BITS, np.arange(n_buckets + 1, dtype=np.uint64)), of


def suspects(block: Block, n_buckets: int, answers: dict) -> np.ndarray:
    """Which windows have a key that another document shares."""
    keys, at, of = block.distinct_keys(n_buckets)
    shared = np.zeros(len(keys), dtype=bool)
    for bucket, bits in answers.items():
        lo, hi = at[bucket], at[bucket + 1]
        shared[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
    doc = block.doc[block.at]
    first, last = np.full(len(keys), block.n_docs), np.full(len(keys), -1)
    np.minimum.at(first, of, doc)
    np.maximum.at(last, of, doc)
    shared |= first < last
    return shared[of] & block.has_id[doc]


class Names:
    """The suspect windows of a block, one row per distinct name."""

    def __init__(self, block: Block, suspect: np.ndarray, n_buckets: int):
        self.at = block.at[suspect]
        self.doc_id = block.doc_ids[block.doc[self.at]]
        long_name, short_name = block.names(self.at)
        order = np.lexsort((self.doc_id, short_name, long_name))
        a, b, i = long_name[order], short_name[order], self.doc_id[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b, i = a[new], b[new], i[new]                 # the smallest doc_id of each name
        bucket = a % np.uint64(n_buckets)
        sent = np.lexsort((b, a, i, bucket))
        self.long_name, self.short_name, self.least = a[sent], b[sent], i[sent]
        self.bucket_at = np.searchsorted(bucket[sent], np.arange(n_buckets + 1, dtype=np.uint64))
        place = np.empty(len(sent), dtype=np.int64)
        place[sent] = np.arange(len(sent))
        self.of = np.empty(len(order), dtype=np.int64)   # each window's row
        self.of[order] = place[np.cumsum(new) - 1]

    def repeats(self, answers: dict) -> np.ndarray:
        """Starts of the windows that a document with a smaller doc_id holds."""
        elsewhere = np.zeros(len(self.least), dtype=bool)
        for bucket, bits in answers.items():
            lo, hi = self.bucket_at[bucket], self.bucket_at[bucket + 1]
            elsewhere[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo)
        return self.at[elsewhere[self.of] | (self.doc_id > self.least[self.of])]


def _answered(answers: pa.Table, kind: int) -> dict:
    rows = answers.filter(pc.equal(answers.column("kind"), kind))
    return dict(zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()))


# What an answer's bits are about: distinct keys, distinct names, windows.
_OF_KEYS, _OF_NAMES, _OF_WINDOWS = 1, 2, 3
_KEYS = "block long, bucket int, keys binary"
_NAMES = "block long, bucket int, long_names binary, short_names binary, least binary"
_ANSWER = "kind int, block long, bucket int, bits binary"


def _rows(docs: pa.Table, at: np.ndarray, **columns) -> pa.Table:
    """A row per bucket that gets something: the bytes of its part of every column."""
    filled = np.flatnonzero(np.diff(at))
    block = docs.column("block")[0].as_py()
    return pa.table({
        "block": pa.array([block] * len(filled), pa.int64()), "bucket": pa.array(filled, pa.int32()),
        **{c: pa.array([v[at[k]:at[k + 1]].tobytes() for k in filled], pa.binary()) for c, v in columns.items()}})


def _send_keys(window: int, n_buckets: int):
    def send(docs: pa.Table) -> pa.Table:
        keys, at, _ = Block(docs, window).distinct_keys(n_buckets)
        return _rows(docs, at, keys=np.ascontiguousarray((keys & _KEY_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES]))
    return send


def _answers(requests: pa.Table, kind: int, sizes: list[int], bits: np.ndarray) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    return pa.table({
        "kind": pa.array([kind] * requests.num_rows, pa.int32()), "block": requests.column("block"),
        "bucket": requests.column("bucket"),
        "bits": pa.array([np.packbits(bits[lo:hi]).tobytes() for lo, hi in zip(ends, ends[1:])], pa.binary())})


def _share_keys(requests: pa.Table) -> pa.Table:
    """Whether another block sent the key."""
    parts = requests.column("keys").to_pylist()
    sent = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, _KEY_BYTES)
    wide = np.zeros((len(sent), 8), dtype=np.uint8)
    wide[:, :_KEY_BYTES] = sent
    _, of, count = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    return _answers(requests, _OF_KEYS, [len(p) // _KEY_BYTES for p in parts], count[of] > 1)


def _send_names(window: int, n_buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        b, block = Block(docs.sort_by("row"), window), docs.column("block")[0].as_py()
        suspect = suspects(b, n_buckets, _answered(answers, _OF_KEYS))
        s = Names(b, suspect, n_buckets)
        rows = _rows(docs, s.bucket_at, long_names=s.long_name, short_names=s.short_name, least=s.least)
        # Which windows these are goes along, in buckets past those of names, to where words are removed.
        return pa.concat_tables([rows, pa.table({
            "block": pa.array([block], pa.int64()), "bucket": pa.array([n_buckets + block % n_buckets], pa.int32()),
            "long_names": pa.array([np.packbits(suspect).tobytes()], pa.binary()),
            "short_names": pa.array([b""], pa.binary()), "least": pa.array([b""], pa.binary())})])
    return send


def _share_names(n_buckets: int):
    """Whether a smaller doc_id came with the same name."""
    def share(requests: pa.Table) -> pa.Table:
        n = requests.num_rows
        if requests.column("bucket")[0].as_py() >= n_buckets:
            return pa.table({"kind": pa.array([_OF_WINDOWS] * n, pa.int32()), "block": requests.column("block"),
                             "bucket": requests.column("bucket"), "bits": requests.column("long_names")})
        parts = requests.column("least").to_pylist()
        a, b, i = (np.frombuffer(b"".join(requests.column(c).to_pylist()), kind)
                   for c, kind in (("long_names", np.uint64), ("short_names", np.uint32), ("least", np.int64)))
        order = np.lexsort((i, b, a))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        least = i[order][new][np.cumsum(new) - 1]
        smaller = np.empty(len(order), dtype=bool)
        smaller[order] = least < i[order]
        return _answers(requests, _OF_NAMES, [len(p) // 8 for p in parts], smaller)
    return share


_RESULT = "doc_id long, n_words long, n_removed long, kept binary, removed array<struct<start:long,stop:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])


def _remove(window: int, n_buckets: int):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.sort_by("row")
        b = Block(docs, window)
        bits, = _answered(answers, _OF_WINDOWS).values()
        suspect = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(b.at)).astype(bool)
        at = Names(b, suspect, n_buckets).repeats(_answered(answers, _OF_NAMES))
        edge = np.zeros(int(b.starts[-1]) + 1, dtype=np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
        gone = np.cumsum(edge)[:-1] > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        n_removed = before[b.starts[1:]] - before[b.starts[:-1]]
        inner = np.ones(len(gone), dtype=bool)           # a span never goes on into the next document
        inner[b.starts[:-1][b.lengths > 0]] = False
        start = np.flatnonzero(gone & ~(np.concatenate([[False], gone[:-1]]) & inner))
        ends = np.ones(len(gone), dtype=bool)
        ends[:-1] = ~gone[1:] | ~inner[1:]
        stop = np.flatnonzero(gone & ends) + 1
        own = b.starts[b.doc[start]] if len(start) else start
        spans = pa.StructArray.from_arrays([pa.array(start - own, pa.int64()), pa.array(stop - own, pa.int64())], fields=list(_SPAN))
        offsets = np.searchsorted(start, b.starts).astype(np.int32)
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_words": pa.array(b.lengths, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept": b.kept(gone),
            "removed": pa.ListArray.from_arrays(pa.array(offsets), spans)})
    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) and removed
    (spans of words) of every document, without the words that a window covers whose words also
    start in a document with a smaller doc_id."""
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    parts = min(shuffle_partitions(docs.sparkSession), -(-size // LEAST_BYTES))
    n_blocks = max(1, parts, -(-size // block_bytes))
    n_buckets = max(1, parts, -(-size // bucket_bytes))
    n_tasks = max(shuffle_partitions(docs.sparkSession), -(-n_blocks // BLOCKS_OF_A_TASK))
    dealt = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("binary").alias("text")) \
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("long")).repartition(n_tasks, "block")
    keys = dealt.groupBy("block").applyInArrow(_send_keys(window, n_buckets), _KEYS)
    shared = keys.groupBy("bucket").applyInArrow(_share_keys, _ANSWER)
    names = dealt.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_names(window, n_buckets), _NAMES)
    verified = names.groupBy("bucket").applyInArrow(_share_names(n_buckets), _ANSWER)
    return dealt.groupBy("block").cogroup(verified.groupBy("block")).applyInArrow(_remove(window, n_buckets), _RESULT) \
        .withColumn("kept", F.col("kept").cast("string"))
