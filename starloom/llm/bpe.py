"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved recursively down to leaves of ``LEAF`` characters.  A leaf is encoded on its
own; two encoded neighbours are joined by re-encoding a window around their border and keeping
every token outside it.  The window ends, on either side, at the nearest change from a
non-space to a white-space character.  The splitting pattern never lets a match hold a
non-space followed by white space, and looks only forward, so such a change begins a new match
in *any* context: tokens beyond it are the same in the part and in the whole, and BPE merges
never cross a match.  The window grows from the border until it has found such a change (or
has reached the end of the part).  The join is associative, so any tree gives the same ids.

Decoding is a monoid homomorphism: bytes of the halves of an id sequence are concatenated.

Null text counts as empty; the empty text has no ids.  Rows are independent, so ties, repeats
and extra columns have no influence; an empty table gives an empty result.
"""
from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Characters of a leaf of the tree.
LEAF = 8192
#: Ids of a leaf when decoding.
LEAF_IDS = 4096

# The code points with Unicode's White_Space property (what \s means to the
# splitting pattern; Python's own \s also takes \x1c to \x1f).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_BORDER = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class TreeCodec:
    """Encoder and decoder for one rank file and splitting pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        ranks = load_ranks(path)
        self._leaf = leaf
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._encode, self._decode = encoding.encode_ordinary, encoding.decode_bytes
        self._bytes = {i: b for b, i in ranks.items()}

    def encode(self, text: str) -> list[int]:
        return self._reduce(text, 0, len(text))

    def _reduce(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self._leaf:
            return self._encode(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, lo, mid, hi, self._reduce(text, lo, mid), self._reduce(text, mid, hi))

    def _join(self, text, lo, mid, hi, left, right) -> list[int]:
        a, b = self._left_border(text, lo, mid), self._right_border(text, mid, hi)
        drop = self._tokens_of(reversed(left), len(text[a:mid].encode()))
        skip = self._tokens_of(iter(right), len(text[mid:b].encode()))
        return left[:len(left) - drop] + self._encode(text[a:b]) + right[skip:]

    @staticmethod
    def _left_border(text: str, lo: int, mid: int) -> int:
        """The last certain match start before ``mid``, looking at growing windows."""
        width = 64
        while True:
            start = max(lo, mid - width)
            # One character before the window tells whether its first one is a border.
            found = [m.start() for m in _BORDER.finditer(text, max(lo, start - 1), mid)]
            if found:
                return found[-1]
            if start == lo:
                return lo
            width *= 4

    @staticmethod
    def _right_border(text: str, mid: int, hi: int) -> int:
        """The first certain match start after ``mid``."""
        width = 64
        while True:
            end = min(hi, mid + width)
            # A border must lie inside the right part: both of its characters belong to it.
            m = next((m for m in _BORDER.finditer(text, mid, end) if m.start() > mid), None)
            if m:
                return m.start()
            if end == hi:
                return hi
            width *= 4

    def _tokens_of(self, ids: Iterator[int], n_bytes: int) -> int:
        """How many of ``ids`` make up exactly ``n_bytes``."""
        n = 0
        while n_bytes > 0:
            n_bytes -= len(self._bytes[next(ids)])
            n += 1
        if n_bytes:
            raise AssertionError("a certain match start is not a token border")
        return n

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return self._decode(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_CODECS: dict[tuple[str, str], TreeCodec] = {}


def codec(path: str, pattern: str) -> TreeCodec:
    """One codec per Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = TreeCodec(path, pattern)
    return _CODECS[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as ``out`` (array<int>)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for part in parts:
            yield pd.Series([np.asarray(c.encode(t or ""), dtype=np.int32) for t in part])

    return docs.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decode_ids(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of ``ids`` as ``out``."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for part in parts:
            yield pd.Series([c.decode(list(x)) if x is not None else None for x in part])

    return docs.withColumn(out, decoded(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text.

    Encoding and decoding share one Python pass: ids travel back to the JVM only as digests."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for part in parts:
            rows = []
            for t in part:
                ids = c.encode(t or "")
                rows.append((len(ids), hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(),
                             hashlib.sha256(c.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", both(F.coalesce(F.col("text"), F.lit(""))).alias("d")).select("doc_id", "d.*")
