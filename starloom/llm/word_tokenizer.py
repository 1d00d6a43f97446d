"""Ids of the lower-casing word-end BPE tokenizer, cached by white-space separated chunk.

White space never enters a token of this tokenizer and is dropped, so the ids of a text are
those of its chunks in order, and a chunk is encoded once per worker.  A new chunk of plain
Latin characters goes through the vocabulary's merges (run by the byte-pair encoder of the
tiktoken library, with the word end as a byte of its own that merges first); any other chunk,
and one that holds the text of an added token, goes through the tokenizers library itself, which
also owns normalisation.
"""
from __future__ import annotations

import json
import os

import numpy as np
import regex

#: Chunks kept per worker; the cache starts afresh beyond it.
CACHE_CHUNKS = 800_000
#: Stands for the end of a word; no UTF-8 text holds this byte.
_END = b"\xff"
# Characters that are single code points under NFC and lower-case one by one.
_PLAIN = regex.compile("[!-~À-ÿ]*")


def _byte_of_symbol() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others are numbered from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Chunks(dict):
    """Ids by chunk, made when first asked for."""

    def __init__(self, make):
        self._make = make

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self._make(chunk)
        return ids


class WordTokenizer:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self._full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self._split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        end, symbol = spec["model"]["end_of_word_suffix"], _byte_of_symbol()

        def raw(token: str) -> bytes:
            word_end = token.endswith(end)
            body = token[:-len(end)] if word_end else token
            return bytes(symbol[c] for c in body) + _END * word_end

        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + _END: 256 + b for b in range(256)}
        for merge in merges:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw(a) + raw(b), len(ranks))
        special = {t["content"] for t in spec["added_tokens"]}
        # No text holds what this finds if nothing was added.
        self._added = regex.compile("|".join(regex.escape(t.lower()) for t in sorted(special)) or "(?!)")
        id_of = {raw(t): i for t, i in vocab.items() if t not in special}
        zero = np.zeros(1, dtype="<u4").tobytes()
        self._ids = [zero] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            if token in id_of:
                self._ids[rank] = np.asarray([id_of[token]], dtype="<u4").tobytes()
        self._pieces = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks,
                                         special_tokens={})._encode_single_piece
        self._cache = _Chunks(self._chunk)

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk):
            ids, lowered = self._ids, chunk.lower()
            if not self._added.search(lowered):
                return b"".join([ids[r] for piece in self._split.findall(lowered)
                                 for r in self._pieces(piece.encode() + _END)])
        return np.asarray(self._full.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        if len(self._cache) > CACHE_CHUNKS:
            self._cache.clear()
        return b"".join(map(self._cache.__getitem__, text.replace("\n", " ").split(" ")))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]
