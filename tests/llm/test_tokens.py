"""Packing, byte-level BPE and token counts."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import bpe, packing, token_counts
from starloom.llm.word_tokenizer import WordTokenizer
from tokenizers import Tokenizer

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def small_leaves():
    return bpe.TreeCodec(RANKS, public_tokenizers.PATTERN, leaf=3)


@pytest.fixture(scope="module")
def word_tokenizer():
    return WordTokenizer(WORD_BPE)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD_BPE)          # as it is, added tokens included


def test_tree_equals_library_at_any_leaf(library, small_leaves, corpus):
    rng = random.Random(3)
    alphabet = "ab'sltre  \n\t1é|.ñ　\xa0\x1c\x85😀"
    texts = [t or "" for _, t in corpus] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(70))) for _ in range(3000)]
    for t in texts:
        ids = small_leaves.encode(t)
        assert ids == library.encode_ordinary(t)
        assert small_leaves.decode(ids) == t.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_tree_equals_library_on_any_text(text):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    small = bpe.TreeCodec.__new__(bpe.TreeCodec)
    small.__dict__ = {**codec.__dict__, "_leaf": 4}
    assert small.encode(text) == codec.encode(text)


def test_bpe_operator(spark, frame, corpus, library):
    import hashlib
    got = {(r["doc_id"], r["ids_sha256"], r["n_tokens"], r["decoded_sha256"])
           for r in bpe.digests(frame(corpus), RANKS, public_tokenizers.PATTERN).collect()}
    want = set()
    for i, t in corpus:
        ids = library.encode_ordinary(t or "")
        want.add((i, hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), len(ids),
                  hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    encoded = bpe.encode_texts(frame(corpus).select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_ids(encoded, RANKS, public_tokenizers.PATTERN)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back.collect())
    assert bpe.digests(frame([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_counts(frame, corpus, library):
    lengths = sorted(len(library.encode_ordinary(t or "")) for _, t in corpus)
    hist = token_counts.histogram(token_counts.encoded_lengths(frame(corpus), RANKS, public_tokenizers.PATTERN)).cache()
    rows = {r["length"]: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_longer"] == sum(n > limit for n in lengths)
        assert r["tokens_longer"] == sum(n for n in lengths if n > limit)
        assert r["tokens_kept"] == sum(min(n, limit) for n in lengths)
        assert r["tokens_lost"] == sum(lengths) - r["tokens_kept"]
        assert r["quantile"] == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    for r in token_counts.at_limits(hist, [0, 5, 100, 10 ** 6]).collect():
        assert r["tokens_kept"] == sum(min(n, r["limit"]) for n in lengths)
        assert r["docs_longer"] == sum(n > r["limit"] for n in lengths)
    median = {r["q"]: r["length"] for r in token_counts.quantiles(hist, [0.5, 1.0]).collect()}
    assert median[1.0] == lengths[-1] and sum(n <= median[0.5] for n in lengths) * 2 >= len(lengths)
    assert token_counts.histogram(token_counts.encoded_lengths(frame([]), RANKS, public_tokenizers.PATTERN)).count() == 0


def test_histogram_over_many_blocks(spark):
    lengths = [n * 977 for n in range(40)] + [0, 977]
    hist = token_counts.histogram(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long"))
    for r in hist.collect():
        assert r["docs_longer"] == sum(n > r["length"] for n in lengths)
        assert r["tokens_kept"] == sum(min(n, r["length"]) for n in lengths)


def test_word_tokenizer_equals_library(word_tokenizer, word_library, corpus):
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(33, 127), *range(160, 256), 0x300, 0x3a3, 0x130, 0x2003, 0x1c, 9, 10, 32]]
    texts = [t or "" for _, t in corpus] + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    texts += ["a <|endoftext|> b", "ΟΔΟΣ ΟΔΟΣ. İstanbul", "don't I'LL 12345 &&&", "x<|endoftext|>y", "<|EndOfText|>", "<|startoftext|>",
              "<|startoftext|><|endoftext|>", "<|endoftext|", "é<|endoftext|>\n<|endoftext|>", "pre<|StartOfText|>post"]
    assert word_library.encode("a <|endoftext|> b", add_special_tokens=False).ids[1] == word_library.token_to_id("<|endoftext|>")
    for t in texts:
        assert np.frombuffer(word_tokenizer.encode(t), "<u4").tolist() == word_library.encode(t, add_special_tokens=False).ids


def test_packing(frame, corpus, word_library):
    capacity = 256
    got = packing.pack(frame(corpus), WORD_BPE, capacity).collect()
    want = Counter()
    for i, t in corpus:
        ids = [*word_library.encode(t or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = np.asarray(ids[at:at + capacity], "<u4")
            want[i, p, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], capacity)
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) <= -(-total // capacity) * 1.1 + 1
    assert packing.pack(frame([]), WORD_BPE, capacity).count() == 0


def check_sequences(places, capacity):
    by = defaultdict(list)
    for s, offset, length in places:
        by[s].append((offset, length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_is_tight(seed):
    rng = random.Random(seed)
    capacity = rng.choice([64, 512, 2048])
    hist = Counter(min(capacity, max(1, int(rng.lognormvariate(np.log(capacity / 4), 0.9)))) for _ in range(4000))
    runs = packing.plan(dict(hist), capacity)
    held = Counter()
    for r in runs:
        assert sum(n * k for n, k in r.items) <= capacity
        for n, k in r.items:
            held[n] += k * r.count
    assert held == hist
    bound = -(-sum(n * k for n, k in hist.items()) // capacity)
    assert sum(r.count for r in runs) <= 1.01 * bound + 2
    t = packing.slot_table(runs)
    assert len(t["key"]) < 40 * capacity


@pytest.mark.parametrize("hist", [{}, {1: 1}, {2048: 3}, {1500: 10}, {1024: 7, 1025: 9, 3: 1}, {683: 9, 682: 1}, {2047: 100_000, 1: 100_000}])
def test_plan_of_small_histograms(hist):
    held = Counter()
    for r in packing.plan(dict(hist), 2048):
        for n, k in r.items:
            held[n] += k * r.count
    assert held == Counter(hist)
