"""Substring dedup against plain Python."""
import random

import numpy as np
import pyarrow as pa
import pytest
from starloom.llm.recompression import _HASHES, Block, remove_repeats

from repeats import removed_by_hand


def block(texts, window):
    return Block(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()),
                           "text": pa.array([None if t is None else t.encode() for t in texts], pa.binary())}), window)


def texts_of(rng, vocabulary, n):
    """Random words with runs and shared passages at any place."""
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))] for _ in range(4)]
    out = []
    for _ in range(n):
        words = []
        while rng.random() < 0.85:
            kind = rng.random()
            if kind < 0.3:
                words += rng.choice(passages)
            elif kind < 0.5:
                words += [rng.choice(vocabulary)] * rng.randrange(1, 20)
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 25))]
        out.append(rng.choice([" ", "\n", "\t \x0b"]).join(words))
    return out


@pytest.mark.parametrize("window", [1, 2, 5, 13, 16])
@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_keys_depend_on_the_window_alone(window, size):
    rng = random.Random(100 * window + size)
    texts = texts_of(rng, [f"w{i}" for i in range(size)], 60)
    b = block(texts, window)
    keys, names = b.keys(), list(zip(*b.names(b.at)))
    words = [w for t in texts for w in t.split()]
    of_key, of_name = {}, {}
    for at, key, name in zip(b.at, keys, names):
        content = tuple(words[at:at + window])
        assert of_key.setdefault(content, key) == key
        assert of_name.setdefault(content, name) == name
    assert len(set(of_name.values())) == len(of_name)


def test_word_hashes_tell_words_apart():
    rng = random.Random(8)
    words = list({bytes(rng.choice(b"abcXY\xc3\xa9") for _ in range(rng.randrange(1, 12))) for _ in range(20_000)}
                 | {b"a" * n for n in range(1, 300)} | {b"ab" * n + b"c" for n in range(1, 300)} | {b"z" * 300_000, b"z" * 300_001})
    data = np.frombuffer(b" ".join(words + words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words + words]) - 1
    start = end - [len(w) for w in words + words]
    for lane in (0, 1):
        h = _HASHES(lane)(data, start, end)
        assert (h[:len(words)] == h[len(words):]).all() and len(set(h.tolist())) == len(words)


def test_keys_are_few_and_telling():
    rng = random.Random(3)
    b = block([" ".join(f"w{rng.randrange(3000)}" for _ in range(4000)) for _ in range(20)], 13)
    assert len(np.unique(b.keys())) < 0.6 * len(b.at)


def rows_of(seed):
    rng = random.Random(seed)
    texts = texts_of(rng, [f"w{i}" for i in range(30)], 40) + texts_of(rng, ["a", "b"], 10)
    texts += [None, "", " \n ", "one", "x " * 12, "x " * 13, "x " * 14, "  é x\x1cy  " + "ü " * 15]
    texts += [texts[0]] * 4 + [" ".join(["lead", texts[1], "tail"])] * 3
    texts += [" ".join(f"long{rng.randrange(50)}" for _ in range(30_000))]
    ids = rng.sample(range(-50, 500), len(texts))
    rows = list(zip(ids, texts))
    return rows + rows[:6] + [(ids[2], texts[3]), (None, texts[0]), (None, texts[0] + " " + texts[1])]


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("window,block_bytes", [(13, 1 << 22), (13, 3000), (4, 20_000)])
def test_against_brute_force(frame, window, block_bytes):
    rows = rows_of(window)
    got = remove_repeats(frame(rows), window, block_bytes, block_bytes)
    assert result(got) == removed_by_hand(rows, window)


def test_spans_are_what_is_removed(frame):
    rows = rows_of(7)
    by_content = {}
    for r in remove_repeats(frame(rows), 13, 5000, 5000).collect():
        by_content.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        words = (text or "").encode().split()
        match = [r for r in by_content[i] if r["n_words"] == len(words)
                 and " ".join(w.decode() for k, w in enumerate(words)
                              if not any(s["start"] <= k < s["stop"] for s in r["removed"])) == r["kept"]]
        assert match


def test_copies_of_one_row_remove_nothing(frame):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text)] * 300 + [(6, text), (4, "other words")]
    assert result(remove_repeats(frame(rows), 13, 2000, 2000)) == removed_by_hand(rows, 13)


def test_nothing(frame):
    assert result(remove_repeats(frame([]))) == []
    assert result(remove_repeats(frame([(None, None), (1, None)]))) == [(1, 0, 0, ""), (None, 0, 0, "")]
