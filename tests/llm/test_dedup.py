"""Line dedup, near-dedup, fingerprints and components."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from starloom.llm import fingerprints, line_dedup, near_dedup
from starloom.llm.components import components

SPACE = " \t\n\x0b\f\r"


# --- lines --------------------------------------------------------------------------------

def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def lines_by_hand(rows):
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key_of(line)
            if len(k) >= 10 and i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if key_of(x) not in first or first[key_of(x)] == i]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(5)
    lines = ["", " ", "short", "a common line of text", "A Common LINE of text\t", "ÄÖÜ line with capitals", "äöü line with capitals",
             "exactly10!", "only nine", *(f"line number {n}" for n in range(60))]
    rows = [(i * 2, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12)))) for i in rng.sample(range(100), 60)]
    return rows + [rows[3], rows[4], (None, "a common line of text\nline of the null"), (500, None), (501, ""), (502, "\n"),
                   (-7, "line number 7\nline number 7"), (1000, "\n".join(lines * 200))]


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_line_dedup(frame, batches):
    rows = line_rows()
    got = [tuple(r) for r in line_dedup.report(frame(rows), batches).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got, key=repr) == lines_by_hand(rows)


def test_line_dedup_of_nothing(frame):
    assert line_dedup.report(frame([])).count() == 0
    assert [tuple(r) for r in line_dedup.report(frame([(None, None)])).collect()] == lines_by_hand([(None, None)])


def test_line_dedup_keeps_columns(frame):
    docs = frame([(1, "the first of lines"), (2, "the first of lines\nx")])
    rows = {r["doc_id"]: r for r in line_dedup.dedup(docs).collect()}
    assert rows[1]["__kept"] == "the first of lines" and rows[2]["__kept"] == "x"
    assert set(docs.columns) < set(rows[1].asDict())


def test_runs_are_merged_and_disjoint(frame):
    index = line_dedup.LineIndex()
    lines = line_dedup.lines_of(frame([r for r in line_rows() if r[0] is not None]))
    for lo in range(-10, 1010, 102):
        index.add(lines.where(F.col("__doc").between(lo, lo + 101)))
    assert all(len(level) < line_dedup.FANOUT for level in index.levels)
    keys = [(r["__k1"], r["__k2"]) for run in index.runs() for r in run.collect()]
    assert len(keys) == len(set(keys)) == lines.select("__k1", "__k2").distinct().count()


# --- near duplicates ----------------------------------------------------------------------

def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(120)] + [(5000, 5001 + i) for i in range(200)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find({n for e in edges for n in e}, edges)
    assert got == {n: c for n, c in want.items() if n in got}
    assert {n for e in edges if e[0] != e[1] for n in e} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def classes_by_hand(spark, frame, rows):
    w = near_dedup.Weights(near_dedup.document_frequencies(frame(rows)), len(rows))
    ids = [(i, t) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, s) in enumerate(ids) for b, t in ids[k + 1:]
             if a != b and ((s or "") == (t or "") or w.similarity(s or "", t or "") >= 0.8)]
    return union_find({i for i, _ in ids}, links)


def test_near_dedup(spark, frame, corpus):
    got = near_dedup.report(frame(corpus)).collect()
    want = classes_by_hand(spark, frame, corpus)
    assert len(got) == len(corpus)
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    by_text = {t: want[i] for i, t in corpus if i is not None}
    assert sorted((r["class_id"] for r in got if r["doc_id"] is None), key=str) == sorted(
        (by_text.get(t) for i, t in corpus if i is None), key=str)
    assert all(r["stays"] == (r["doc_id"] is not None and r["doc_id"] == r["class_id"]) for r in got)
    kept = near_dedup.keep_one(frame(corpus)).collect()
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} == set(want.values())


def test_near_dedup_chain_and_passage(spark, frame):
    """A chain of small edits is one class; texts that share a passage only are not."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    passage = [f"p{n}" for n in range(60)]
    rows += [(100 + i, " ".join(passage + [f"y{rng.randrange(10 ** 6)}" for _ in range(120)])) for i in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.report(frame(rows)).collect()}
    assert got == classes_by_hand(spark, frame, rows)
    assert len({got[i] for i in range(100, 140)}) == 40


def test_a_common_passage_does_not_fill_buckets():
    """Texts that share most of their words with very many others fall into different buckets;
    their near copies still share some."""
    rng = random.Random(12)
    passage = " ".join(f"p{n}" for n in range(150))
    texts = [f"{passage} " + " ".join(f"y{rng.randrange(10 ** 6)}" for _ in range(50)) for _ in range(60)]
    table = np.zeros((2, 1 << near_dedup.DF_BITS), np.int64)
    a, b = near_dedup._cells(near_dedup.shingles(passage)[0])
    table[0][a] = table[1][b] = 20_000
    w, sampler = near_dedup.Weights(table, 60_000), near_dedup.Sampler()
    keys = np.concatenate([sampler.bands(*w.with_rows(t), np.asarray([0])) for t in texts])
    sizes = [np.unique(keys[:, band], return_counts=True)[1].max() for band in range(near_dedup.BANDS)]
    assert np.mean(sizes) < 6
    near = sampler.bands(*w.with_rows(texts[0] + " one more word"), np.asarray([0]))
    assert (near[0] == keys[0]).any()


def near_pairs_among_unlike(seed, unlike, n_pairs, common, own, edits):
    """Texts of a common passage and own words; of some texts there is a near copy."""
    rng = random.Random(seed)

    def words(n):
        return [f"y{rng.randrange(10 ** 7)}" for _ in range(n)]
    passage = [f"p{n}" for n in range(common)]
    rows, planted = [], []
    for i in range(unlike):
        rows.append((i, " ".join(passage + words(own))))
    for k in range(n_pairs):
        text = words(own)
        other = text[:]
        other[-edits:] = words(edits)
        planted.append((unlike + 2 * k, unlike + 2 * k + 1))
        rows += [(i, " ".join(passage + t)) for i, t in zip(planted[-1], (text, other))]
    return rows, planted


def linked(frame, rows, planted):
    """Near pairs by hand, and the pairs in one class; all other texts are unlike."""
    w, texts = near_dedup.Weights(near_dedup.document_frequencies(frame(rows)), len(rows)), dict(rows)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.report(frame(rows)).collect()}
    near = {(a, b) for a, b in planted if w.similarity(texts[a], texts[b]) >= 0.8}
    found = {(a, b) for a, b in planted if got[a] == got[b]}
    assert len(set(got.values())) == len(rows) - len(found)
    return near, found


def test_near_pairs_in_large_mixed_buckets(frame):
    """Every near pair is found in buckets that hold very many unlike texts."""
    rows, planted = near_pairs_among_unlike(3, 360, 60, 190, 14, 8)
    near, found = linked(frame, rows, planted)
    assert len(near) > 50
    assert found == near


def test_near_pairs_under_longer_keys(frame):
    """Texts whose samples are shingles of very many texts lose no near pair to longer keys."""
    rows, planted = near_pairs_among_unlike(4, 3600, 60, 190, 20, 9)
    near, found = linked(frame, rows, planted)
    assert len(near) > 50
    assert found == near


def test_near_dedup_of_nothing(frame):
    assert near_dedup.report(frame([])).count() == 0
    got = near_dedup.report(frame([(None, None), (4, ""), (9, None)])).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(None, 4), (4, 4), (9, 4)}


def test_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    w = near_dedup.Weights(np.zeros((2, 1 << near_dedup.DF_BITS), np.int64), 1000)
    shared, a, b = (" ".join(f"{p}{n}" for n in rng.integers(0, 10 ** 6, 400)) for p in "sab")
    x, y = shared + " " + a[:len(a) // 4], shared + " " + b[:len(b) // 4]
    sampler = near_dedup.Sampler()
    keys = []
    for t in (x, y):
        keys.append(sampler.bands(*w.with_rows(t), np.asarray([0])))
    true = w.similarity(x, y)
    assert abs((keys[0] == keys[1]).mean() - true ** near_dedup.ROWS) < 0.25
    assert true == pytest.approx(near_dedup.Weights(np.zeros((2, 1 << near_dedup.DF_BITS), np.int64), 10).similarity(x, y))


def test_document_frequencies_bound(frame):
    rows = [(i, f"a b c d e f {i} g h i j k") for i in range(50)]
    table = near_dedup.document_frequencies(frame(rows))
    h, _ = near_dedup.shingles("a b c d e")
    a, b = near_dedup._cells(h)
    assert min(table[0][a[0]], table[1][b[0]]) == 50
    assert table.sum() == 2 * sum(len(near_dedup.shingles(t)[0]) for _, t in rows)


# --- fingerprints -------------------------------------------------------------------------

def test_fingerprints(frame, corpus):
    rows = [r for r in corpus if r[0] is not None]
    rows = list(dict(rows).items())
    got = {r["doc_id"]: r for r in fingerprints.report(frame(rows + [rows[4]])).collect()}
    ordered = sorted(rows, reverse=True)
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        t, following = t or "", following or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + following[:k]
        if i != rows[4][0] and i != ordered[[x for x, _ in ordered].index(rows[4][0]) - 1][0]:
            assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["n_chars"] == len(t)
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    texts = defaultdict(set)
    for i, t in rows:
        texts[t or ""].add(got[i]["fingerprint"])
        if len((t or "").split()) > 100:
            assert got[i]["near_edited"] > 0.4
    assert all(len(prints) == 1 for prints in texts.values())


def sketch_by_hand(text):
    """Spark's xxhash64 (seed 42, columns chained) of every five words, upper 31 bits, those below a
    quarter of the range or else the smallest."""
    def h(data, seed):
        return xxhash.xxh64_intdigest(data, seed=seed)

    def chained(values):
        seed = 42
        for v in values:
            seed = h(v.to_bytes(8, "little"), seed)
        return seed >> 33
    words = [h(w.encode(), 42) for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n = fingerprints.WORDS
    shingles = [chained(words[i:i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [chained(words)] if words else []
    return sorted({x for x in shingles if x < 2 ** 31 // 4}) or ([min(shingles)] if shingles else [])


def likeness_by_hand(a, b):
    least = min(len(a), len(b))
    return len(set(a) & set(b)) / least if least else float(len(a) == len(b))


def test_sketches_by_hand(frame, corpus):
    rows = sorted(dict((i, t) for i, t in corpus if i is not None).items(), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.report(frame(rows)).collect()}
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        own, other = sketch_by_hand(t), sketch_by_hand(following)
        edited = sketch_by_hand(t[:len(t) - len(t) // 3] + following[:len(t) // 3])
        assert got[i]["fingerprint"] == ",".join(map(str, own))
        assert got[i]["edited_fingerprint"] == ",".join(map(str, edited))
        assert got[i]["near_edited"] == pytest.approx(likeness_by_hand(own, edited))
        assert got[i]["near_next"] == pytest.approx(likeness_by_hand(own, other))


def shingle_sets(text):
    words = text.strip(SPACE).split()
    n = fingerprints.WORDS
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def test_containment_of_unequal_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(10 ** 6)}" for _ in range(8000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[1000:2500])), (3, " ".join(long[:700] + [f"z{n}" for n in range(700)]))]
    s = fingerprints.with_sketch(spark.createDataFrame(rows, "doc_id long, text string"), "text", "sketch")
    pairs = s.alias("a").join(s.alias("b"), F.col("a.doc_id") < F.col("b.doc_id")).select(
        F.col("a.doc_id").alias("a"), F.col("b.doc_id").alias("b"),
        fingerprints.containment(F.col("a.sketch"), F.col("b.sketch")).alias("c")).collect()
    sets = {i: shingle_sets(t) for i, t in rows}
    for r in pairs:
        a, b = sets[r["a"]], sets[r["b"]]
        assert abs(r["c"] - len(a & b) / min(len(a), len(b))) < 0.12
    # The sketch of a union is the merged sketch.
    both = s.where("doc_id < 3").agg(F.collect_list("sketch").alias("s")).select(
        fingerprints.merged(F.col("s")[0], F.col("s")[1]).alias("m")).first()["m"]
    assert both == s.where("doc_id = 1").first()["sketch"]


@pytest.mark.parametrize("rows", [[], [(5, "one two three four five six")], [(5, None)], [(5, ""), (5, "x y"), (None, "z")]])
def test_fingerprints_of_few(frame, rows):
    got = fingerprints.report(frame(rows)).collect()
    assert len(got) == len(rows)
    if len(rows) == 1:
        assert got[0]["near_next"] == 1.0
