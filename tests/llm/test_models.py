"""Language identification, quality classifier, language-model scores and top-k search."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from starloom.llm import language, lm, quality, topk
from starloom.llm.common import id_bucket

SF = "/root/testdata/sf0.01"


# --- language -----------------------------------------------------------------------------

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = id_bucket(F.col("doc_id"), 4) == 2
    model = language.learn(docs, ~held, sample_rows=400)
    rows = language.predict(docs.where(held), model).select("lang", "lang_id.*").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert model.families == {"Germanic": ["de", "en"], "Romance": ["es", "fr"]}


def test_language_edge_cases(frame):
    rng = random.Random(1)
    texts = {"en": "the house and the water with this", "de": "das haus und der wasser mit den", "tlh": "qapla batlh vaj nuqneh jatlh"}
    rows = [(k, lang, " ".join(rng.choices(t.split(), k=20))) for k, (lang, t) in enumerate(list(texts.items()) * 15)]
    spark = frame([]).sparkSession
    docs = spark.createDataFrame([(k, t, lang) for k, lang, t in rows] + [(90, None, "en"), (91, "", "de"), (92, "12 !?", "en"), (93, "haus", None)],
                                 "doc_id long, text string, lang string")
    model = language.learn(docs, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).select("doc_id", "lang_id.*").collect()}
    assert all(got[k][0] == lang for k, lang, _ in rows)
    assert got[90] == got[91] == got[92] == ("und", 0.0)
    assert got[93][0] in texts
    nothing = language.learn(docs, F.lit(False))
    assert {r["lang_id"]["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    single = language.learn(docs.where("lang = 'en'"), F.lit(True))
    assert language.predict(docs.where("doc_id = 0"), single).first()["lang_id"].asDict() == {"lang_pred": "en", "score": 1.0}
    assert language.predict(frame([]).select("doc_id", "text"), model).count() == 0


def test_language_learns_from_repeated_ids(spark):
    """One id on most rows, also under two languages and with many texts, is one row a language."""
    docs = [(k, f"the house and the water {k}", "en") for k in range(40)] + [(k, f"das haus und der garten {k}", "de") for k in range(40, 80)]
    many = [(1000, "the house of one id", "en")] * 5000 + [(1000, f"das haus einer id {k}", "de") for k in range(3000)]
    schema = "doc_id long, text string, lang string"
    few = language.learn(spark.createDataFrame(docs + [many[0]], schema), F.lit(True))
    model = language.learn(spark.createDataFrame(docs + many, schema), F.lit(True), sample_rows=60)
    for m in (few, model):
        assert m.predict(["the water and the house", "der garten und das haus"])[0] == ["en", "de"]
    every = spark.createDataFrame(docs, schema)
    assert np.array_equal(language.learn(every, F.lit(True)).within["Germanic"][0].weights,
                          language.learn(every.unionByName(every), F.lit(True)).within["Germanic"][0].weights)


def test_prediction_does_not_depend_on_the_batch():
    rows = [("en", language.features("the house and the water")), ("fr", language.features("la maison et les eaux"))] * 4
    model = language.LanguageModel.train(rows)
    texts = ["the water", "les eaux", None, "x", "", "the " * 3000]
    together = model.predict(texts)
    for k, t in enumerate(texts):
        label, score = model.predict([t])
        assert label[0] == together[0][k] and score[0] == pytest.approx(together[1][k])


# --- quality ------------------------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = id_bucket(F.col("doc_id"), 5) == 0
    model = quality.learn(docs, labels, ~held)
    rows = quality.score(docs.where(held).join(labels, "doc_id"), model).select("quality", "quality_score").collect()
    pos = np.asarray([r[1] for r in rows if r[0] == 1])
    neg = np.asarray([r[1] for r in rows if r[0] == 0])
    assert (pos[:, None] > neg[None, :]).mean() > 0.95
    assert (pos >= 0.3).mean() > 0.97


def test_quality_edge_cases(spark, frame, corpus):
    labels = spark.createDataFrame([(i, k % 2) for k, (i, _) in enumerate(corpus) if i is not None] + [(None, 1), (1, None)],
                                   "doc_id long, quality int")
    docs = frame(corpus)
    model = quality.learn(docs, labels, F.lit(True))
    scores = [r["quality_score"] for r in quality.score(docs, model).collect()]
    assert len(scores) == len(corpus) and all(0 <= s <= 1 for s in scores)
    none = quality.learn(docs, labels.where("quality = 7"), F.lit(True))
    assert quality.score(docs, none).first()["quality_score"] == pytest.approx(0.5)
    assert quality.score(frame([]), model).count() == 0


def test_quality_learns_from_repeated_ids(spark):
    """An id repeated 20,000 times, with one text or many, is one row."""
    good = [(k, " ".join(f"a sentence of words number {k} here." for _ in range(20))) for k in range(60)]
    bad = [(k, "$$$ 999 ### " * (k % 7 + 1)) for k in range(100, 160)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(7777, 0)], "doc_id long, quality int")
    plain = spark.createDataFrame(good + bad, "doc_id long, text string")
    hot = plain.unionByName(spark.range(20_000).select(F.lit(7777).alias("doc_id"), F.concat(F.lit("### 1 "), (F.col("id") % 50).cast("string")).alias("text")))
    for docs in (plain, hot):
        model = quality.learn(docs, labels, F.lit(True), sample_rows=500)
        scores = model.score(np.asarray([quality.text_features(good[3][1]), quality.text_features(bad[3][1])]))
        assert scores[0] > 0.9 and scores[1] < 0.1


def test_features_do_not_depend_on_segments():
    rng = random.Random(2)
    text = "".join(rng.choice("aB1 \n!|.&é") for _ in range(500))
    assert quality.text_features(text) == pytest.approx(quality.text_features(text, segment=37))
    assert len(quality.text_features(None)) == len(quality.FEATURES)


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9


# --- language model -----------------------------------------------------------------------

def lm_by_hand(rows, held, mu, floor):
    def tokens(t):
        return [*"".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
                .replace("\f", " ").replace("\r", " ").split(" ")]
    seqs = [[w for w in tokens(t) if w] + ["</s>"] for _, t in rows]
    uni, pair, triple = Counter(), Counter(), Counter()
    for s, h in zip(seqs, held):
        if not h:
            uni.update(s)
            pair.update(zip(["</s>", *s[:-1]], s))
            triple.update(zip(["</s>", *s[:-2]], s[:-1], s[1:]))
    n, v = sum(uni.values()), len(uni)

    def back(k, count):
        return (mu[k] + floor[k] * count) / (mu[k] + count)

    def after_one(u, w):
        share = (uni[w] + 0.5) / (n + 0.5 * (v + 1))
        return (1 - back(0, uni[u])) * pair[u, w] / uni[u] + back(0, uni[u]) * share if uni[u] else share

    def after_two(t, u, w):
        seen = pair[t, u]
        return (1 - back(1, seen)) * triple[t, u, w] / seen + back(1, seen) * after_one(u, w) if seen else after_one(u, w)
    out = []
    for (i, _), s, h in zip(rows, seqs, held):
        score = math.log10(after_one("</s>", s[0])) + sum(math.log10(after_two(*g)) for g in zip(["</s>", *s[:-2]], s[:-1], s[1:]))
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s)
        out.append((i, h, len(s), sum(uni[w] > 0 for w in s), n, base, score))
    return out


@pytest.mark.parametrize("block_bytes", [2000, 1 << 24])
def test_lm_scores(frame, corpus, block_bytes, monkeypatch):
    monkeypatch.setattr(lm, "SEGMENT", 50)
    rows = corpus + [(9000 + k, "a rose is a rose is a rose " * (k + 1)) for k in range(40)]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1 for i, _ in rows]
    want = lm_by_hand(rows, held, (5.0, 0.7), (0.4, 0.1))
    got = lm.score(frame(rows), id_bucket(F.col("doc_id"), 5) == 1, (5.0, 0.7), (0.4, 0.1), block_bytes, 4 * block_bytes)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda r: (str(r[0]), r[2], r[5])), sorted(want, key=lambda r: (str(r[0]), r[2], r[5]))):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_lm_edge_cases(frame):
    assert lm.score(frame([]), F.lit(False)).count() == 0
    all_held = lm.score(frame([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in all_held} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert all(r["base_score"] == r["score"] == 0 for r in all_held)


def test_lm_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    r = lm.score(docs, id_bucket(F.col("doc_id"), 5) == 1).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1] * 0.82


def lm_block(texts, n_ranges=3):
    return lm.Block(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array([t.encode() for t in texts], pa.binary())}),
                    n_ranges)


def test_packed_keys_and_coded_counts_come_back():
    rng = np.random.default_rng(4)
    for n, top in ((0, 1), (1, 1), (1, 1 << 38), (5, 6), (1000, 1 << 38), (1000, 70_000), (3, 1 << 38), (70_000, 1 << 30)):
        keys = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        assert np.array_equal(lm.unpacked(lm.packed(keys)), keys)
    dense = np.concatenate([np.arange(5000, dtype=np.uint64), np.asarray([1 << 37, (1 << 38) - 1], np.uint64)])
    assert np.array_equal(lm.unpacked(lm.packed(dense)), dense) and len(lm.packed(dense)) < 4.1 * 5000
    for counts in ([], [0], [254, 255, 256, 10 ** 12], [0, 1, 1, 0, 2, 1] * 1000):
        assert lm.uncoded(lm.coded(np.asarray(counts, np.int64))).tolist() == counts


def test_block_does_not_depend_on_the_order_of_texts():
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(9))) for _ in range(40)]
    a, b = lm_block(texts), lm_block(texts[::-1])
    assert np.array_equal(a.grams, b.grams) and np.array_equal(a.words, b.words)
    half = np.asarray([k % 2 == 0 for k in range(40)])
    assert all(np.array_equal(x, y) for x, y in zip(a.training(half), b.training(half[::-1])))


def test_probabilities_of_a_state_sum_to_one():
    """Every text that goes on from a state with a known word, the end or an unknown word."""
    train = ["a b a c", "b a a", "c", "a b b"]
    words = ["a", "b", "c"]
    for start in ("", "a ", "a b ", "b a ", "c ", "c b ", "x ", "x a "):
        probes = [start + w + " a" for w in [*words, "unknown"]] + [start.strip()]
        b = lm_block(train + probes)
        counts = b.training(np.asarray([True] * len(train) + [False] * len(probes)))
        model = lm.Automaton(b, *counts, int(counts[0].sum()), int((counts[0] > 0).sum()), (3.0, 0.5), (0.3, 0.1))
        places = b.first[len(train):] + len(start.split())
        p = np.where(b.has_triple[places], model.arc_2[places], model.arc_1[places])
        assert (10 ** p).sum() == pytest.approx(1)


def test_repeated_text_scores_above_new_text():
    old = "an old text of several words that stands in the training texts already"
    new = "the words that stands already in training an text old of several texts"
    b = lm_block([old] * 2 + ["some other text of words"] * 3 + [old, new])
    counts = b.training(np.asarray([True] * 5 + [False] * 2))
    scores = lm.Automaton(b, *counts, int(counts[0].sum()), int((counts[0] > 0).sum()), lm.MU, lm.FLOOR).scores()
    assert scores[-2] > 0.6 * scores[-1]


# --- top-k --------------------------------------------------------------------------------

def top_by_hand(rows, k, every):
    usable = [(i, np.floor(64 * np.asarray(v, dtype=float)).astype(object)) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in {i: v for i, v in usable if i % every == 0}.items():
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), i) for i, v in usable if i != qi and len(v) == len(q))
        out += [(qi, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 5, 64])
def test_top_k(spark, dim, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    rng = np.random.default_rng(dim)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=dim))]) for i in rng.permutation(260)]
    rows += [(1000 + i, rows[5][1]) for i in range(70)]                       # a hot vector: ties
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * dim), (2004, [float("inf")] * dim),
             (2020, [1.0] * (dim + 1)), (None, [1.0] * dim)]
    rows += [(2005, rows[0][1]), (2005, rows[0][1])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, row long, col long")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.search(df, F.col("vec_id") % 4 == 0, k=20).collect())
    assert got == top_by_hand(rows, 20, 4)


def test_top_k_of_few_and_of_large_values(spark):
    schema = "vec_id long, embedding array<double>"
    assert topk.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    rows = [(0, [1e7, -3.5]), (1, [2e7, 1.0]), (2, [-1e7, 2.0])]
    got = sorted(tuple(r) for r in topk.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).collect())
    assert got == top_by_hand(rows, 20, 20)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(30, 50)), rng.normal(size=(40, 50))
    exact = a @ b.T
    for s in (1, 4, 16, 50, 99):
        assert (topk.segment_stats(a, s) @ topk.segment_stats(b, s).T >= exact - 1e-9).all()


def test_top_k_with_clashing_columns_and_many_copies(spark, monkeypatch):
    """Copies of one row fill no block, other columns are ignored, and evenly spread vectors (which
    no level rules out) go through whole products."""
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    rng = random.Random(6)
    v = {i: [rng.randrange(-64, 64) / 64 for _ in range(16)] for i in range(200)}
    rows = [(i, v[i], 1, 2, 3, "v", 4, 5, 6) for i in range(200)] + [(7, v[7], 1, 2, 3, "v", 4, 5, 6)] * 900
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, h int, length int, row int, e string, n int, rank int, copy int")
    got = sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 20 == 0, k=20).collect())
    want = []
    for q in range(0, 200, 20):
        score = lambda i: sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(v[q], v[i]))
        every = sorted([(-score(i), i) for i in range(200) if i != q] + [(-score(7), 7)] * 900)
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(every[:20])]
    assert got == sorted(want)
