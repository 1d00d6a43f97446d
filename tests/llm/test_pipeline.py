"""The pipeline, stage by stage against plain Python, and the registered queries."""
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from starloom.llm import language, near_dedup, quality
from starloom.llm.common import id_bucket, stage
from starloom.llm.queries import ORACLE, QUERIES

sys.path.insert(0, __file__.rsplit("/", 3)[0])
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900, None, "en", "s", 0), (901, "12 34", "en", "s", 5), (902, "word", None, None, None)], docs.schema)
    docs = stage(docs.unionByName(odd), "input")
    seen = {}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "quality", "line_dedup", "near_dedup", "packing"]

    kept = stage(steps["language_id"](spark, docs, SF), "s1")
    assert kept.columns == docs.columns
    seen = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert got == {i: t for i, t in seen.items() if language.has_letter(t)}

    model = quality.learn(kept, spark.read.parquet(f"{SF}/labels.parquet"), id_bucket(F.col("doc_id"), 5) != 0)
    good = stage(steps["quality"](spark, kept, SF), "s2")
    want = {i: t for i, t in got.items() if model.score(np.asarray([quality.text_features(t)]))[0] >= 0.3}
    got = {r["doc_id"]: r["text"] for r in good.collect()}
    assert got == want and good.columns == docs.columns

    lines = stage(steps["line_dedup"](spark, good, SF), "s3")
    from test_dedup import key_of
    first = {}
    for i in sorted(got):
        for line in got[i].split("\n"):
            first.setdefault(key_of(line), i)
    want = {i: "\n".join(x for x in t.split("\n") if len(key_of(x)) < 10 or first[key_of(x)] == i) for i, t in got.items()}
    rows = lines.collect()
    got = {r["doc_id"]: r["text"] for r in rows}
    assert got == want and lines.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    single = stage(steps["near_dedup"](spark, lines, SF), "s4")
    w = near_dedup.Weights(near_dedup.document_frequencies(lines), lines.count())
    from test_dedup import union_find
    ids = sorted(got)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if got[a] == got[b] or w.similarity(got[a], got[b]) >= 0.8]
    want = set(union_find(ids, links).values())
    got = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(got) == want and single.columns == docs.columns

    packed = steps["packing"](spark, single, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(list(got))


def test_run_and_registered_queries(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def run_on(spark, tmp_path, rows):
    """The whole pipeline on a small ``documents`` table with columns of clashing names."""
    names = "doc_id long, text string, lang string, source string, n_chars long, node long, length int, h long, key string, score double"
    spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), 1, 2, 3, "k", 0.5) for i, t, lang in rows], names) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _, _ in rows if i is not None] + [(None, 1, None)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_on_odd_tables(spark, tmp_path):
    text = " ".join(f"word{i} and the house" for i in range(60))
    rows = [(1, text, "en"), (2, text, "en"), (2, text, "en"), (3, None, "en"), (4, "", None), (5, "12 34 !?", "en"),
            (6, "das haus und der garten " * 40, "de"), (7, "x" * 300_000 + " long", None), (None, "a text without an id", "en")]
    kept = {r["doc_id"] for r in run_on(spark, tmp_path, rows)}
    # All lines of 2 stand in 1: it goes on with an empty text, and the empty texts are one class.
    assert kept == {1, 2, 6, 7, None}


def test_pipeline_on_nothing(spark, tmp_path):
    assert run_on(spark, tmp_path, []) == []


def test_run_leaves_only_what_its_result_reads(spark):
    import os
    base = spark.sparkContext._jsc.sc().getCheckpointDir().get().replace("file:", "")
    before = set(os.listdir(base))
    assert corpus_pipeline.run(spark, SF).count() > 0
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before}
    assert not left & {name for name, _ in corpus_pipeline.STAGES[:3]}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and all((a[c].to_numpy() == b[c].to_numpy()).all() for c in cols)
