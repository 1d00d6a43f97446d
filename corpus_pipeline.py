"""A training corpus from raw documents: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
into the shared checkpoint folder and reads it back as the next stage's input.  All but the last
return the columns of ``documents``.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import language, line_dedup, near_dedup, packing, quality
from starloom.llm.common import id_bucket, stage, table, unstage
from starloom.llm.queries import CONTEXT, QUALITY_THRESHOLD

#: The models, similarities and token ids of the stages are beyond SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language can't be told (null, or no letter)."""
    model = language.learn(docs, id_bucket(F.col("doc_id"), 4) != 2)
    return language.predict(docs, model, "__lang_id") \
        .where(F.col("__lang_id.lang_pred") != language.UNDETERMINED).select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score below the threshold."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), id_bucket(F.col("doc_id"), 5) != 0)
    return quality.score(docs, model, "__quality") \
        .where(F.col("__quality") >= QUALITY_THRESHOLD).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds."""
    kept = line_dedup.dedup(docs)
    text = F.when(F.col("text").isNotNull(), F.col("__kept"))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return kept.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), CONTEXT)


STAGES = [("language_id", identify_language), ("quality", classify_quality), ("line_dedup", dedup_lines),
          ("near_dedup", dedup_near), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
        if before is not None:
            unstage(before)                      # what the stage kept is written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
