"""Exact token-length histogram and the answers read from its suffix sums.

Documents are aggregated by encoded length.  For a context limit L, with sums over lengths:

* documents longer than L:        sum of n for length > L
* tokens kept when cut at L:      sum of n * min(length, L)
* quantile q:                     smallest length whose share of documents reaches q

Sums run over blocks of ``BLOCK`` lengths: block totals first (one row a block), then a window
inside each block, so no single task orders the whole histogram.

Null text counts as empty (length 0).  Repeated rows count as often as they occur; equal
lengths share a row; an empty table gives an empty histogram.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import small_batches, stage

#: Lengths of one block of the histogram.
BLOCK = 4096


def encoded_lengths(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the exact number of ids of every text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def n_ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for part in parts:
            yield pd.Series([len(c.encode(t or "")) for t in part], dtype="int64")

    return docs.select("doc_id", n_ids(F.coalesce(F.col("text"), F.lit(""))).alias("length"))


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per length: its documents, those at most as long and longer, token totals, and
    the tokens that a context limit of this length keeps and loses."""
    h = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))
    # Used twice below: written once, so that no text is encoded again for its length.
    h = stage(h, "length-histogram")
    h = (h.withColumn("n_tokens", F.col("n_docs") * F.col("length"))
          .withColumn("__block", F.floor(F.col("length") / BLOCK)))
    blocks = h.groupBy("__block").agg(F.sum("n_docs").alias("__d"), F.sum("n_tokens").alias("__t"))
    later = Window.orderBy(F.col("__block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "__block",
        F.coalesce(F.sum("__d").over(later), F.lit(0)).alias("__d_after"),
        F.coalesce(F.sum("__t").over(later), F.lit(0)).alias("__t_after"),
        F.sum("__d").over(Window.partitionBy()).alias("total_docs"),
        F.sum("__t").over(Window.partitionBy()).alias("total_tokens"))
    inside = Window.partitionBy("__block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = (h.join(blocks, "__block")
          .withColumn("docs_longer", F.col("__d_after") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
          .withColumn("tokens_longer", F.col("__t_after") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))))
    kept = F.col("total_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")
    return h.select(
        "length", "n_docs", "n_tokens", "docs_longer", "tokens_longer",
        (F.col("total_docs") - F.col("docs_longer")).alias("docs_within"),
        kept.alias("tokens_kept"), (F.col("total_tokens") - kept).alias("tokens_lost"),
        "total_docs", "total_tokens",
        ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("quantile"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """Exact totals for any context limits, present as lengths or not: limit, docs_longer,
    tokens_kept, tokens_lost."""
    spark = hist.sparkSession
    if not limits:
        return spark.createDataFrame([], "limit long, docs_longer long, tokens_kept long, tokens_lost long")
    n, t = F.col("n_docs"), F.col("length")
    aggs = []
    for i, limit in enumerate(limits):
        longer = F.coalesce(F.sum(F.when(t > limit, n)), F.lit(0))
        kept = F.coalesce(F.sum(n * F.least(t, F.lit(limit).cast("long"))), F.lit(0))
        lost = F.coalesce(F.sum(n * F.greatest(t - limit, F.lit(0).cast("long"))), F.lit(0))
        aggs.append(F.struct(F.lit(limit).cast("long").alias("limit"), longer.alias("docs_longer"),
                             kept.alias("tokens_kept"), lost.alias("tokens_lost")))
    return hist.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def quantiles(hist: DataFrame, qs: list[float]) -> DataFrame:
    """Smallest length at most as long as which are a share ``q`` of the documents."""
    aggs = [F.struct(F.lit(float(q)).alias("q"), F.min(F.when(F.col("quantile") >= q, F.col("length"))).alias("length"))
            for q in qs]
    return hist.agg(F.array(*aggs).alias("a")).select(F.inline("a"))
