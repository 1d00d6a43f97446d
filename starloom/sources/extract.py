"""Extraction from the lake into staging (full copy, bounded and unbounded deltas, backfill).

Filters are plain Column predicates on the *source* column, so Catalyst pushes them into the
Parquet scan (row-group skipping) and prunes every column the staging projection does not use.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col_of, ts_lit


def read_source(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | None = None, **options) -> DataFrame:
    """Read a gold-lake file set as Parquet or CSV.

    CSV always takes an explicit schema (no inference pass over the data) and FAILFAST, so a
    malformed row aborts the load rather than turning into NULLs.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV sources need an explicit schema")
        reader = reader.option("header", "true").option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def window_predicate(c, lo: str | None = None, hi: str | None = None) -> Column:
    """``c > lo AND c <= hi`` with either bound optional; NULL values never pass a bound."""
    c = col_of(c)
    pred = F.lit(True)
    if lo is not None:
        pred = pred & (c > ts_lit(lo))
    if hi is not None:
        pred = pred & (c <= ts_lit(hi))
    return pred


def extract_full(df: DataFrame, date_col: str | None = None, cutoff: str | None = None) -> DataFrame:
    """Full copy; with ``cutoff`` only rows up to and including it (the first load's window)."""
    if date_col is None or cutoff is None:
        return df
    return df.filter(window_predicate(date_col, None, cutoff))


def extract_delta(df: DataFrame, date_col: str, lo: str, hi: str | None = None) -> DataFrame:
    """Half-open window ``(lo, hi]``; ``hi=None`` is the older unbounded form ``> lo``."""
    return df.filter(window_predicate(date_col, lo, hi))


@dataclass(frozen=True)
class LakeSource:
    """A file set of the lake: where it is, how it is read, and its change date (if it has one)."""
    path: str
    fmt: str = "parquet"
    schema: T.StructType | None = None
    date_col: str | None = "ModifiedDate"


def lake_extractor(spark: SparkSession, sources: dict[str, LakeSource]):
    """``extract(name, lo, hi)`` over the lake, as the load runner takes it: without bounds a
    full copy, else the rows changed in ``(lo, hi]``."""
    def extract(name: str, lo: str | None, hi: str | None) -> DataFrame:
        s = sources[name]
        df = read_source(spark, s.path, s.fmt, s.schema)
        if lo is None:
            return extract_full(df, s.date_col, hi)
        if s.date_col is None:
            return df                            # no change date: every increment sees all rows
        return extract_delta(df, s.date_col, lo, hi)
    return extract


def backfill_by_year(df: DataFrame, date_col: str) -> DataFrame:
    """Historical load sliced by calendar year of the change date.

    Instead of one job per year the slice is a column: written with
    ``partitionBy("load_year")`` and dynamic partition overwrite, each year is replaced on its
    own and a rerun of one year touches only that folder.  Rows with a NULL date have no year
    and are left for the full load, as a bounded window would leave them.
    """
    return (df.filter(col_of(date_col).isNotNull())
              .withColumn("load_year", F.year(col_of(date_col)).cast(T.IntegerType())))


def stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """TRUNCATE + copy: overwrite the staging folder, then read it back from storage."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_backfill(df: DataFrame, path: str) -> None:
    """Write year slices; only the years present in ``df`` are replaced."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("load_year").parquet(path))
