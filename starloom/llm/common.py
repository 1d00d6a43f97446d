"""Helpers shared by the training-data operators: staging, table access, text in tasks."""
from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to Python: bounds a worker's memory by this many texts.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: lineage is
    cut, and a lost executor costs a re-read, never a recomputation that could number or
    partition rows differently."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    fs, hpath = _file_system(df.sparkSession, path)
    fs.deleteOnExit(hpath)                       # unless ``unstage`` comes first
    return staged


def _file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def lowest_hashes(n: int, wanted: int) -> int:
    """A bound of a 64-bit hash of ids below which more than ``wanted`` of ``n`` ids lie (all of
    them if there are no more), though not many more."""
    share = min(1.0, (1.5 * wanted + 100) / max(n, 1))
    return 2 ** 63 - 1 if share == 1 else int(-2 ** 63 + share * 2 ** 64)


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids: bucket of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def text_chunks(texts: list[str], limit: int = 1 << 20, overlap: int = 0):
    """Yield ``(rows, joined text, starts)`` covering every text whole, at most about ``limit``
    characters at a time.  A longer text comes in several chunks, each repeating the last
    ``overlap`` characters of the one before, so sums over windows of ``overlap + 1``
    characters add up to those of the whole text."""
    rows, parts, size = [], [], 0
    for i, t in enumerate(texts):
        pos = 0
        while True:
            cut = t[pos:pos + limit]
            rows.append(i)
            parts.append(cut)
            size += len(cut)
            if size >= limit:
                yield rows, parts
                rows, parts, size = [], [], 0
            pos += limit
            if pos >= len(t):
                break
            pos -= overlap
    if rows:
        yield rows, parts


def unstage(df: DataFrame) -> None:
    """Delete a staged table that no later job reads."""
    fs, path = _file_system(df.sparkSession, df._staged_at)
    fs.delete(path, True)
