"""Surrogate keys (IDENTITY) and unknown members.

``dense_key`` numbers rows 1..n (plus an offset) in a given total order without a
one-partition window: a range layout (see ``ordered``) plus per-partition offsets, which are
bounded by the partition count.  The result equals ``row_number() OVER (ORDER BY order)``
whenever the order is total up to rows identical in every output column, which is how every
caller builds its order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ts_lit
from ..schemas import EPOCH, LONG, UNKNOWN_END, UNKNOWN_KEY, DimSpec
from .ordered import known_max_key, number_rows, range_layout


def dense_key(df: DataFrame, key_col: str, order: list[Column], start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start + row number in ``order`` (1-based), as bigint.

    One shuffle of the rows: the range layout.  Copies of a row are told apart by the number
    they were written with, so they spread over tasks like other rows.
    """
    cols = [c for c in df.columns if c != key_col]
    return number_rows(range_layout(df.select(*cols), order, num_partitions=num_partitions), key_col, start) \
        .select(F.col(key_col).cast(LONG).alias(key_col), *cols)


def next_key_base(target: DataFrame, key_col: str) -> int:
    """``greatest(max(key), 0)`` of the target: appends continue after the highest key ever used."""
    v = known_max_key(target)
    if v is None:
        v = target.agg(F.max(key_col)).first()[0]
    return max(int(v or 0), 0)


def unknown_member(spark, spec: DimSpec) -> DataFrame:
    """The -1 row of a dimension, typed like the gold table."""
    cols = [F.lit(UNKNOWN_KEY).cast(LONG).alias(spec.sk), F.lit(UNKNOWN_KEY).cast(T.IntegerType()).alias(spec.bk)]
    for a in spec.attrs:
        cols.append(F.lit(spec.unknown.get(a.name)).cast(a.dtype).alias(a.name))
    if spec.scd == 1:
        cols.append(F.lit(None).cast(T.TimestampNTZType()).alias(spec.date_col))
    else:
        cols += [ts_lit(EPOCH).alias("RowStartDateTime"), ts_lit(UNKNOWN_END).alias("RowEndDateTime"),
                 F.lit(True).alias("IsCurrent")]
    return spark.range(1).select(*cols)


def with_unknown(dim: DataFrame, spec: DimSpec) -> DataFrame:
    return dim.unionByName(unknown_member(dim.sparkSession, spec))
