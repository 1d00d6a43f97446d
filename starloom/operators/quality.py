"""Data-quality checks standing in for the constraints Parquet cannot enforce.

Each check returns the *violating* rows as a DataFrame (empty = pass), so it can feed a
quarantine table, and ``assert_empty`` turns one into a load failure.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ts_lit
from ..schemas import LOAD_TYPES, OPEN_END, DimSpec, FactSpec
from .ordered import lead_in_key, range_layout
from .sizing import broadcast_if_small


class QualityError(RuntimeError):
    pass


def check_unique_bk(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """SCD1: more than one row per business key.  SCD2: more than one *current* row per key.

    A grouped count: partial aggregation runs map side, so a hot key costs one row per task.
    """
    rows = dim if spec.scd == 1 else dim.filter(F.col("IsCurrent"))
    return (rows.groupBy(spec.bk).agg(F.count(F.lit(1)).alias("rows_per_key"))
                .filter(F.col("rows_per_key") > 1))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a NULL in any required column (the quarantine set), tagged with the first one."""
    first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.withColumn("failed_column", first_null).filter(F.col("failed_column").isNotNull())


def check_fk(fact: DataFrame, dims: dict[str, DataFrame], spec: FactSpec) -> DataFrame:
    """Fact rows whose surrogate key is missing from its dimension, as (fact key, dimension,
    missing key).  One pass over the fact: each dimension's distinct keys are joined (broadcast
    when measured small) with a presence flag, and missing flags are exploded at the end."""
    out = fact.select(spec.sk, *[d.sk for _, d in spec.lookups])
    for i, (_, d) in enumerate(spec.lookups):
        keys = dims[d.table].select(F.col(d.sk).alias(f"__k{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        keys, _ = broadcast_if_small(keys)
        out = out.join(keys, out[d.sk] == keys[f"__k{i}"], "left").drop(f"__k{i}")
    misses = F.array(*[F.when(F.col(f"__hit{i}").isNull(),
                              F.struct(F.lit(d.table).alias("dimension"), F.col(d.sk).alias("missing_key")))
                       for i, (_, d) in enumerate(spec.lookups)])
    return (out.select(spec.sk, F.explode(F.filter(misses, lambda m: m.isNotNull())).alias("__m"))
               .select(spec.sk, "__m.dimension", "__m.missing_key"))


def check_domain(df: DataFrame, col: str = "LOADTYPE", allowed=LOAD_TYPES) -> DataFrame:
    """Rows whose value is outside the allowed set (NULL passes, as a CHECK constraint does)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))


def check_overlap(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Versions of a key whose successor (by start, then key) starts at or before this
    version's end.  The successor comes from the range layout's LEAD, so a key with very many
    versions is spread over many tasks."""
    end = F.coalesce(F.col("RowEndDateTime"), ts_lit(OPEN_END))
    rows = dim.select(spec.sk, spec.bk, "RowStartDateTime", "RowEndDateTime",
                      F.struct(F.col("RowStartDateTime").alias("s"), F.col(spec.sk).alias("k")).alias("__v"))
    layout = range_layout(rows, [F.col(spec.bk).asc_nulls_first(), F.col("RowStartDateTime").asc_nulls_first(),
                                 F.col(spec.sk).asc_nulls_first()], first_cols=[spec.bk, "__v"])
    nxt = lead_in_key(layout, spec.bk, "__v", "__next")
    return (nxt.filter(F.col("__next").isNotNull() & (F.col("__next.s") <= end))
               .select(spec.sk, spec.bk, "RowStartDateTime", "RowEndDateTime",
                       F.col("__next.k").alias("next_key"), F.col("__next.s").alias("next_start")))


def assert_empty(violations: DataFrame, what: str) -> None:
    row = violations.limit(1).collect()
    if row:
        raise QualityError(f"{what} failed, e.g. {row[0].asDict()}")
