"""Table loads wired to storage: the full and incremental run over all seven tables.

``bulk_load_all`` / ``incremental_load_all`` read the control table, run tiers in order
(SCD1, then SCD2, then the fact; tables of a tier concurrently), and publish each table with
its watermark atomically.  Each load is one table's Spark job; dispatch is on LOADTYPE.
"""
from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fact as fact_ops
from ..operators import scd1, scd2
from ..operators.lookup import prepare_sides, time_bounds
from ..operators.ordered import TIE, mark_files, written
from ..operators.quality import assert_empty, check_not_null
from ..schemas import DIMS, EPOCH, FACTTRIP, DimSpec
from . import publish as P
from .control import control_seed, run_tiers

# extract(staging_name, lo, hi) -> staging DataFrame for the window (lo, hi]; without bounds the
# whole source, rows without a change date included
Extractor = Callable[[str, str | None, str | None], DataFrame]


def _cutoff(cutoffs: dict[str, str] | str, table: str) -> str:
    return cutoffs if isinstance(cutoffs, str) else cutoffs[table]


def check_keys(stg: DataFrame, cols: list[str], table: str, root: str | None = None,
                on_null_key: str = "fail") -> DataFrame:
    """NOT NULL business keys.  ``fail``: a NULL key fails the load, as the gold table would
    refuse it.  ``quarantine``: the offending rows are written under ``<root>/_quarantine``
    and the load goes on with the rest."""
    bad = check_not_null(stg, cols)
    if on_null_key == "fail":
        assert_empty(bad.select(*cols), f"{table}: NOT NULL business key")
        return stg
    bad.write.mode("append").parquet(f"{root.rstrip('/')}/_quarantine/{table}")
    keep = F.lit(True)
    for c in cols:
        keep = keep & F.col(c).isNotNull()
    return stg.filter(keep)


def _advance_watermark_only(spark, root, table, old, cutoff, now) -> dict:
    """An empty delta publishes no data: only the watermark moves, and never back (the EXISTS gate)."""
    m = dict(old, watermark=P.later(old["watermark"], cutoff), updated_at=now)
    P.write_manifest(spark, root, table, m)
    return m


@contextlib.contextmanager
def staged(extract_rows: DataFrame, root: str, table: str, near: list[str] | None = None, tie: bool = False):
    """Freeze an extract in the staging folder, so that everything a load does reads the same
    rows; the folder is emptied when the load is over.  Rows alike in ``near`` are put side by side
    in a file: they take less room there and in the shuffles that follow.  With ``tie`` rows get
    ``ordered.TIE``, a number of their own."""
    spark = extract_rows.sparkSession
    path = f"{root.rstrip('/')}/_staging/{table}/{uuid.uuid4().hex}"
    rows = extract_rows.sortWithinPartitions(*near) if near else extract_rows
    rows = rows.withColumn(TIE, F.monotonically_increasing_id()) if tie else rows
    rows.write.option("compression", "zstd").parquet(path)
    try:
        yield mark_files(spark.read.schema(rows.schema).parquet(path))
    finally:
        P.delete_path(spark, path)


def star(spark, root: str, span=None) -> tuple[dict[str, DataFrame], list]:
    """The fact's dimensions as published, and their lookup sides; ``span``: (min, max) of the facts' times."""
    dims = {s.table: P.read_table(spark, root, s.table) for _, s in FACTTRIP.lookups}
    disjoint = {t for t in dims if P.read_manifest(spark, root, t).get("disjoint")}
    return dims, prepare_sides(dims, FACTTRIP.lookups, frozen=True, disjoint=disjoint, span=span)


def _load_all_rows(spark, kind: str, table: str, stg: DataFrame, root, cutoff, now, on_null_key) -> dict:
    if kind == "FACT":
        stg = check_keys(stg, [FACTTRIP.id_col], table, root, on_null_key)
        dims, sides = star(spark, root)
        return P.publish_fact_full(fact_ops.fact_full(stg, dims, FACTTRIP, now, prepared=sides, frozen=True), root, FACTTRIP, cutoff, now)
    if kind not in ("SCD1", "SCD2"):
        raise ValueError(f"unknown LOADTYPE {kind!r} for {table}")
    spec = DIMS[table]
    stg = check_keys(stg, [spec.bk], table, root, on_null_key)
    if kind == "SCD1":
        return P.publish_full(scd1.scd1_full(stg, spec), root, table, spec.sk, cutoff, now)
    return P.publish_scd2_full(scd2.scd2_full(stg, spec, frozen=True), root, spec, cutoff, now,
                               {"disjoint": scd2.follow_each_other(stg, spec)})


def full_load_table(spark: SparkSession, row: dict, extract: Extractor, root: str, cutoff: str, now: str,
                    on_null_key: str = "fail") -> dict:
    """TRUNCATE + load of everything the source holds (no date bound, so rows without a change
    date are in); ``cutoff`` is the watermark the next increment starts from."""
    table = row["TABLENAME"]
    near = [DIMS[table].bk, DIMS[table].date_col] if table in DIMS else None
    with staged(extract(row["STAGINGTABLENAME"], None, None), root, table, near) as stg:
        return _load_all_rows(spark, row["LOADTYPE"], table, stg, root, cutoff, now, on_null_key)


def inc_load_table(spark: SparkSession, row: dict, extract: Extractor, root: str, cutoff: str, now: str,
                   on_null_key: str = "fail") -> dict:
    """Increment of the window (watermark, cutoff].  A table that was never published starts
    from the epoch, as the procedures do on an empty target."""
    table, kind = row["TABLENAME"], row["LOADTYPE"]
    old = P.read_manifest(spark, root, table)
    with staged(extract(row["STAGINGTABLENAME"], old["watermark"] if old else EPOCH, cutoff), root, table, tie=kind == "FACT") as stg:
        if old is None:
            return _load_all_rows(spark, kind, table, stg, root, cutoff, now, on_null_key)
        if stg.isEmpty():
            return _advance_watermark_only(spark, root, table, old, cutoff, now)
        if kind in ("SCD1", "SCD2"):
            spec: DimSpec = DIMS[table]
            stg = check_keys(stg, [spec.bk], table, root, on_null_key)
            target = P.read_table(spark, root, table)
            if kind == "SCD1":
                merged = scd1.scd1_merge(target, stg, spec, base=old["max_key"])
                return P.publish_full(merged, root, table, spec.sk, cutoff, now)
            delta = scd2.changed_delta(stg, target, spec)
            if delta.isEmpty():                  # nothing but unchanged rows
                return _advance_watermark_only(spark, root, table, old, cutoff, now)
            closed, inserted = scd2.scd2_apply(target, delta, spec, base=old["max_key"])
            return P.publish_scd2_increment(closed, inserted, root, spec, cutoff, now)
        if kind == "FACT":
            stg = check_keys(stg, [FACTTRIP.id_col], table, root, on_null_key)
            dims, sides = star(spark, root, time_bounds(stg, FACTTRIP.time_col))
            new = fact_ops.keyed_facts(stg, dims, FACTTRIP, now, old["max_key"], prepared=sides, frozen=True)
            new = written(new, "new")            # read for its months and its rows
            return P.publish_fact_increment(stg, new, root, FACTTRIP, cutoff, now)
        raise ValueError(f"unknown LOADTYPE {kind!r} for {table}")


def bulk_load_all(spark: SparkSession, extract: Extractor, root: str, cutoffs, now: str, max_parallel: int = 3,
                  on_null_key: str = "fail", control: DataFrame | None = None) -> list[dict]:
    """Full loads of the active rows of ``control`` (the seeded control table if not given)."""
    control = control if control is not None else control_seed(spark, "full")
    return run_tiers(control, lambda r: full_load_table(spark, r, extract, root, _cutoff(cutoffs, r["TABLENAME"]),
                                                        now, on_null_key), max_parallel)


def incremental_load_all(spark: SparkSession, extract: Extractor, root: str, cutoffs, now: str, max_parallel: int = 3,
                         on_null_key: str = "fail", control: DataFrame | None = None) -> list[dict]:
    """Increments of the active rows of ``control`` (the seeded control table if not given)."""
    control = control if control is not None else control_seed(spark, "incremental")
    return run_tiers(control, lambda r: inc_load_table(spark, r, extract, root, _cutoff(cutoffs, r["TABLENAME"]),
                                                       now, on_null_key), max_parallel)
