"""Fact loads: full rebuild and idempotent increment (delete by trip id, re-insert)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ts_lit
from ..schemas import LONG, FactSpec
from .keys import dense_key, next_key_base
from .lookup import large_lookups, one_match, prepare_sides, small_lookups, star_lookup, star_lookup_by, time_bounds
from .ordered import TIE, cache_deterministic, is_files, key_offsets, know_max_key, known_max_key, written
from .sizing import BROADCAST_MAX_BYTES, broadcast_if_small

# Above this many rows of one trip, a full load does not go trip by trip.
TRIP_MAX_ROWS = 256


def fact_key_order(spec: FactSpec) -> list[Column]:
    """Keys follow every output column except the load time, so the numbering is total."""
    cols = [spec.id_col, *[d.sk for _, d in spec.lookups], *spec.measures, spec.time_col]
    return [F.col(c).asc_nulls_first() for c in cols]


def resolve_keys(stg: DataFrame, dims: dict[str, DataFrame], spec: FactSpec, load_ts: str,
                 pit_strategy: str = "auto", prepared: list | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Star lookup of all dimension keys; duplicates in staging are kept.  ``prepared``: the
    ``prepare_sides`` of ``dims``; ``more``: staging columns to keep beside the fact's."""
    return fact_rows(star_lookup(stg, dims, spec.lookups, spec.time_col, pit_strategy, prepared=prepared), spec, load_ts, *more)


def fact_rows(looked: DataFrame, spec: FactSpec, load_ts: str, *more: str) -> DataFrame:
    """What a fact holds of trips that have their dimensions' keys, and the columns ``more``."""
    return looked.select(spec.id_col, *[d.sk for _, d in spec.lookups], *spec.measures,
                         spec.time_col, ts_lit(load_ts).alias("LoadDateTime"), *more)


def fact_full(stg: DataFrame, dims: dict[str, DataFrame], spec: FactSpec, load_ts: str,
              pit_strategy: str = "auto", prepared: list | None = None, frozen: bool = False,
              max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """TRUNCATE + INSERT: keys restart at 1.  ``frozen``: staging is files."""
    return keyed_facts(stg, dims, spec, load_ts, 0, pit_strategy, prepared, frozen, max_broadcast_bytes)


def keyed_facts(stg: DataFrame, dims: dict[str, DataFrame], spec: FactSpec, load_ts: str, start: int,
                pit_strategy: str = "auto", prepared: list | None = None, frozen: bool = False,
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Staged trips as facts, with keys after ``start``.

    Facts that have to be shuffled to meet a dimension are looked up and numbered trip by trip
    (``star_lookup_by``): one shuffle of whole rows, and none is written on the way.  Where
    trips have no id or very many rows, or a row may meet several versions, whole rows are
    shuffled for every large dimension and laid out in key order to be numbered."""
    prepared = prepared or prepare_sides(dims, spec.lookups, max_broadcast_bytes)
    large = large_lookups(spec.lookups, prepared, max_broadcast_bytes)
    if large:
        stg = stg if frozen else written(stg, "facts", tie=True)
        args = dims, spec.lookups, spec.time_col
        bounds = pit_strategy, max_broadcast_bytes, prepared
        # A large dimension gives a row one key, so trips have the rows that the others give them.
        t, n = spec.time_col, F.count(F.lit(1))
        trips = cache_deterministic(small_lookups(stg, *args, large, *bounds).groupBy(spec.id_col).agg(
            n.alias("count"), (F.count(t).isin(F.lit(0), n) & F.min(t).eqNullSafe(F.max(t))).alias("one_time")))
        most, no_id, one_time, total = trips.agg(F.max("count"), F.max(F.col(spec.id_col).isNull()), F.min("one_time"), F.sum("count")).first()
        if (most or 0) <= TRIP_MAX_ROWS and not no_id and all(one_match(prepared[i]) for i in large):
            looked = star_lookup_by(stg, *args, spec.id_col, large, *bounds, one_time=one_time)
            return know_max_key(_numbered_by_trip(fact_rows(looked, spec, load_ts), trips, spec, start), start + (total or 0))
    looked = star_lookup(stg, dims, spec.lookups, spec.time_col, pit_strategy, max_broadcast_bytes, prepared)
    rows = fact_rows(looked, spec, load_ts)
    return dense_key(rows, spec.sk, fact_key_order(spec), start=start).select(*spec.gold_columns())


def _numbered_by_trip(rows: DataFrame, trips: DataFrame, spec: FactSpec, start: int = 0) -> DataFrame:
    """Keys as ``dense_key`` gives them in ``fact_key_order``: a trip's go on from the rows of the trips
    before.  ``trips`` is (trip id, count)."""
    # Trips are there once, so they need no number to tell copies apart, nor to be written for it.
    trips = trips.withColumn(TIE, F.lit(0).cast(LONG))
    before = key_offsets(trips, spec.id_col, "count", "__before").withColumnRenamed(spec.id_col, "__trip")
    within = Window.partitionBy(spec.id_col).orderBy(*fact_key_order(spec))
    return rows.join(before, F.col(spec.id_col) == F.col("__trip")) \
        .withColumn(spec.sk, (F.lit(start) + F.col("__before") + F.row_number().over(within)).cast(LONG)).select(*spec.gold_columns())


def delete_matching(target: DataFrame, stg: DataFrame, spec: FactSpec,
                    max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Drop every target row whose trip id appears in staging (all its rows, by id only).

    The distinct ids are a semi-join side: broadcast when measured small, else shuffled.
    A NULL id never matches, as in the DELETE ... INNER JOIN.
    """
    ids = stg.select(F.col(spec.id_col).alias("__id")).filter(F.col("__id").isNotNull()).distinct()
    ids, _ = broadcast_if_small(ids, max_broadcast_bytes)
    return target.join(ids, target[spec.id_col] == ids["__id"], "left_anti")


def fact_inc(target: DataFrame, stg: DataFrame, dims: dict[str, DataFrame], spec: FactSpec,
             load_ts: str, pit_strategy: str = "auto") -> DataFrame:
    """Delete by trip id, then insert the batch with keys after the highest key ever issued
    (taken *before* the delete - identity values are never reused).  Target and batch are read
    several times, so they are written unless they are files (or the target's keys are counted)."""
    if not is_files(target) and known_max_key(target) is None:
        target = written(target, "target")
    stg = stg if is_files(stg) else written(stg, "facts", tie=True)
    base = next_key_base(target, spec.sk)
    kept = delete_matching(target, stg, spec)
    span = time_bounds(stg, spec.time_col)
    new = keyed_facts(stg, dims, spec, load_ts, base, pit_strategy, prepare_sides(dims, spec.lookups, span=span), frozen=True)
    cols = spec.gold_columns()
    return kept.select(*cols).unionByName(new.select(*cols))
