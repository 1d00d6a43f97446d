"""SCD type 2: version timelines, full rebuild and increment with change detection."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import isnull_default, minus_one_second, ts_lit
from ..schemas import EPOCH, UNKNOWN_KEY, DimSpec
from .keys import next_key_base, with_unknown
from . import ordered
from .ordered import Versions, cache_deterministic, know_versions, known_versions, lead_by_key, lead_in_key, range_layout, written
from .sizing import broadcast_if_small


def timeline_order(spec: DimSpec) -> list[Column]:
    """Change date ascending with NULL first (SQL Server's order), then attributes ascending."""
    return [F.col(spec.date_col).asc_nulls_first()] + [F.col(a).asc_nulls_first() for a in spec.attr_names]


def scd2_timeline(rows: DataFrame, spec: DimSpec, key_start: int | None = None, frozen: bool = False) -> DataFrame:
    """One version per input row: start = ISNULL(date, 1900-01-01), end = next date - 1 s,
    current when there is no next date; with ``key_start`` also surrogate keys.

    ``LEAD`` over a NULL date cannot be told from "no next row": two NULL-dated rows of a key
    both stay current (kept on purpose; ``check_unique_bk`` reports it).  Equal dates give
    end = start - 1 s (kept).

    The rows are written once (unless ``frozen``: files, or a source that can be read again) and
    counted per key.  Where no key is hot, the LEAD is a window per key and surrogate keys go on
    from the rows of the keys before: one shuffle, none where the rows come partitioned by key.
    A hot key (more than ``ordered.KEY_MAX_ROWS`` rows) needs a range layout of (key, date NULLS
    FIRST, attributes): the LEAD is a window per range partition with a boundary fix-up (a key with a
    third of all rows is spread over many tasks, and so are copies of one row), and surrogate keys
    are positions in the same order.  Both give the same rows.  Of ``n``
    copies of a row, the first ``n - 1`` are followed by an equal row (end = date - 1 s, or open
    when the date is NULL) and the last by the next distinct row; the last takes the highest key
    of the run.
    """
    return _timeline(rows, spec, key_start, frozen)[0]


def _timeline(rows: DataFrame, spec: DimSpec, key_start: int | None, frozen: bool) -> tuple[DataFrame, int, int]:
    """(``scd2_timeline``, rows, rows of the key with the most)."""
    rows = rows.select(spec.bk, *spec.attr_names, spec.date_col)
    rows = rows if frozen else written(rows, "rows", tie=True)
    counts = cache_deterministic(rows.groupBy(spec.bk).count())
    n, most = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if most > ordered.KEY_MAX_ROWS:
        layout = range_layout(rows, [F.col(spec.bk).asc_nulls_first()] + timeline_order(spec), first_cols=[spec.bk, spec.date_col])
        versions = lead_in_key(layout, spec.bk, spec.date_col, "__next", with_row_number="__number")
    else:
        versions = lead_by_key(rows.drop(ordered.TIE), counts, spec.bk, timeline_order(spec), spec.date_col, "__next",
                               with_row_number="__number" if key_start is not None else None)
    nxt = F.col("__next")
    out = [spec.bk, *spec.attr_names,
           F.coalesce(F.col(spec.date_col), ts_lit(EPOCH)).alias("RowStartDateTime"),
           F.when(nxt.isNull(), F.lit(None)).otherwise(minus_one_second(nxt)).alias("RowEndDateTime"),
           nxt.isNull().alias("IsCurrent")]
    if key_start is not None:
        out = [(F.lit(key_start).cast("long") + F.col("__number")).alias(spec.sk), *out]
    return versions.select(*out), n, most


def scd2_full(stg: DataFrame, spec: DimSpec, add_unknown: bool = True, frozen: bool = False) -> DataFrame:
    """TRUNCATE + rebuild every version from staging; unchanged rows are *not* collapsed."""
    dim, n, most = _timeline(stg, spec, 0, frozen)
    dim = dim.select(*spec.gold_columns())
    return know_versions(with_unknown(dim, spec) if add_unknown else dim,
                         Versions(lambda: follow_each_other(stg, spec), n + 1, most + 1))


def follow_each_other(stg: DataFrame, spec: DimSpec) -> bool:
    """Whether ``scd2_full`` of these rows has no two versions of a key at one instant: a version ends
    before the next date, so only those without a date, which stay open, can overlap, and a key
    that is the unknown member's."""
    undated = stg.where(F.col(spec.date_col).isNull() | (F.col(spec.bk) == UNKNOWN_KEY)).groupBy(spec.bk).count()
    return undated.where((F.col("count") > 1) | (F.col(spec.bk) == UNKNOWN_KEY)).isEmpty()


def _differs(spec: DimSpec, left: str, right: str, collation: str | None):
    out = F.lit(False)
    for a in spec.attrs:
        t = isnull_default(f"{left}{a.name}", a.null_default, a.dtype)
        s = isnull_default(f"{right}{a.name}", a.null_default, a.dtype)
        if collation and a.null_default == "":
            t, s = F.collate(t, collation), F.collate(s, collation)
        out = out | (t != s)
    return out


def changed_rows(stg: DataFrame, target: DataFrame, spec: DimSpec, collation: str | None = None,
                 chain_compare: bool = False) -> DataFrame:
    """Staging rows that are new keys or differ from a current version in any attribute.

    NULL is equal to the attribute's default ('' for text, 0 for price).  Each staging row is
    compared with the *pre-load* current version, not with its predecessor in the batch, so
    A -> B -> A in one batch drops the last A (kept, as in the procedure).  A key with two
    current versions joins twice, so a row can appear twice (kept).
    ``chain_compare=True`` instead compares each row with the previous row of its key in the
    batch (by date, then attributes) and only the first one with the current version; the
    previous row comes from a LAG on the range layout (hot keys spread over tasks).
    ``collation`` (e.g. ``UTF8_LCASE_RTRIM``) switches text compares from binary.
    """
    cur = target.filter(F.col("IsCurrent")).select(
        F.col(spec.bk).alias("__bk"), F.col(spec.sk).alias("__sk"),
        *[F.col(a).alias(f"__t_{a}") for a in spec.attr_names])
    cur, _ = broadcast_if_small(cur)          # the current set, if measured small; else shuffled
    rows = stg.select(spec.bk, *spec.attr_names, spec.date_col)
    if chain_compare:
        rows = rows.withColumn("__v", F.struct(*[F.col(a).alias(a) for a in spec.attr_names]))
        backwards = ([F.col(spec.bk).asc_nulls_first(), F.col(spec.date_col).desc_nulls_last()]
                     + [F.col(a).desc_nulls_last() for a in spec.attr_names])
        layout = range_layout(rows, backwards, first_cols=[spec.bk, "__v"])
        rows = lead_in_key(layout, spec.bk, "__v", "__prev").select(
            spec.bk, *spec.attr_names, spec.date_col,
            *[F.col(f"__prev.{a}").alias(f"__p_{a}") for a in spec.attr_names], F.col("__prev").isNotNull().alias("__hasp"))
    j = rows.join(cur, F.col(spec.bk) == F.col("__bk"), "left")
    vs_current = F.col("__sk").isNull() | _differs(spec, "__t_", "", collation)
    keep = (F.when(F.col("__hasp"), _differs(spec, "__p_", "", collation)).otherwise(vs_current)
            if chain_compare else vs_current)
    return j.filter(keep).select(spec.bk, *spec.attr_names, spec.date_col)


def first_change(delta: DataFrame, spec: DimSpec) -> DataFrame:
    """``MIN(ModifiedDate) GROUP BY key``: partial aggregation map side, final after the shuffle."""
    return delta.groupBy(spec.bk).agg(F.min(spec.date_col).alias("FirstNewDate"))


def close_out(current: DataFrame, first: DataFrame, spec: DimSpec) -> DataFrame:
    """Current versions of touched keys end at first change - 1 s and stop being current.

    A touched key whose delta dates are all NULL gets end NULL and current = false (kept).
    """
    f = first.select(F.col(spec.bk).alias("__bk"), "FirstNewDate", F.lit(True).alias("__hit"))
    f, _ = broadcast_if_small(f)              # keys touched by the batch
    j = current.join(f, F.col(spec.bk) == F.col("__bk"), "left")
    hit = F.col("__hit").isNotNull() & F.col("IsCurrent")
    return j.select(
        spec.sk, spec.bk, *spec.attr_names, "RowStartDateTime",
        F.when(hit, minus_one_second("FirstNewDate")).otherwise(F.col("RowEndDateTime")).alias("RowEndDateTime"),
        F.when(hit, F.lit(False)).otherwise(F.col("IsCurrent")).alias("IsCurrent"))


def scd2_inc_parts(target: DataFrame, stg: DataFrame, spec: DimSpec, base: int | None = None,
                   collation: str | None = None, chain_compare: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows an increment produces: (former current versions, closed or not; new versions).

    Only current versions are read and joined.  ``base`` is the highest key ever issued (the
    publish manifest stores it); without it ``greatest(max(key), 0)`` is computed.
    """
    return scd2_apply(target, changed_delta(stg, target, spec, collation, chain_compare), spec, base)


def changed_delta(stg: DataFrame, target: DataFrame, spec: DimSpec, collation: str | None = None,
                  chain_compare: bool = False) -> DataFrame:
    """``changed_rows``, computed once for all that an increment does with them."""
    return cache_deterministic(changed_rows(stg, target, spec, collation, chain_compare))


def scd2_apply(target: DataFrame, delta: DataFrame, spec: DimSpec,
               base: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(former current versions, closed or not; new versions) of a filtered delta."""
    current = target.filter(F.col("IsCurrent"))
    closed = close_out(current, first_change(delta, spec), spec)
    if base is None:
        base = next_key_base(target, spec.sk)
    inserted = scd2_timeline(delta, spec, key_start=base, frozen=True)     # the delta is computed once
    cols = spec.gold_columns()
    return closed.select(*cols), inserted.select(*cols)


def scd2_inc(target: DataFrame, stg: DataFrame, spec: DimSpec, collation: str | None = None,
             chain_compare: bool = False) -> DataFrame:
    """Increment: change filter -> close current versions -> append the batch's own timeline.

    Historical versions pass through untouched (with the gold layout split by IsCurrent they
    are never rewritten).  New versions get keys after ``greatest(max(key), 0)``; old keys
    never change.
    """
    delta = changed_delta(stg, target, spec, collation, chain_compare)
    closed, inserted = scd2_apply(target, delta, spec)
    history = target.filter(~F.col("IsCurrent")).select(*spec.gold_columns())
    return know_versions(history.unionByName(closed).unionByName(inserted),
                         Versions(lambda: _goes_on(known_versions(target), closed, delta, spec)))


def _goes_on(before: Versions | None, closed: DataFrame, delta: DataFrame, spec: DimSpec) -> bool:
    """Whether an increment of versions that don't overlap left none that do: its own follow each other, and
    none starts before the version that it ends (whose key has no other that is open)."""
    if before is None or not before.disjoint or not follow_each_other(delta, spec):
        return False
    ended = closed.where(~F.col("IsCurrent"))
    early = F.col("RowEndDateTime").isNull() | (F.col("RowEndDateTime") + F.expr("INTERVAL 1 SECOND") < F.col("RowStartDateTime"))
    return ended.where(early).isEmpty() and delta.where(F.col(spec.date_col).isNull()).isEmpty()
