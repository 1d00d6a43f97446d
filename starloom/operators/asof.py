"""Point-in-time lookup as a merge in time order: linear, without copies of versions.

Version starts and fact times go into one order by (key, time), in which every fact row takes the
last version row before it.  Where no key is hot that is a window per key: one shuffle.

With a hot key they go into a range layout: the rows of a key with
most of the facts, or most of the versions, are spread over many tasks, and rows alike in key
and time are split by a written number.  Inside a range partition every fact row takes the last
version row before it.  What a partition can't see, the last version of a key that began in an
earlier partition, is carried over its border: one row per partition.

A fact row gets one version, so the versions of a key must not overlap; then the last version
to start at or before an instant is the only one that can hold it, and the result is that of the
interval join.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import UNKNOWN_KEY
from . import ordered
from .ordered import PID, POS, lead_by_key, lead_in_key, range_layout

# Columns of a lookup side: key, surrogate key, start, end (never NULL).
_KEY, _SK, _START, _END = "__lk", "__lsk", "__ls", "__le"


def _ends(half_open: bool):
    """The first instant after a version's end at which another may start."""
    return F.col(_END) + F.expr("INTERVAL 1 SECOND") if half_open else F.col(_END)


def _not_empty(side: DataFrame, half_open: bool) -> DataFrame:
    """Versions that hold any instant (equal change dates leave some that hold none)."""
    holds = F.col(_START) < _ends(True) if half_open else F.col(_START) <= F.col(_END)
    return side.where(F.col(_KEY).isNotNull() & holds)


def versions_overlap(side: DataFrame, half_open: bool = False, most: int | None = None) -> bool:
    """Whether some instant of some key lies in two versions: a version that starts before the
    one before it (of those that hold any instant) has ended.  ``most``: versions of the key with
    the most, if known."""
    versions = _not_empty(side, half_open).select(_KEY, _START, _END)
    if most is not None and most <= ordered.KEY_MAX_ROWS:
        following = lead_by_key(versions, None, _KEY, [F.col(_START).asc(), F.col(_END).asc()], _START, "__next")
    else:
        layout = range_layout(versions, [F.col(c).asc() for c in (_KEY, _START, _END)], first_cols=[_KEY, _START])
        following = lead_in_key(layout, _KEY, _START, "__next")
    meets = F.col("__next") < _ends(True) if half_open else F.col("__next") <= F.col(_END)
    return not following.where(meets).isEmpty()


def _carried(layout_rows: DataFrame) -> DataFrame:
    """(PID, key and version that are current when the partition begins), one row per partition."""
    key, version = F.col("__k"), F.struct(_SK, _END)
    ends = layout_rows.groupBy(PID).agg(
        F.max_by("__k", POS).alias("last_key"), F.min_by("__k", POS).alias("first_key"),
        F.max_by(F.struct(key.alias("k"), version.alias("v")), F.when(F.col(_END).isNotNull(), F.col(POS))).alias("last"))
    rows, at, state = [], None, None
    for r in sorted(ends.collect(), key=lambda r: r[PID]):
        rows.append((r[PID], at, *(state or (None, None))))
        if r["last"] is not None and r["last"]["k"] == r["last_key"]:
            state = tuple(r["last"]["v"])        # its last key has a version in here
        elif not (at is not None and at == r["first_key"] == r["last_key"]):
            state = None                         # another key began, without a version
        at = r["last_key"]
    types = dict(layout_rows.dtypes)
    return layout_rows.sparkSession.createDataFrame(
        rows, f"{PID} int, __ck {types['__k']}, __csk {types[_SK]}, __ce {types[_END]}")


def merge_as_of(fact: DataFrame, side: DataFrame, fact_bk: str, time_col: str, sk: str,
                half_open: bool = False, most: int | None = None) -> DataFrame:
    """``fact`` with ``sk``: the surrogate key of the version of ``side`` (see ``lookup._pit_side``)
    that holds the row's time, else -1.  Fact rows without a key or time match nothing.  ``most``:
    rows, facts and versions, of the key with the most, if known."""
    versions = _not_empty(side, half_open).select(
        F.col(_KEY).alias("__k"), F.col(_START).alias("__t"), F.coalesce(_SK, F.lit(UNKNOWN_KEY)).cast("bigint").alias(_SK), _END)
    # Key and time travel once, and a version is told by its end: nothing else is shuffled.
    facts = fact.withColumns({"__k": F.col(fact_bk), "__t": F.col(time_col)}).drop(fact_bk, time_col)
    again = {c: F.col(to).cast(fact.schema[c].dataType).alias(c) for c, to in ((fact_bk, "__k"), (time_col, "__t"))}
    rows = facts.unionByName(versions, allowMissingColumns=True)
    # At one instant versions come before facts, and of versions the last to end comes last.
    order = [F.col("__t").asc_nulls_first(), F.col(_END).asc_nulls_last()]

    def last(c, within):
        return F.last(c, ignorenulls=True).over(within)
    if most is not None and most <= ordered.KEY_MAX_ROWS:
        within = Window.partitionBy("__k").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = rows.withColumns({"__vsk": last(_SK, within), "__ve": last(_END, within)})
    else:
        layout = range_layout(rows, [F.col("__k").asc_nulls_first(), *order])
        within = Window.partitionBy(PID, "__k").orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carries = F.col("__ck") == F.col("__k")
        placed = layout.rows.join(F.broadcast(_carried(layout.rows)), PID).withColumns(
            {"__vsk": F.coalesce(last(_SK, within), F.when(carries, F.col("__csk"))),
             "__ve": F.coalesce(last(_END, within), F.when(carries, F.col("__ce")))})
    t, end = F.col("__t"), F.col("__ve")
    holds = t < end + F.expr("INTERVAL 1 SECOND") if half_open else t <= end
    key = F.coalesce(F.when(holds, F.col("__vsk")), F.lit(UNKNOWN_KEY)).cast("bigint")
    return placed.where(F.col(_END).isNull()).select(*[again.get(c, F.col(c)) for c in fact.columns], key.alias(sk))
