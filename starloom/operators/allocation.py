"""Costs of a period spread over the trips that caused them, to the cent.

Each trip gets the whole cents of its share by weight; the cents that are left go one each to
the trips with the largest remainders.  Parts sum to the period's cost exactly, whatever the
weights, and the arithmetic is on whole numbers throughout.

Periods of at most ``ordered.KEY_MAX_ROWS`` trips (counted) are windows: a period's cost goes to the
task of its trips, which are shuffled once and not written.  A larger period may hold most of the
trips (one fleet-wide bill, say): then remainders are not ranked inside a period, but all trips
stand in one range layout by (period, remainder, order) and a trip's rank is its position less
that of its period's first trip.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import scaled_to_decimal
from . import ordered
from .ordered import most_rows, number_rows, range_layout, written
from .sizing import broadcast_if_small

_WHOLE = T.DecimalType(38, 0)


def _cents(c):
    return F.round(F.col(c) * 100).cast(T.DecimalType(18, 0))


def _shares() -> tuple[dict, dict]:
    """Whole cents and the remainder of each part's share, from its weight and its period's totals."""
    even = F.col("__total") == 0
    whole = F.when(even, F.col("__n").cast(_WHOLE)).otherwise(F.col("__total").cast(_WHOLE))
    part = F.abs("__owed").cast(T.DecimalType(18, 0)) * F.when(even, 1).otherwise(F.col("__w")).cast(T.DecimalType(18, 0))
    return {"__whole": whole, "__part": part.cast(_WHOLE)}, {"__cents": F.expr("__part div __whole"), "__rest": F.expr("__part % __whole")}


def _share(one_more):
    """The share, with one of the cents that are left where ``one_more``."""
    cents = F.signum("__owed").cast("long") * (F.col("__cents") + F.when(one_more, 1).otherwise(0))
    return F.coalesce(scaled_to_decimal(cents, 2), F.lit(0).cast("decimal(18,2)"))


def allocate(parts: DataFrame, costs: DataFrame, period: list[str], weight: str, order: list[str], out: str,
             amount: str = "Amount", most: int | None = None) -> DataFrame:
    """``parts`` with ``out``: each one's share of its period's ``amount`` in ``costs`` (one row
    per ``period``), decimal(18,2).

    Shares follow ``weight`` (decimal with at most two digits; NULL and negative count as 0); a
    period whose weights are all 0 is spread evenly.  Equal remainders are served in ascending
    ``order``.  A part whose period has no cost gets 0; a cost without any part is left over (see
    ``unallocated``).  NULLs in the period are one value, as in GROUP BY.  Negative amounts
    (refunds) are spread like positive ones.  ``most``: parts of the period with the most, if known.
    """
    cols = parts.columns
    w = F.greatest(F.coalesce(_cents(weight), F.lit(0).cast(T.DecimalType(18, 0))), F.lit(0).cast(T.DecimalType(18, 0)))
    owed = costs.groupBy(*period).agg(F.sum(amount).cast("decimal(18,2)").alias("__amount"))
    weighted = parts.withColumn("__w", w)
    most = most_rows(parts, *period) if most is None else most
    if most <= ordered.KEY_MAX_ROWS and all(owed.schema[p].dataType == parts.schema[p].dataType for p in period):
        return _by_window(weighted, owed, period, order).select(*cols, _share(F.col("__at") <= F.col("__left")).alias(out))
    numbered = _by_layout(weighted, owed, period, order)
    return numbered.select(*cols, _share(F.col("__at") - F.col("__first") < F.col("__left")).alias(out))


def _by_window(weighted: DataFrame, owed: DataFrame, period: list[str], order: list[str]) -> DataFrame:
    """Parts with their cents, rank by remainder (``__at``) and what is left of their period."""
    bills = owed.select(*period, _cents("__amount").alias("__owed"), F.lit(True).alias("__bill"))
    rows = weighted.withColumn("__bill", F.lit(False)).unionByName(bills, allowMissingColumns=True)
    each = Window.partitionBy(*period)
    divisors, shares = _shares()
    shared = rows.withColumns({"__total": F.sum("__w").over(each), "__n": F.count(F.when(~F.col("__bill"), 1)).over(each),
                               "__owed": F.max("__owed").over(each)}) \
        .where(~F.col("__bill")).withColumns(divisors).withColumns(shares).drop("__part", "__whole", "__total", "__n", "__w", "__bill")
    ranked = each.orderBy(F.col("__rest").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in order])
    return shared.withColumns({"__at": F.row_number().over(ranked),
                               "__left": (F.abs("__owed") - F.sum("__cents").over(each)).cast("long")})


def _by_layout(weighted: DataFrame, owed: DataFrame, period: list[str], order: list[str]) -> DataFrame:
    """Parts with their cents, their position by period and remainder (``__at``), their period's first
    position and what is left of it."""
    rows = written(weighted, "parts", tie=True)      # the layout goes on from these numbers
    totals = rows.groupBy(*period).agg(F.sum("__w").alias("__total"), F.count(F.lit(1)).alias("__n"))
    side = totals.select(*[F.col(p).alias(f"__t_{p}") for p in period], "__total", "__n") \
        .join(owed, _same(period, "__t_"), "inner") \
        .select(*[F.col(p).alias(f"__p_{p}") for p in period], "__total", "__n", _cents("__amount").alias("__owed"))
    side, _ = broadcast_if_small(written(side, "periods"))
    divisors, shares = _shares()
    shared = rows.join(side, _same(period, "__p_"), "left").withColumns(divisors).withColumns(shares)
    by = [F.col(p).asc_nulls_first() for p in period] + [F.col("__rest").desc_nulls_last()] + \
        [F.col(c).asc_nulls_first() for c in order]
    numbered = number_rows(range_layout(shared.drop("__whole", "__part", "__total", "__n", "__w"), by), "__at")
    left = numbered.where(F.col("__owed").isNotNull()).groupBy(*period).agg(
        F.min("__at").alias("__first"), (F.first(F.abs("__owed")) - F.sum("__cents")).cast("long").alias("__left"))
    left = left.select(*[F.col(p).alias(f"__l_{p}") for p in period], "__first", "__left")
    left, _ = broadcast_if_small(left)
    return numbered.drop(*[f"__p_{p}" for p in period]).join(left, _same(period, "__l_"), "left")


def _same(period: list[str], prefix: str):
    cond = F.lit(True)
    for p in period:
        cond = cond & F.col(p).eqNullSafe(F.col(prefix + p))
    return cond


def unallocated(parts: DataFrame, costs: DataFrame, period: list[str]) -> DataFrame:
    """Costs of periods in which nothing ran: no part carries them."""
    ran = parts.select(*[F.col(p).alias(f"__p_{p}") for p in period]).distinct()
    return costs.join(ran, _same(period, "__p_"), "left_anti")
