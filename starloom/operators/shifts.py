"""Day and night: the last level of the calendar, and trips split at its borders.

A calendar day has three stretches: night until ``day_start``, day until ``night_start``, night
until midnight.  Splitting a trip at shift and midnight borders yields a piece per stretch it
touches, hundreds for a long trip, so nothing here makes those pieces:

* a trip's own day and night hours come from the closed form of the day hours before an instant;
* hours per calendar stretch come from a sweep: a trip adds its two cut-off ends where they lie,
  and +1 and -1 where its run of whole stretches begins and ends.  Summed per stretch (partial
  sums in every task) and then along the calendar, the ones give the number of trips that cover
  a stretch whole.

Times are counted in microseconds, so the pieces of a trip sum to its duration exactly.  Sums over
trips are decimals: the microseconds of some hundred thousand long trips are beyond a long.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col_of, div_half_up, fiscal_quarter, fiscal_year, scaled_to_decimal, ts_lit
from ..schemas import DEC18_2, INT

# The boundaries are not documented: arguments with these defaults.
DAY_START, NIGHT_START = 6, 18

_HOUR = 3_600_000_000                   # microseconds
_DAY = 24 * _HOUR

_WIDE = T.DecimalType(20, 0)            # its sums are decimal(30, 0)


def micros(t) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz."""
    return F.timestamp_diff("MICROSECOND", ts_lit("1970-01-01 00:00:00"), col_of(t))


def _day_before(us: Column, day_start: int, night_start: int) -> Column:
    """Microseconds of day shift before an instant."""
    of_day = F.pmod(us, F.lit(_DAY))
    whole = F.call_function("div", us - of_day, F.lit(_DAY)) * ((night_start - day_start) * _HOUR)
    return whole + F.least(F.greatest(of_day - day_start * _HOUR, F.lit(0)), F.lit((night_start - day_start) * _HOUR))


def day_micros(start, end, day_start: int = DAY_START, night_start: int = NIGHT_START) -> Column:
    """Microseconds of [start, end) that fall into the day shift."""
    return _day_before(micros(end), day_start, night_start) - _day_before(micros(start), day_start, night_start)


def _hours(us: Column) -> Column:
    """Hours with two digits, half up, of whole seconds."""
    return scaled_to_decimal(div_half_up(F.call_function("div", us, F.lit(1_000_000)) * 100, F.lit(3600)), 2)


def with_shift_hours(trips: DataFrame, start: str, end: str, day_start: int = DAY_START,
                     night_start: int = NIGHT_START) -> DataFrame:
    """``trips`` with Total_Hours, Day_Hours and Night_Hours of [start, end); day and night sum to
    the total.  NULL where an end is missing or lies before the start."""
    span = micros(end) - micros(start)
    ok = span >= 0
    total, day = _hours(span), _hours(day_micros(start, end, day_start, night_start))
    return trips.withColumns({"Total_Hours": F.when(ok, total), "Day_Hours": F.when(ok, day),
                              "Night_Hours": F.when(ok, (total - day).cast(DEC18_2))})


def _slot_start(slot: Column, day_start: int, night_start: int) -> Column:
    """First microsecond of a stretch (three to a day, numbered from 1970-01-01)."""
    nth = F.pmod(slot, F.lit(3))
    return F.call_function("div", slot - nth, F.lit(3)) * _DAY + \
        F.when(nth == 0, 0).when(nth == 1, day_start * _HOUR).otherwise(night_start * _HOUR)


def _slot_of(us: Column, day_start: int, night_start: int) -> Column:
    of_day = F.pmod(us, F.lit(_DAY))
    nth = F.when(of_day < day_start * _HOUR, 0).when(of_day < night_start * _HOUR, 1).otherwise(2)
    return F.call_function("div", us - of_day, F.lit(_DAY)) * 3 + nth


def shift_hours(trips: DataFrame, start: str, end: str, by: list[str] | None = None, day_start: int = DAY_START,
                night_start: int = NIGHT_START) -> DataFrame:
    """(by..., Full_Date, Shift, Micros decimal): time of all trips [start, end) in the day and night
    hours of each calendar day between the first and the last.  Trips without both times, or that
    end before they start, take no part.

    The running sum goes along the calendar, per ``by`` group: its rows are bounded by days, not
    by trips."""
    by = by or []
    a, b = micros(start), micros(end)
    t = trips.where(a <= b).select(*by, a.alias("__a"), b.alias("__b"),
                                   _slot_of(a, day_start, night_start).alias("__first"),
                                   _slot_of(b, day_start, night_start).alias("__last"))
    one = F.col("__first") == F.col("__last")
    next_start = _slot_start(F.col("__first") + 1, day_start, night_start)
    last_start = _slot_start(F.col("__last"), day_start, night_start)
    zero = F.lit(0).cast("long")

    def event(slot, us, whole):
        return F.struct(slot.alias("slot"), us.cast("long").alias("us"), F.lit(whole).cast("long").alias("whole"))
    # The days of both ends are there whole.
    days = F.array(event(F.col("__first") - F.pmod("__first", F.lit(3)), zero, 0),
                   event(F.col("__last") - F.pmod("__last", F.lit(3)) + 2, zero, 0))
    events = t.select(*by, F.inline(F.concat(days, F.when(one, F.array(event(F.col("__first"), F.col("__b") - F.col("__a"), 0))).otherwise(F.array(
        event(F.col("__first"), next_start - F.col("__a"), 0), event(F.col("__last"), F.col("__b") - last_start, 0),
        event(F.col("__first") + 1, zero, 1), event(F.col("__last"), zero, -1))))))
    slots = events.groupBy(*by, "slot").agg(F.sum(F.col("us").cast(_WIDE)).alias("us"), F.sum("whole").alias("whole"))
    w = Window.partitionBy(*[F.col(c) for c in by] or [F.lit(0)]).orderBy("slot")
    running = F.sum("whole").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.coalesce(F.lead("slot").over(w), F.col("slot") + 1)
    # A row stands for the stretches up to the next one with an event; only the first has cut-off ends.
    every = slots.withColumns({"__n": running, "__to": following}).select(
        *by, F.col("slot").alias("__from"), "us", "__n", F.explode(F.sequence(F.col("slot"), F.col("__to") - 1)).alias("slot"))
    length = _slot_start(F.col("slot") + 1, day_start, night_start) - _slot_start(F.col("slot"), day_start, night_start)
    spent = F.col("__n").cast(_WIDE) * length.cast(T.DecimalType(12, 0)) + F.when(F.col("slot") == F.col("__from"), F.col("us")).otherwise(0)
    nth = F.pmod("slot", F.lit(3))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.call_function("div", F.col("slot") - nth, F.lit(3)).cast(INT))
    return every.groupBy(*by, day.alias("Full_Date"), F.when(nth == 1, "DAY").otherwise("NIGHT").alias("Shift")) \
        .agg(F.sum(spent).cast("decimal(38,0)").alias("Micros"))


def calendar_shift_rollup(hours: DataFrame, fy_start_month: int = 4) -> DataFrame:
    """Financial Year > Quarter > Month > Day > Day/Night as one ROLLUP over ``shift_hours``."""
    d = F.col("Full_Date")
    return hours.rollup(fiscal_year(d, fy_start_month).alias("Fiscal_Year"), fiscal_quarter(d, fy_start_month).alias("Fiscal_Quarter"),
                        (F.year(d) * 100 + F.month(d)).alias("Month_Key"), d.alias("Full_Date"), F.col("Shift")) \
        .agg(F.grouping_id().alias("Grouping_Level"), _hours(F.sum("Micros")).alias("Trip_Hours"))


def dim_date_shift(dates: DataFrame, day_start: int = DAY_START, night_start: int = NIGHT_START) -> DataFrame:
    """The day/night level beneath a date dimension (Date_SKey, Full_Date): three stretches a day."""
    stretch = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("Shift", T.StringType()),
                            T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    three = F.array(*[F.struct(F.lit(n), F.lit(s), F.lit(a), F.lit(b)).cast(stretch)
                      for n, s, a, b in ((1, "NIGHT", 0, day_start), (2, "DAY", day_start, night_start), (3, "NIGHT", night_start, 24))])

    def at(c):
        return F.col("Full_Date").cast(T.TimestampNTZType()) + F.make_dt_interval(F.lit(0), F.col(c))
    return dates.select("Date_SKey", "Full_Date", F.inline(three)).select(
        (F.col("Date_SKey").cast("long") * 10 + F.col("n")).alias("Shift_SKey"), "Date_SKey", "Shift",
        at("a").alias("Starts_At"), at("b").alias("Ends_At"))
