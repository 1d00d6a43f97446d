"""Scalar helpers, all built from JVM-side ``pyspark.sql.functions`` (no Python UDFs)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ts_lit(value: str) -> Column:
    """A timestamp_ntz literal; never a zone-dependent ``timestamp``."""
    return F.lit(value).cast(T.TimestampNTZType())


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def isnull_default(c, default, dtype: T.DataType | None = None) -> Column:
    """``ISNULL(x, d)``: coalesce with a literal typed like ``x``."""
    lit = F.lit(default)
    if dtype is not None:
        lit = lit.cast(dtype)
    return F.coalesce(col_of(c), lit)


def minus_one_second(c) -> Column:
    """``DATEADD(SECOND, -1, ts)``; stays timestamp_ntz."""
    return col_of(c) - F.expr("INTERVAL 1 SECOND")


def div_half_up(n, d) -> Column:
    """Integer ``n / d`` rounded half away from zero, in exact long arithmetic (``d > 0``).

    Used instead of double division so every engine produces the same digits at .5 ties.
    """
    n, d = col_of(n).cast(T.LongType()), col_of(d).cast(T.LongType())
    q = F.call_function("div", F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -q).otherwise(q)


def scaled_to_decimal(units, scale: int, precision: int = 18) -> Column:
    """Long count of 10^-scale units -> decimal(precision, scale), exactly."""
    step = F.lit(f"{10 ** -scale:.{scale}f}").cast(T.DecimalType(scale + 1, scale))
    return (col_of(units).cast(T.DecimalType(20, 0)) * step).cast(T.DecimalType(precision, scale))


def hours_between(start, end, scale: int = 2) -> Column:
    """Hours from ``start`` to ``end`` (whole seconds / 3600), rounded half-up to ``scale``."""
    secs = F.timestamp_diff("SECOND", col_of(start), col_of(end))
    return scaled_to_decimal(div_half_up(secs * (10 ** scale), F.lit(3600)), scale)


def safe_ratio(num, den, scale: int = 4, in_scale: int = 2) -> Column:
    """``num / den`` rounded half-up to ``scale`` decimals; zero or NULL denominator gives NULL.

    Both inputs are exact decimals with at most ``in_scale`` digits; the quotient is computed
    on their unscaled longs, so no binary floating point is involved.
    """
    k = 10 ** in_scale
    n = (col_of(num) * k).cast(T.LongType())
    d = (col_of(den) * k).cast(T.LongType())
    q = div_half_up(n * (10 ** scale) * F.signum(d).cast(T.LongType()), F.abs(d))
    return F.when(d == 0, F.lit(None)).otherwise(scaled_to_decimal(q, scale))


def date_key(c) -> Column:
    """Integer yyyymmdd key of a date or timestamp."""
    d = F.to_date(col_of(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast(T.IntegerType())


def fiscal_year(c, start_month: int = 4) -> Column:
    """Fiscal year labelled by the calendar year it ends in (start month is an argument)."""
    d = col_of(c)
    if start_month == 1:
        return F.year(d)
    return (F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)).cast(T.IntegerType())


def fiscal_quarter(c, start_month: int = 4) -> Column:
    d = col_of(c)
    shifted = (F.month(d) - start_month + 12) % 12
    return (F.floor(shifted / 3) + 1).cast(T.IntegerType())
