"""Period and calendar helpers (built-in date functions only)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from reckon.functions.columns import ColumnOrName, _c


def _lit_or_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str) and x and not x[0].isdigit():
        return F.col(x)
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x)
    if isinstance(x, str):
        return F.to_date(F.lit(x))
    return F.lit(x)


def cycle_date(year, month, day) -> Column:
    """Bill-cycle date from (year, month, day); a day past the month's end
    (e.g. 31 June) is clamped to the last day of that month."""
    m1 = F.make_date(_lit_or_col(year), _lit_or_col(month), F.lit(1))
    return F.least(F.last_day(m1), F.date_add(m1, _lit_or_col(day) - F.lit(1)))


def check_date(run_date, months: int = 3) -> Column:
    """First of the run month plus ``months`` months (year carries)."""
    return F.add_months(F.trunc(_lit_or_col(run_date), "MM"), months)


def first_of_prev_month(run_date) -> Column:
    return F.add_months(F.trunc(_lit_or_col(run_date), "MM"), -1)


def mdy(c: ColumnOrName) -> Column:
    """Date text as ``MM/dd/yyyy``."""
    return F.date_format(_c(c), "MM/dd/yyyy")


def prev_month_abbr(c) -> Column:
    """Upper-case English abbreviation (JAN..DEC) of the previous month."""
    return F.upper(F.date_format(F.add_months(_lit_or_col(c), -1), "MMM"))


def yyyymm(c) -> Column:
    """Integer period ``year*100 + month``."""
    c = _lit_or_col(c)
    return (F.year(c) * F.lit(100) + F.month(c)).cast("int")


def prev_yyyymm(run_date) -> Column:
    """Period of the month before ``run_date`` (partition value of last
    month's snapshot)."""
    return yyyymm(F.add_months(_lit_or_col(run_date), -1))


def period_year(p: ColumnOrName) -> Column:
    """Year part of an integer yyyymm period."""
    return F.floor(_c(p) / F.lit(100)).cast("int")


def period_month(p: ColumnOrName) -> Column:
    return (_c(p) % F.lit(100)).cast("int")


def ts_literal(df, col: str, value) -> Column:
    """A date/time literal typed like ``df[col]`` (timestamp_ntz, timestamp
    or date), so comparisons stay on the raw column and push down."""
    from pyspark.sql import types as T

    dt = df.schema[col].dataType
    text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)
    if isinstance(dt, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dt, T.DateType):
        return F.lit(text[:10]).cast("date")
    return F.lit(text).cast("timestamp")
