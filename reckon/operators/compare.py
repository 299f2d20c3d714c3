"""Snapshot selection, monthly sums and period-over-period comparison."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import money, pct_change, threshold_flag
from reckon.functions.dates import ts_literal


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest snapshot: ``date_col = (select max(date_col))``.

    The max is a scalar subquery, evaluated once and pushed into the scan
    as a runtime filter."""
    return df.where(F.col(date_col) == df.select(F.max(date_col)).scalar())


def sum_by_month(df: DataFrame, keys: list[str], date_col: str, measure: str, year: int | None, out: str = "sum_increase", month_col: str = "month") -> DataFrame:
    """Exact (decimal) sum per keys and calendar month, for one year (a
    half-open range on the raw column, so that it reaches the scan)."""
    base = df
    if year is not None:
        lo, hi = (ts_literal(df, date_col, _dt.datetime(y, 1, 1)) for y in (year, year + 1))
        base = df.where((F.col(date_col) >= lo) & (F.col(date_col) < hi))
    return base.groupBy(*keys, F.month(date_col).alias(month_col)).agg(F.sum(money(measure)).alias(out))


def period_compare(
    prev: DataFrame,
    curr: DataFrame,
    keys: list[str],
    measure: str,
    prev_name: str = "prev_value",
    curr_name: str = "curr_value",
    hi: float = 20.0,
    lo: float = -20.0,
) -> DataFrame:
    """Left join ``prev`` to ``curr`` on null-safe key equality (rows only
    in ``curr`` are dropped), then percent change and >hi / <lo flags.

    Output: keys, prev_name, curr_name, percent_diff, over_hi, under_lo."""
    c = curr.select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col(measure).alias(curr_name))
    cond = None
    for k in keys:
        e = prev[k].eqNullSafe(c[f"__c_{k}"])
        cond = e if cond is None else cond & e
    j = prev.join(c, cond, "left")
    pv = F.col(measure).cast("double")
    cv = F.col(curr_name).cast("double")
    pct = pct_change(cv, pv)
    return j.select(
        *[prev[k] for k in keys],
        pv.alias(prev_name),
        cv.alias(curr_name),
        pct.alias("percent_diff"),
        threshold_flag(pct, hi, above=True).alias("over_hi"),
        threshold_flag(pct, lo, above=False).alias("under_lo"),
    )


def compare_periods(
    df: DataFrame,
    keys: list[str],
    period,
    prev_period,
    curr_period,
    measure: str,
    prev_name: str = "prev_value",
    curr_name: str = "curr_value",
    hi: float = 20.0,
    lo: float = -20.0,
) -> DataFrame:
    """``period_compare`` for two periods of the *same* table, in one pass:
    a single aggregate with a conditional sum per period (one scan, one
    shuffle, no join). Grouping treats null keys as equal, like the
    null-safe join; only groups with rows in the earlier period are kept
    (the left side of the comparison). Sums are exact decimals."""
    p = F.col(period) if isinstance(period, str) else period
    is_prev = p == F.lit(prev_period)
    is_curr = p == F.lit(curr_period)
    g = df.where(is_prev | is_curr).groupBy(*keys).agg(
        F.sum(F.when(is_prev, money(measure))).alias("__prev"),
        F.sum(F.when(is_curr, money(measure))).alias("__curr"),
        F.count(F.when(is_prev, F.lit(1))).alias("__n_prev"),
    )
    g = g.where(F.col("__n_prev") > 0)
    pv = F.col("__prev").cast("double")
    cv = F.col("__curr").cast("double")
    pct = pct_change(cv, pv)
    return g.select(
        *keys,
        pv.alias(prev_name),
        cv.alias(curr_name),
        pct.alias("percent_diff"),
        threshold_flag(pct, hi, above=True).alias("over_hi"),
        threshold_flag(pct, lo, above=False).alias("under_lo"),
    )
