"""J1 - month-to-month forecast comparison.

history (snapshots with ``finalized_date``) and current forecast ->
{prev_name: newest finalised snapshot summed per (initiative, rerate_type,
month), curr_name: current forecast summed the same way, "compare": both
side by side with percent change and +/-threshold flags}.

Keys are compared with null-safe equality on the real columns (a blank key
part matches a blank one, as a separator-less text key would); rows only
in the current month are not in ``compare`` (left join from the past).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import key_concat
from reckon.operators.compare import latest_snapshot, period_compare, sum_by_month

KEYS = ["initiative", "rerate_type", "rerate_month"]


def monthly_increase(df: DataFrame, year: int) -> DataFrame:
    """Sum of ``increase`` per initiative, rerate type and calendar month."""
    g = sum_by_month(df, ["initiative", "rerate_type"], "rerate_month", "increase", year, out="sum_increase", month_col="rerate_month")
    return g.select(*KEYS, F.col("sum_increase").cast("double").alias("sum_increase"))


def forecast_compare(
    history: DataFrame,
    current: DataFrame,
    year: int,
    prev_name: str = "prev",
    curr_name: str = "curr",
    hi: float = 20.0,
    lo: float = -20.0,
) -> dict[str, DataFrame]:
    past = monthly_increase(latest_snapshot(history, "finalized_date"), year)
    curr = monthly_increase(current, year)
    cmp = period_compare(past, curr, KEYS, "sum_increase", f"{prev_name}_sum_increase", f"{curr_name}_sum_increase", hi, lo)
    cmp = cmp.select(
        *KEYS,
        key_concat(*KEYS).alias("concat"),
        f"{prev_name}_sum_increase",
        f"{curr_name}_sum_increase",
        "percent_diff",
        F.col("over_hi").alias("over_20_increase"),
        F.col("under_lo").alias("over_20_decrease"),
    )
    return {prev_name: past, curr_name: curr, "compare": cmp}
