"""J2 - validator update file.

Validation log joined to the rate header, filtered to one cycle; DISTINCT
on the full pulled column list, then five columns kept *without* a second
DISTINCT (so rows that differed only in dropped columns stay duplicated,
as in the source process), plus the disposition mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import ci_eq, ci_ne, ci_not_like
from reckon.operators.rules import Case, case_map

# Disposition mapping (fixed values): disposition -> (status, reason, note),
# applied only when the log's workflow status is exactly 'In Progress'.
IN_PROGRESS = "In Progress"
DISPOSITIONS = {
    "Canceled due to Renewal": ("Canceled", "Renewal", "Renewal per validator"),
    "Disconnect": ("Canceled", "Disconnect", "Disconnect per validator"),
}

PULLED = [
    "piid_meid", "product_inst_id", "redblue", "subprojname", "workflowstatus", "rerate_month", "fiscalyear",
    "disconnectdate", "disposition", "invoice_day", "disconnected", "dtedisconnected", "non_opp_reason",
]


def validator_pull(log: DataFrame, header: DataFrame, month: int, day: int, year: int) -> DataFrame:
    r = header.select(
        F.col("piid_meid").alias("r_piid_meid"), F.col("workflowstatus").alias("r_workflowstatus"),
        "rerate_month_actual", "invoice_day", "fiscalyear", F.col("non_opp_reason"),
    ).withColumnRenamed("fiscalyear", "r_fiscalyear")
    j = log.join(r, log["piid_meid"] == r["r_piid_meid"], "inner").where(
        ci_eq(log["redblue"], "green")
        & ci_not_like(log["subprojname"], "%special access%")
        & ci_not_like(F.col("disposition"), "%overlap%")
        & ci_ne(F.col("r_workflowstatus"), "canceled")
        & (F.col("rerate_month_actual") == F.lit(month))
        & (F.col("invoice_day") == F.lit(day))
        & (F.col("r_fiscalyear") == F.lit(year))
    )
    return j.select(*[log[c] if c in log.columns else F.col(c) for c in PULLED]).distinct()


def validator_update(log: DataFrame, header: DataFrame, month: int, day: int, year: int) -> DataFrame:
    """``PIID Changes``: piid_meid, product_inst_id, disconnectdate,
    workflowstatus (new), non_opp_reason, notes1."""
    v = validator_pull(log, header, month, day, year)
    in_prog = F.col("workflowstatus") == F.lit(IN_PROGRESS)
    cases = [
        Case(in_prog & (F.col("disposition") == F.lit(disp)), {"new_status": s, "new_reason": r, "notes1": n})
        for disp, (s, r, n) in DISPOSITIONS.items()
    ]
    out = case_map(v, cases, {"new_status": None, "new_reason": None, "notes1": None})
    return out.select(
        "piid_meid", "product_inst_id", "disconnectdate",
        F.col("new_status").alias("workflowstatus"), F.col("new_reason").alias("non_opp_reason"), "notes1",
    )
