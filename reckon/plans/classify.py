"""J4 - classify circuits by a first-match rule cascade.

Input list of circuits -> margin base (semi-joined to the list, never an
IN-list of literals) -> lookups (previous month's expense snapshot, billing
stop dates, holds, latest workflow) -> one waterfall expression.

Every enrichment is reduced to one row per key before it is joined, so the
output keeps the grain of the input x margin-base join.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import ci_eq, contains_lit, is_blank, ne_null_safe, safe_date
from reckon.functions.dates import check_date, yyyymm
from reckon.operators.lookup import anti_not_in, lookup, semi_in
from reckon.operators.rollup import any_match, complete_group_max, first_per_group, latest_per_key
from reckon.operators.rules import Rule, group_category, waterfall
from reckon.plans.stars import billing_star
from reckon.session import cut_lineage
from reckon.sources.snapshot import previous_snapshot

NA = "NonActionable"
ACT = "Actionable"
POT = "Potentially Actionable - Requires Cancel and Reload"


@dataclass(frozen=True)
class Labels:
    """Rule labels (fixed values of the classification report, in rule order)."""

    not_in_aim: str = "ECCKT does not exist in (month) AIM"
    not_active: str = "Expense Not Active in (month) AIM"
    other_company: str = "Not Own-Company Expense (DW Secure Company <> 1)"
    not_direct: str = "Not Direct Netex (Fixed or Opex)"
    disco_shelf: str = "Disco Shelf Life or Held for Term"
    not_matched: str = "Cost not matched in Tail Matching"
    no_bill: str = "Cost is matched to Component/Service which does not bill/invoice"
    revenue_disco: str = "Revenue Disconnect"
    fed_govt: str = "Fed Govt"
    ensemble: str = "ENSEMBLE"
    vantive: str = "VANTIVE"
    cabs: str = "CABS"
    broadband: str = "Enterprise Broadband"
    non_na: str = "Non-North America"
    oe_process: str = "OE Process Needs to be Defined"
    in_term_tdm: str = "In Term TDM - Reratable"
    in_term: str = "In Term"
    dntl: str = "DNTL"
    rerate_in_progress: str = "Rerate In Progress within next 30 days"
    rerated_recently: str = "Rerated within 3 Months"
    revshare: str = "RevShare"
    zero_biller: str = "Service is $0 Biller"
    proceed: str = "Proceed with Rerate"


def margin_base(margin_service: DataFrame, margin_circuit: DataFrame, gl_account: DataFrame, circuits: DataFrame) -> DataFrame:
    """Service rows of the listed circuits with circuit and GL attributes."""
    svc = semi_in(margin_service, circuits, {"ecckt_stripped_name": "ecckt_stripped_name"})
    circ = margin_circuit.select(
        F.col("solution_id_prime").alias("c_solution_id_prime"), "product_concat", "occ_region_concat", "in_term_tdm_rr",
        "customer_term_end_dt", F.col("rev_mrr").alias("marc_rev_mrr"),
    )
    j = svc.join(circ, svc["solution_id_prime"] == circ["c_solution_id_prime"], "left").drop("c_solution_id_prime")
    return lookup(j, gl_account, {"sap_account_cd": "gl_account_cd"}, ["gl_account_desc", "gl_account_ess_tier3_desc"], on_multi="first",
                  order=["gl_account_desc"])


def snapshot_flags(snapshot: DataFrame, run_date: _dt.date, not_found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Previous month's snapshot rows of the circuits not in the margin base,
    and per circuit: present, any inactive row, any other-company row."""
    snap = semi_in(previous_snapshot(snapshot, run_date), not_found, {"stripped_ec_circuit_id": "input_ecckt_stripped_name"})
    flags = snap.groupBy("stripped_ec_circuit_id").agg(
        F.lit(True).alias("snap_found"),
        F.bool_or(F.coalesce(F.col("active_ind") == "N", F.lit(False))).alias("snap_inactive"),
        # a missing company number is "not 1" too (null-safe inequality)
        F.bool_or(ne_null_safe("dw_secure_company_nbr", 1)).alias("snap_other_company"),
    )
    return snap, flags


def billing_stop_dates(billing: DataFrame) -> DataFrame:
    """Per primary id: the first billing row ordered by inactive date
    descending with nulls first (an open row beats any stop date)."""
    b = billing.select("primary_type_1", safe_date("billing_inactive_dt", ns_range=True).alias("billing_inactive_dt"))
    return first_per_group(b, "primary_type_1", ["billing_inactive_dt desc nulls first"])


def classify_circuits(
    circuits: DataFrame,
    margin_service: DataFrame,
    margin_circuit: DataFrame,
    gl_account: DataFrame,
    expense_snapshot: DataFrame,
    billing: "DataFrame | dict[str, DataFrame]",
    rerate_history: DataFrame,
    run_date: _dt.date,
    labels: Labels = Labels(),
    cut: bool = True,
) -> dict[str, DataFrame]:
    """Classify every input circuit. ``cut`` materialises the margin base,
    which feeds six joins and semi-joins, and the labelled circuits before the
    per-instance category, in ``spark.checkpoint.dir`` (see ``reckon.session.cut_lineage``),
    so that neither the pulls nor the rule cascade are planned twice."""
    L = labels
    chk = check_date(F.lit(run_date))
    stage_cut = cut_lineage if cut else (lambda d: d)
    base = stage_cut(margin_base(margin_service, margin_circuit, gl_account, circuits))
    inp = circuits.withColumnsRenamed({"ecckt_aml_id": "input_ecckt_aml_id", "ecckt_stripped_name": "input_ecckt_stripped_name"})
    df = inp.join(base, inp["input_ecckt_stripped_name"] == base["ecckt_stripped_name"], "left")
    df = df.withColumn("in_margin", F.col("ecckt_stripped_name").isNotNull())

    # Rules 1-3: circuits missing from the margin base, checked in the snapshot.
    not_found = anti_not_in(inp.select("input_ecckt_stripped_name"), base, {"input_ecckt_stripped_name": "ecckt_stripped_name"})
    snap, sflags = snapshot_flags(expense_snapshot, run_date, not_found)
    df = lookup(df, sflags, {"input_ecckt_stripped_name": "stripped_ec_circuit_id"}, ["snap_found", "snap_inactive", "snap_other_company"])

    # Rule 8: revenue disconnect = complete-group max of stop dates per instance.
    if isinstance(billing, dict):
        billing = billing_star(billing, base.select("rev_product_compnt_id"), key_col="rev_product_compnt_id", active_only=False)
    # Grouped over the margin rows: each of them reaches at least one input
    # row and repeated input rows change neither the max nor the all-found
    # test, so the roll-up does not need the (larger) joined row table.
    stops = billing_stop_dates(billing).withColumn("stop_found", F.lit(True))
    take_stop = {"billing_inactive_dt": "kenan_billing_inactive_dt", "stop_found": "stop_found"}
    base_stops = lookup(base.select("solution_id_prime", "rev_product_compnt_id"), stops, {"rev_product_compnt_id": "primary_type_1"}, take_stop)
    disco = complete_group_max(base_stops, "solution_id_prime", "kenan_billing_inactive_dt", F.col("stop_found"), "disco_date")
    df = lookup(df, stops, {"rev_product_compnt_id": "primary_type_1"}, take_stop)
    df = lookup(df, disco, "solution_id_prime", ["disco_date"])

    # Rule 18: holds (any contractual/bankruptcy hold expiring after the check date).
    holds = (
        margin_service.select("solution_id_prime", "dnt_reason_code", safe_date("hold_expiration_date").alias("hold_expiration_date"), "dnt_exclusion_level")
        .where(F.lower("dnt_reason_code").isin("contractual", "bankruptcy"))
        .distinct()
    )
    holds = semi_in(holds, base, "solution_id_prime")
    hflag = any_match(holds, "solution_id_prime", F.col("hold_expiration_date") > chk, "dntl_hold")
    df = lookup(df, hflag, "solution_id_prime", ["dntl_hold"])

    # Rules 19-20: latest non-canceled workflow per instance (ties kept),
    # reduced to flags so the row grain is unchanged.
    wf = latest_per_key(
        semi_in(rerate_history, base, {"product_inst_id": "solution_id_prime"}),
        "product_inst_id", "rerate_date", where=~ci_eq("workflowstatus", "canceled"),
    )
    wflag = wf.groupBy("product_inst_id").agg(
        F.bool_or(F.col("workflowstatus") == "In Progress").alias("wf_in_progress"),
        F.bool_or(F.col("workflowstatus") == "Canceled").alias("wf_canceled"),
    )
    df = lookup(df, wflag, {"solution_id_prime": "product_inst_id"}, ["wf_in_progress", "wf_canceled"])

    last_rr = safe_date("last_rerate_date", ns_range=True)
    term_end = safe_date("customer_term_end_dt", ns_range=True)
    rev_blank = is_blank("rev_mrr")
    sol = F.col("solution_id_prime")
    missing = ~F.col("in_margin")
    rules = [
        Rule(L.not_in_aim, NA, missing & F.col("snap_found").isNull()),
        Rule(L.not_active, NA, missing & F.col("snap_inactive")),
        Rule(L.other_company, NA, missing & F.col("snap_other_company")),
        Rule(L.not_direct, NA, ne_null_safe("gl_account_ess_tier3_desc", "Direct Netex")
             & ((F.col("gl_account_ess_tier3_desc") == "Fixed Netex") | contains_lit("gl_account_desc", "OPEX"))),
        Rule(L.disco_shelf, NA, rev_blank & (contains_lit("gl_account_desc", "Disco Shelf") | contains_lit("gl_account_desc", "Held for Term"))),
        Rule(L.not_matched, NA, rev_blank & (contains_lit("rev_product_compnt_id", "UNMATCHED") | contains_lit("rev_product_compnt_id", "UNKNOWN"))),
        Rule(L.no_bill, NA, rev_blank),
        Rule(L.revenue_disco, NA, F.col("disco_date").isNotNull()),
        Rule(L.fed_govt, NA, contains_lit("gov_ind", "Y")),
        Rule(L.ensemble, NA, contains_lit("bill_src_sys_cd", "ENS")),
        Rule(L.vantive, NA, contains_lit("rev_product_compnt_id", "vantive", ignore_case=True)),
        Rule(L.cabs, NA, contains_lit("bill_src_sys_cd", "CABS")),
        Rule(L.broadband, NA, contains_lit("product_concat", "enterprise broadband", ignore_case=True)),
        Rule(L.non_na, NA, ~is_blank("occ_region_concat") & (F.col("occ_region_concat") != "NA")),
        Rule(L.oe_process, NA, sol.rlike("^[0-9]{11,}$") | contains_lit(sol, "**LCC", ignore_case=True)),
        Rule(L.in_term_tdm, ACT, (F.to_date(term_end) > chk) & (F.col("in_term_tdm_rr") == "Y")),
        Rule(L.in_term, NA, F.to_date(term_end) > chk),
        Rule(L.dntl, NA, F.col("dntl_hold")),
        Rule(L.rerate_in_progress, NA, F.col("wf_in_progress") & last_rr.isNotNull() & (F.to_date(last_rr) <= F.date_add(F.lit(run_date), 30))),
        Rule(L.rerated_recently, POT, ~F.coalesce(F.col("wf_canceled"), F.lit(False)) & ~is_blank("jrnl_yr_mnth_nbr") & last_rr.isNotNull()
             & (yyyymm(last_rr) >= F.col("jrnl_yr_mnth_nbr").cast("int"))),
        Rule(L.revshare, NA, contains_lit("input_ecckt_stripped_name", "revshare")),
        Rule(L.zero_biller, ACT, F.col("marc_rev_mrr") == 0),
    ]
    final = waterfall(df, rules, (L.proceed, ACT), label_col="nonactionable_reason", category_col="actionable_nonactionable")
    final = group_category(final, "solution_id_prime", "actionable_nonactionable", ACT, "piid_any_actionable", cut=cut_lineage if cut else None)
    return {
        "Data": base,
        "T_STG_NETEX_AIM_Data": snap,
        "DISCO_DATE_INFO": billing_stop_dates(billing),
        "DNTL_INFO": holds,
        "WorkFlowStatus": wf,
        "final": final,
    }
