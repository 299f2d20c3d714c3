"""J3 - billing-cycle preparation (rate reconciliation of one bill cycle).

Row table = rerates U reversals of the cycle; each stage is a lookup or a
status rule over the whole table in one plan:

 1 billed rate (replace)            9  quantity roll-up per group value
 2 active value + fallback (fill)   10 package id without package instance
 3 split ids: estimated rate fill   11 hidden package
 4 billing-star rate (overwrite)    12 package status (+ invoice sums)
 5 account-star rate (overwrite)    13 term end, fallback term end
 6 clamped difference               14 in-term exception (overwrite)
 7 disconnect status                15 service element / component code
 8 cost-change status               16 pre-billed flag repair
                                    17 instance-level status roll-up

Sources are the logical tables of the cycle (see FIXTURES.md), passed as
a dict of DataFrames. Most stages join the row table to an aggregate of
itself (propagation, group roll-ups), which doubles the logical plan each
time; the row table is therefore materialised at stage boundaries with a
reliable checkpoint in the cluster's ``spark.checkpoint.dir``. That keeps
planning linear, avoids recomputing the sources for every branch, and
gives restart points that survive executor loss.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import ci_eq, ci_like, ci_ne, ci_not_like, clamped_diff, contains_lit, is_blank, key_concat
from reckon.functions.dates import cycle_date
from reckon.operators.lookup import lookup, propagate_by_key, semi_in, sieved
from reckon.operators.rollup import any_match, dedupe_latest, first_per_group, priority_rollup
from reckon.operators.rules import Stage, in_term_cancel, staged_status
from reckon.plans.pulls import BILLING_TABLES, INVOICE_TABLES, account_pull, billing_pull, invoice_pull, invoice_sums, order_pull, term_pull
from reckon.plans.stars import account_star, billing_star, first_of_prev_month_date, invoice_amounts, package_status_source, ses_star
from reckon.session import cut_lineage


@dataclass(frozen=True)
class Statuses:
    """Status texts (fixed values)."""

    move_back: str = "Move back to complete - Reversal cannot be completed due to disconnect"
    disconnect: str = "Cancel - Disconnect"
    mrr: str = "Cancel for MRR Cost Change"
    pk_no_piid: str = "Cancel - PIID Mapping Issue - PK SCID does not have proper PK PIID"
    hidden_pkg: str = "Cancel - PIID Mapping Issue - service is an unidentified package"
    proceed_rerate: str = "Proceed with Rerate"
    proceed_reversal: str = "Proceed with Reversal"
    in_term: str = "Cancel - Circuit in term"


# Rule parameters of the cycle (fixed values).
SOURCE_SYSTEMS = ["SDP", "Orion", "Latis"]
QTY_RANKING = ["Always > 1", "Could be > 1 or = 1", "Always = 1"]
QTY_EXCLUDED_COMPONENTS = ["EQ", "IQ", "LL"]
PASS_THROUGH_PROJECT = "In Term TDM Cost Increase Pass Thru"
DISCONTINUANCE_PROJECT = "Offnet TDM Discontinuance"
WHOLESALE = "WHOLESALE"

DETAIL_COLS = [
    "rerate_date", "subprojname", "workflowstatus", "meid", "serv_comp_id", "rr_piid_meid", "product_inst_id",
    "scp_current_rate", "scp_increase", "scp_new_rate", "component", "component_id", "component_grp_val_id", "old_qty",
    "cust_contract_term_end_dt", "business_unit", "bus_org_id", "cust_acct_sales_channel_desc", "product", "invoice_day",
    "inv_ban", "prod_acct_id", "service_element_id", "promo_code", "prod_cmpnt_cd", "pre_billed_ind", "reversal_date",
    "batch", "bill_acct_nbr",
]


def _detail_all(t: dict[str, DataFrame]) -> DataFrame:
    d, h = t["rate_detail"], t["rate_header"]
    return d.join(h, d["rr_piid_meid"] == h["piid_meid"], "inner")


def _detail(t: dict[str, DataFrame], day: int, kinds: dict[tuple[str, ...], Column] | None = None) -> DataFrame:
    """Details of the day with their header; with ``kinds`` (conditions by the columns that they read) only rows of any of
    these. Details of headers that no condition lets pass are sieved out before the join."""
    d, h = t["rate_detail"], t["rate_header"]
    common = {
        ("invoice_day",): F.col("invoice_day") == F.lit(day),
        ("redblue",): ci_eq("redblue", "green"),
        ("subprojname",): ci_not_like("subprojname", "%access%"),
        ("rollup_to_piid",): ci_eq("rollup_to_piid", "y"),
        ("scp_increase",): F.col("scp_increase") != 0,
        ("dw_source_system_cd",): F.lower("dw_source_system_cd").isin([s.lower() for s in SOURCE_SYSTEMS]),
        ("frequency",): ci_ne("frequency", "NRC"),
    }
    if kinds:
        common[tuple({c for cols in kinds for c in cols})] = reduce(or_, kinds.values())
    keys = h
    for cols, cond in common.items():  # which side has a column is not fixed
        if set(cols) <= set(h.columns):
            keys = keys.where(cond)
    d = sieved(d, keys, {"rr_piid_meid": "piid_meid"})
    j = d.join(h, d["rr_piid_meid"] == h["piid_meid"], "inner")
    return j.where(reduce(and_, common.values())).withColumnRenamed("qty", "old_qty")


#: Columns of the base that a stage reads or writes; the others wait in the written base until the last stage.
READ_COLS = [
    "serv_comp_id", "rr_piid_meid", "product_inst_id", "scp_current_rate", "component", "component_id", "component_grp_val_id", "subprojname",
    "business_unit", "cust_contract_term_end_dt", "service_element_id", "promo_code", "prod_cmpnt_cd", "pre_billed_ind", "is_reversal", "unique",
]


def base_rows(t: dict[str, DataFrame], year: int, month: int, day: int, cut: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """Rerates of the cycle U reversals (old/new rate swapped in one
    projection, reversal date forced to the cycle date), with the
    ``unique`` key component_id + group value + component.

    ``cut`` writes the rows of either kind once: details are joined to headers in one pass, and both kinds are read from its result."""
    rerate = (F.col("fiscalyear") == F.lit(year)) & (F.col("rerate_month_actual") == F.lit(month)) & ci_ne("workflowstatus", "canceled")
    reversal = ci_eq("workflowstatus", "reversal")
    j = _detail(t, day, {("fiscalyear", "rerate_month_actual", "workflowstatus"): rerate, ("workflowstatus",): reversal})
    rd_type = j.schema["reversal_date"].dataType  # the cycle date keeps the column's timestamp type
    j = cut(j.select(*DETAIL_COLS, "invoice_kenan_acct_nbr", "reversal_reason", rerate.alias("__rerate"), reversal.alias("__reversal")))
    rer = j.where("__rerate").select(*[F.col(c) for c in DETAIL_COLS], "invoice_kenan_acct_nbr")
    rev = j.where("__reversal").select(
        *[
            F.col("scp_new_rate").alias("scp_current_rate") if c == "scp_current_rate"
            else F.col("scp_current_rate").alias("scp_new_rate") if c == "scp_new_rate"
            else F.when(F.col("reversal_date").isNotNull(), cycle_date(year, month, day).cast(rd_type)).alias("reversal_date") if c == "reversal_date"
            else F.col(c)
            for c in DETAIL_COLS
        ],
        "reversal_reason",
    ).withColumn("is_reversal", F.lit(True))
    base = rer.withColumn("is_reversal", F.lit(False)).unionByName(rev, allowMissingColumns=True)
    return base.withColumn("unique", key_concat("component_id", "component_grp_val_id", "component"))


def cycle_prep(
    t: dict[str, DataFrame], year: int, month: int, day: int, st: Statuses = Statuses(), cut: bool = True, fanout_billed: bool = False
) -> dict[str, DataFrame]:
    """Run all stages; ``cut`` materialises the row table at stage
    boundaries (see module doc). Without it the plan doubles at every
    stage that joins the table to an aggregate of itself.

    ``fanout_billed`` reproduces the source's merge on the billed records,
    which repeats a row once per duplicate billed key (the source author
    flags these duplicates); by default the largest billed rate of a key is
    taken and the row grain is kept."""
    stage_cut = cut_lineage if cut else (lambda d: d)
    df, rest = base_rows(t, year, month, day, stage_cut), None
    names = df.columns
    if cut:
        # a lookup moves all columns of the row table: those that no stage reads stay in the written base, by a row id
        base = stage_cut(df.withColumn("__row", F.monotonically_increasing_id()))
        df, rest = base.select(*READ_COLS, "__row"), base.drop(*READ_COLS)
    for c in ["kenan", "status", "latis_active", "qty", "r4_term_end_date", "pkg_cgv", "pkg_description", "pkg_status"]:
        df = df.withColumn(c, F.lit(None).cast("double" if c == "kenan" else "timestamp" if c == "r4_term_end_date" else "string"))
    ids = df.select("serv_comp_id")

    # 1 billed rates (replace).
    tstage = semi_in(t["billed_records"], ids, {"primary_id": "serv_comp_id"}, sieve=True).select(
        key_concat("primary_id", "prcmp_desc").alias("scid"), F.col("rate").cast("double").alias("rate"))
    if fanout_billed:
        df = lookup(df, tstage, {"unique": "scid"}, {"rate": "kenan"})
    else:
        df = lookup(df, tstage, {"unique": "scid"}, {"rate": "kenan"}, on_multi="first", order=["rate desc"])

    # 2 active value on the full key, then on the group value alone, the
    # found value propagated to every row of the same component id.
    ap = t["active_products"]
    latis_active = semi_in(ap, df, {"component_grp_val": "component_grp_val_id"}).withColumn(
        "scid", key_concat("component_group_cd", "component_grp_val", "prcmp_dsc")).withColumn(
        "quantity_unique", key_concat("product_code", "prcmp_code"))
    # used again by stages 3, 9 and the outputs: written once, so later stages
    # do not re-run the base pull its key set came from
    latis_active = stage_cut(latis_active)
    df = lookup(df, latis_active, {"unique": "scid"}, {"component_grp_val": "latis_active"}, on_multi="first", order=["component_grp_val"])
    grp = latis_active.select("component_grp_val").distinct()
    df = lookup(df, grp.withColumn("fallback_active", F.col("component_grp_val")), {"component_grp_val_id": "component_grp_val"}, ["fallback_active"])
    df = df.withColumn("fallback_active", F.when(is_blank("latis_active"), F.col("fallback_active")))
    df = propagate_by_key(df, "serv_comp_id", "fallback_active", "latis_active", order=["fallback_active"], mode="fill").drop("fallback_active")

    df = stage_cut(df)

    # 3 component ids with '-' bill from the active products: estimated revenue fills the rate.
    est = latis_active.select("scid", F.col("monthly_rev_est").cast("double").alias("est"))
    df = lookup(df, est, {"unique": "scid"}, ["est"], on_multi="first", order=["est desc"])
    df = df.withColumn("est", F.when(contains_lit("serv_comp_id", "-"), F.col("est")))
    df = propagate_by_key(df, "unique", "est", "kenan", order=["est"], mode="fill").drop("est")

    df = stage_cut(df)

    # 4 billing star (pulled for rows without an active value): overwrite
    # blank/mismatched rates; reversal rows still without one move back.
    need = df.where(is_blank("latis_active")).select("serv_comp_id")
    if "billing_rates" in t:
        kenan_prod = semi_in(t["billing_rates"], need, {"primary_type_1": "serv_comp_id"}, sieve=True)
    elif all(x in t for x in BILLING_TABLES):
        kenan_prod = stage_cut(billing_pull(t, need, "serv_comp_id", stage_cut))  # read by two roll-ups and written as an output
    else:
        kenan_prod = billing_star(t, need)
    bill = kenan_prod.select("primary_type_1", "bill_rate", "product_inactive_dt", "product_active_dt")
    bill_one = propagate_src(bill, "primary_type_1", "bill_rate",
                             ["product_inactive_dt asc nulls last", "product_active_dt asc nulls last", "bill_rate desc"])
    rev_scids = df.where(F.col("is_reversal")).select("serv_comp_id").distinct().withColumn("rev_scid", F.lit(True))
    df = lookup(df, rev_scids, "serv_comp_id", ["rev_scid"])
    df = lookup(df, bill_one, {"serv_comp_id": "primary_type_1"}, {"bill_rate": "k4"})
    df = lookup(df, any_match(bill, "primary_type_1", is_blank("bill_rate"), "unrated"), {"serv_comp_id": "primary_type_1"}, ["unrated"])
    df = _overwrite_found(df, "k4", "unrated", st.move_back, mode="overwrite")

    df = stage_cut(df)

    # 5 account star by instance id for component ids with '-': same pattern.
    split = df.where(contains_lit("serv_comp_id", "-")).select("product_inst_id")
    if "account_rates" in t:
        latis_prod = semi_in(t["account_rates"], split, {"common_ckt": "product_inst_id"}, sieve=True)
    elif "component_group" in t:
        latis_prod = stage_cut(account_pull(t, split, "product_inst_id", stage_cut))
    else:
        latis_prod = account_star(t, instances=split)
    revs = latis_prod.select("common_ckt", F.col("monthly_rev_est").cast("double").alias("rev"), "bill_eff_bgn_date")
    acct = propagate_src(revs, "common_ckt", "rev", ["bill_eff_bgn_date desc nulls last", "rev desc"])
    df = lookup(df, acct, {"product_inst_id": "common_ckt"}, {"rev": "k5"})
    df = lookup(df, any_match(revs, "common_ckt", is_blank("rev"), "unrated"), {"product_inst_id": "common_ckt"}, ["unrated"])
    df = _overwrite_found(df, "k5", "unrated", st.move_back, mode="fill").drop("rev_scid")

    df = stage_cut(df)

    # 6 difference; 7 disconnects among rows without a rate; 8 cost change.
    df = df.withColumn("difference", clamped_diff(F.col("scp_current_rate").cast("double"), "kenan"))
    no_rate = df.where(is_blank("kenan")).select("serv_comp_id")
    if "ses" in t:
        ses = semi_in(t["ses"], no_rate, {"service_id": "serv_comp_id"}, sieve=True)
    elif "alternate_id" in t:
        ses = order_pull(t | {"service": t["order_service"]}, no_rate, "serv_comp_id", stage_cut)
    else:
        ses = ses_star(t["order"], t["order_service"], t["order_lookup"], no_rate)
    disc = any_match(ses, "service_id", F.col("service_action") == "Disconnect", "has_disconnect")
    df = lookup(df, disc, {"serv_comp_id": "service_id"}, ["has_disconnect"])
    df = staged_status(df, "status", [
        # orders were pulled for component ids having a row without a rate;
        # a disconnect marks every row of that component id
        Stage("fill", F.col("has_disconnect"), st.disconnect),
        Stage("fill", F.col("difference").isNull() | (F.col("difference") != 0), st.mrr),
    ]).drop("has_disconnect")
    df = stage_cut(df)

    # 9 quantity: guide -> active products -> group value roll-up -> rows.
    qref = t["quantity_guide"]
    la_upd = lookup(latis_active, qref, {"quantity_unique": "unique_product_prcmp"}, {"quantity_status": "qty"}, on_multi="first",
                    order=["quantity_status"])
    grp_qty = priority_rollup(la_upd, "component_grp_val", "qty", QTY_RANKING, QTY_RANKING[-1], "group_qty")
    scid_qty = la_upd.select("scid", "component_grp_val").join(grp_qty, "component_grp_val").select("scid", "group_qty")
    df = lookup(df, scid_qty, {"unique": "scid"}, ["group_qty"], on_multi="first", order=["group_qty"])
    df = df.withColumn("qty", F.when(~F.coalesce(F.col("component_id").isin(QTY_EXCLUDED_COMPONENTS), F.lit(False)),
                                      F.col("group_qty")).otherwise(F.col("qty"))).drop("group_qty")

    # 10 package ids without a package instance: their own pull over the
    # cycle (month, day, in progress), matched by component id.
    bad_pkg = _detail_all(t).where(
        ci_like("serv_comp_id", "pk%") & ci_not_like("product_inst_id", "pk-%") & ci_eq("workflowstatus", "in progress")
        & (F.col("rerate_month_actual") == F.lit(month)) & (F.col("invoice_day") == F.lit(day))
    ).select(F.col("serv_comp_id").alias("bad_scid")).distinct().withColumn("bad_pkg", F.lit(True))
    df = lookup(df, bad_pkg, {"serv_comp_id": "bad_scid"}, ["bad_pkg"])
    # 11 hidden packages: group values of non-package rows that carry a
    # package account; every row with such a group value is flagged.
    non_pk = df.where(~contains_lit("product_inst_id", "PK-", ignore_case=True))
    hidden = semi_in(latis_active.where(F.col("pkg_acct_id").isNotNull()), non_pk, {"component_grp_val": "component_grp_val_id"})
    hidden = hidden.select(F.col("component_grp_val").alias("h_cgv")).distinct().withColumn("hidden", F.lit(True))
    df = lookup(df, hidden, {"component_grp_val_id": "h_cgv"}, ["hidden"])
    df = staged_status(df, "status", [
        Stage("fill", F.col("bad_pkg"), st.pk_no_piid),
        Stage("fill", F.col("hidden"), st.hidden_pkg),
    ]).drop("bad_pkg", "hidden")

    # 12 package status.
    is_pk = contains_lit("product_inst_id", "PK-", ignore_case=True)
    df = df.withColumn("pkg_cgv", F.when(is_pk, F.substr(F.col("product_inst_id"), F.lit(4))).otherwise(F.col("pkg_cgv")))
    if "package_status" in t:
        pkg = semi_in(t["package_status"], df.where(is_pk), {"component_grp_val": "pkg_cgv"})
    else:
        pkg = package_status_source(t["active_products"], t["rate_header"], df.where(is_pk))
    pkg = stage_cut(pkg)  # read for the invoice accounts and for the rules
    inv = t.get("invoice_amounts")
    need_inv = pkg.where((F.col("workflowstatus") == "In Progress") & (F.col("diff") != 0)).select("inv_ban")
    if inv is None and all(x in t for x in INVOICE_TABLES):
        inv = invoice_sums(invoice_pull(t, need_inv, "inv_ban", first_of_prev_month_date(_dt.date(year, month, 1)), stage_cut))
    elif inv is None and "invoice" in t:
        inv = invoice_amounts(t["invoice"], t["invoice_detail"], _dt.date(year, month, 1), t.get("acct_map"), t.get("service"),
                              t.get("service_attr"), bans=need_inv)
    pkg_status_df, pkg_status = package_status(pkg, inv, st)
    # of several lines of a package a cancel decides before a proceed, and that before none
    rank = F.array_position(F.array(F.lit(st.proceed_rerate), F.lit(st.proceed_reversal), F.lit(st.mrr)), F.col("pkg_status"))
    df = lookup(df, pkg_status.withColumn("pkg_rank", F.coalesce(rank, F.lit(0))), {"pkg_cgv": "component_grp_val"},
                {"pkg_dsc": "pkg_description", "pkg_status": "pkg_status"}, on_multi="first", order=["pkg_rank desc", "pkg_dsc desc nulls last"])
    df = df.withColumn("status", F.coalesce(F.col("status"), F.col("pkg_status")))

    df = stage_cut(df)

    # 13 term end: primary (latest per instance), else fallback. The terms of a
    # component id go to every instance that uses it; each side is reduced to
    # its latest per component id first, so a hot id gives one row per instance.
    written = df  # key sets are read from the rows as they were written
    sc = df.where(F.col("product_inst_id").isNotNull()).select("serv_comp_id", "product_inst_id").distinct()
    if "circuit_component" in t:
        r4_ted = term_pull(t["circuit_component"], t["circuit"], sc).withColumnsRenamed({"product_inst_id": "ma_piid", "term_end_date": "r4_termenddate"})
    else:
        r4 = semi_in(t["term_primary"], written, {"circuit_scid": "serv_comp_id"}, sieve=True)
        r4 = first_per_group(r4, "circuit_scid", ["r4_termenddate desc nulls last", "circuit_piid asc nulls last"])
        r4 = lookup(r4, sc, {"circuit_scid": "serv_comp_id"}, {"product_inst_id": "ma_piid"})
        r4_ted = dedupe_latest(r4, "ma_piid", "r4_termenddate", tie="circuit_scid")
    df = lookup(df, r4_ted, {"product_inst_id": "ma_piid"}, {"r4_termenddate": "r4_term_end_date"})
    ctd = semi_in(t["term_fallback"], written, {"piid": "product_inst_id"}, sieve=True).withColumn("scid", key_concat("component_group_cd", "scid"))
    ctd_ted = lookup(ctd, sc, {"scid": "serv_comp_id"}, {"product_inst_id": "ma_piid"}).where(F.col("ma_piid").isNotNull())
    ends = ctd.groupBy("scid").agg(F.max("service_end_date").alias("end"))
    ends = lookup(ends, sc, {"scid": "serv_comp_id"}, {"product_inst_id": "ma_piid"}).groupBy("ma_piid").agg(F.max("end").alias("end"))
    df = lookup(df, ends, {"product_inst_id": "ma_piid"}, {"end": "r4_term_end_date"}, mode="fill")

    # 14 in-term exception (overwrite): a circuit in term cancels every row of its unique key.
    cancel = in_term_cancel(
        F.col("r4_term_end_date"), cycle_date(year, month, day).cast("timestamp"), F.col("subprojname"), F.col("business_unit"),
        F.col("cust_contract_term_end_dt"), PASS_THROUGH_PROJECT, DISCONTINUANCE_PROJECT, WHOLESALE,
    )
    df = lookup(df, any_match(df, "unique", cancel, "in_term"), "unique", ["in_term"])
    df = staged_status(df, "status", [Stage("overwrite", F.col("in_term"), st.in_term)]).drop("in_term")

    # 15 service element and component code (replace, as the source does).
    no_seid = df.where(is_blank("service_element_id"))
    if "service_elements" in t:
        seid = semi_in(t["service_elements"], no_seid, {"component_grp_val": "component_grp_val_id"})
    elif "component_group" in t:
        seid = account_pull(t, cut=stage_cut, values=no_seid, components=no_seid)
    else:
        seid = account_star(t, group_vals=no_seid, components=no_seid)
    seid = seid.withColumn("seid_unique", key_concat("component_group_cd", "component_grp_val", "prcmp_dsc"))
    df = lookup(df, seid, {"unique": "seid_unique"}, {"service_element_id": "service_element_id", "prcmp_code": "prod_cmpnt_cd"},
                on_multi="first", order=["service_element_id asc nulls last", "prcmp_code asc nulls last"])

    # 16 pre-billed flag repair.
    f = F.col("pre_billed_ind")
    df = df.withColumn("pre_billed_ind", F.when(is_blank(f) | (f == "N"),
                                                F.when(contains_lit("promo_code", "PKG", ignore_case=True), F.lit("N")).otherwise(F.lit("Y"))).otherwise(f))

    if rest is not None:
        df = df.join(rest, "__row").select(*names, *[c for c in df.columns if c not in names and c != "__row"])
    df = stage_cut(df)

    # 17 instance-level status.
    rr_scid = priority_rollup(df, "product_inst_id", "status", [st.disconnect, st.move_back, st.mrr], None, "piid_level_status", per_row=True)
    return {
        "tstage": tstage, "latis_active": latis_active, "kenan_prod": kenan_prod, "latis_prod": latis_prod, "ses": ses,
        "qty_ref": qref, "latis_active_updated": la_upd, "pkg_status_df": pkg_status_df, "pkg_status": pkg_status,
        "r4_ted": r4_ted, "ctd_ted": ctd_ted, "seid": seid, "rr_scid": rr_scid,
    }


def _overwrite_found(df: DataFrame, found: str, unrated: str, move_back: str, mode: str) -> DataFrame:
    """Rows whose rate is blank or differs from the current rate are
    checked against the products that they match, one by one: a rate
    (``found``) is written to every row of the same component id (smallest
    when several); where no product matches, or any of them has a blank rate
    (``unrated``), and the component id is also among the reversals, every
    row of the same ``unique`` key gets the move-back status (``mode``)."""
    # the subset is taken before any rate is written (as the source's loop does)
    df = df.withColumn("__mism", is_blank("kenan") | ~F.col("scp_current_rate").cast("double").eqNullSafe(F.col("kenan")))
    df = df.withColumn("__hit", F.when(F.col("__mism"), F.col(found)))
    df = propagate_by_key(df, "serv_comp_id", "__hit", "kenan", order=["__hit"], mode="overwrite")
    mb = any_match(df, "unique", F.col("__mism") & (F.col(found).isNull() | F.col(unrated)) & F.coalesce(F.col("rev_scid"), F.lit(False)), "__mb")
    df = lookup(df, mb, "unique", ["__mb"])
    df = staged_status(df, "status", [Stage(mode, F.col("__mb"), move_back)])
    return df.drop("__mism", "__hit", "__mb", found, unrated)


def propagate_src(df: DataFrame, key: str, value: str, order) -> DataFrame:
    """One (key, value) row per key: the last row under ``order`` as
    the source loop would leave it (given here as the first under the
    reversed order)."""
    return first_per_group(df.where(~is_blank(value)), key, order).select(key, value)


def package_status(pkg: DataFrame, invoice_amounts: DataFrame | None, st: Statuses) -> tuple[DataFrame, DataFrame]:
    """Package status per package group value: in progress with no
    difference -> proceed; reversal whose estimate equals the new rate ->
    proceed with reversal (difference then 0); in progress with a difference
    -> the invoice sum of the package decides for every line of a package
    found in those invoices (equal to current -> proceed, equal to neither
    current nor estimate -> cost change)."""
    wf = F.col("workflowstatus")
    diff = F.col("diff").cast("double")
    s0 = F.when((diff == 0) & (wf == "In Progress"), F.lit(st.proceed_rerate))
    rev = (diff != 0) & (wf == "Reversal") & (F.col("monthly_rev_est") == F.col("piid_new_rate"))
    first = pkg.withColumn("pkg_status", F.when(rev, F.lit(st.proceed_reversal)).otherwise(s0))
    first = first.withColumn("diff", F.when(F.col("pkg_status") == st.proceed_reversal, F.lit(0.0)).otherwise(diff))
    if invoice_amounts is None:
        return pkg, first
    j = lookup(first, invoice_amounts, {"scid": "package_id"}, {"amount": "inv_amount"})
    # invoices were pulled for the BANs of in-progress packages with a
    # difference; every package line found in them is re-evaluated
    inprog = F.col("inv_amount").isNotNull()
    amt = F.col("inv_amount").cast("decimal(18,2)")
    cur = F.col("piid_current_rate").cast("decimal(18,2)")
    est = F.col("monthly_rev_est").cast("decimal(18,2)")
    out = j.withColumn(
        "pkg_status",
        F.when(inprog & (cur == amt), F.lit(st.proceed_rerate))
        .when(inprog & (cur != amt) & (est != amt), F.lit(st.mrr))
        .otherwise(F.col("pkg_status")),
    ).drop("inv_amount")
    return pkg, out
