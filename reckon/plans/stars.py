"""Star-schema pulls used by the cycle preparation and classification.

Written the way the source queries are meant: dimension filters inside the
join condition (filter the right side first), typed-id map reduced to the
wanted subscribers before its join per type (every id stays), attribute
table pivoted once per view instead of one correlated subquery per
attribute, and the key list applied as a semi-join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import ci_eq, scale_by_decimals
from reckon.functions.dates import first_of_prev_month, ts_literal
from reckon.operators.lookup import lookup, semi_in
from reckon.operators.pivot import fan_out_typed_ids, pivot_attributes, role_dims

# Typed external ids of the equipment map (fixed codes -> column names).
EQUIP_ID_TYPES = {1: "primary_type_1", 5: "piid_type_5", 6: "scid_type_6", 65: "former_prim_type_65"}
# Account id types (fixed codes).
ACCT_BAN, ACCT_INVOICE_BAN, ACCT_BUS_ORG = 1, 150, 80
# Product attribute parameter ids (fixed codes -> column names).
PRODUCT_PARAMS = {"29": "description_override", "28": "description_override1", "166": "prcmp_desc", "165": "prcmp_code", "164": "prcmp_id"}
SERVICE_PARAMS = {"107": "circuit_id"}


def billing_star(t: dict[str, DataFrame], keys: DataFrame | None = None, key_col: str = "serv_comp_id", active_only: bool = True) -> DataFrame:
    """Billing products with their typed ids, accounts, override rate and
    attributes. ``keys`` (a frame of ids) restricts to subscribers that
    carry one of those external ids (semi-join, not an IN list).
    ``active_only`` keeps products still billing and an active primary id
    (the rate pull); without it stopped products stay (the stop-date pull)."""
    idm = t["id_map"]
    subs = ["subscr_no", "subscr_no_resets"]
    p = t["product"].where(F.col("billing_inactive_dt").isNull()) if active_only else t["product"]
    if keys is not None:
        # Reduce by keys first: wanted subscribers, then only their products,
        # ids, accounts and attribute views enter the pivots and joins.
        wanted = semi_in(idm.select(*subs, "external_id"), keys, {"external_id": key_col}).select(*subs).distinct()
        p = p.join(wanted, (p.parent_subscr_no == wanted.subscr_no) & (p.parent_subscr_no_resets == wanted.subscr_no_resets), "left_semi")
        idm = idm.join(wanted, subs, "left_semi")
    # Type-1 id must be active (its filter is in WHERE: outer join degraded to inner).
    if active_only:
        idm = idm.where(F.col("inactive_date").isNull() | (F.col("external_id_type") != 1))
    # every id of a type stays, as its own row
    ids = fan_out_typed_ids(idm, subs, "external_id_type", "external_id", EQUIP_ID_TYPES)
    ids = ids.withColumnsRenamed({"subscr_no": "i_subscr_no", "subscr_no_resets": "i_subscr_no_resets"})
    j = p.join(ids, (p.parent_subscr_no == ids.i_subscr_no) & (p.parent_subscr_no_resets == ids.i_subscr_no_resets), "inner")
    j = j.where(F.col("primary_type_1").isNotNull()).drop("i_subscr_no", "i_subscr_no_resets")
    acct = t["account"].select("account_no", "account_type", "bill_company", "currency_code")
    j = j.join(acct, j.parent_account_no == acct.account_no, "inner")
    am = semi_in(t["acct_map"], j, {"account_no": "account_no"})
    bans = fan_out_typed_ids(am.where((F.col("external_id_type") != ACCT_BUS_ORG) | (F.col("is_current") == 1)), "account_no",
                             "external_id_type", "external_id", {ACCT_BAN: "ban", ACCT_INVOICE_BAN: "invoice_ban", ACCT_BUS_ORG: "bus_org_id"})
    # BAN types are required by the WHERE clause (inner); bus org is optional.
    j = lookup(j, bans.where(F.col("ban").isNotNull() & F.col("invoice_ban").isNotNull()), "account_no", ["ban", "invoice_ban", "bus_org_id"])
    j = j.where(F.col("ban").isNotNull())
    # Override rate: left join on open overrides only (filter before the join).
    pro = t["rate_override"].where(F.col("inactive_dt").isNull())
    j = lookup(j, pro, ["tracking_id", "tracking_id_serv"], ["override_rate"], on_multi="first", order=["override_rate desc"])
    cur = t["currency"].select("currency_code", "implied_decimal")
    j = lookup(j, cur, "currency_code", ["implied_decimal"], broadcast=True)
    pattrs = pivot_attributes(semi_in(t["product_attr"], j, "view_id"), "view_id", "param_id", "param_value", PRODUCT_PARAMS)
    j = lookup(j, pattrs, "view_id", list(PRODUCT_PARAMS.values()))
    return j.select(
        "primary_type_1", "scid_type_6", "piid_type_5", "former_prim_type_65", "account_no", "account_type", "bill_company", "ban",
        "invoice_ban", "bus_org_id", "parent_subscr_no", "product_active_dt", "product_inactive_dt", "billing_inactive_dt",
        (F.col("override_rate") / 100).alias("bill_rate"),
        scale_by_decimals("override_rate", F.coalesce(F.col("implied_decimal"), F.lit(2))).alias("bill_rate_scaled"),
        *PRODUCT_PARAMS.values(),
    )


def ses_star(order: DataFrame, order_service: DataFrame, lookup_dim: DataFrame, keys: DataFrame | None = None,
             key_col: str = "serv_comp_id", open_type: int = 150) -> DataFrame:
    """Orders per service with their coded attributes decoded through one
    shared lookup table used in several roles (status, action, type ...)."""
    os_ = order_service
    if keys is not None:
        os_ = semi_in(os_, keys, {"service_id": key_col})
    j = os_.join(order, "order_id", "inner")
    roles = {"order_status": "status_id", "order_type": "type_id", "service_action": "action_id"}
    j = role_dims(j, lookup_dim.select("id", "value"), "id", roles, ["value"])
    return j.select(
        "service_id", "order_id", "created_date", "last_updated_date",
        F.col("order_status_value").alias("order_status"), F.col("order_type_value").alias("order_type"),
        F.col("service_action_value").alias("service_action"),
    )


ACCOUNT_STAR_COLUMNS = [
    "application_code", "occurrence_number", "product_account_id", "common_ckt", "component_group_cd", "component_grp_val",
    "customer_acct_id", "contract_date", "term_length", "termination_date", "prcmp_id", "prcmp_code", "prcmp_dsc", "billable_ind",
    "bill_eff_bgn_date", "bill_eff_end_date", "monthly_rev_est", "service_element_id", "product_code",
]


def account_star(
    t: dict[str, DataFrame],
    instances: DataFrame | None = None,
    inst_col: str = "product_inst_id",
    group_vals: DataFrame | None = None,
    gv_col: str = "component_grp_val_id",
    components: DataFrame | None = None,
    comp_col: str = "component",
) -> DataFrame:
    """Open account components (billing end date null: the filter on the
    optional side makes that join inner) of the given circuit instances
    and/or group values and component descriptions, with contract, service
    element and product account attributes. DISTINCT like the source."""
    c = t["acct_group"]
    if instances is not None:
        c = semi_in(c, instances, {"common_ckt": inst_col})
    if group_vals is not None:
        c = semi_in(c, group_vals, {"component_grp_val": gv_col})
    pac = t["acct_component"].where(F.col("bill_eff_end_date").isNull())
    j = c.join(pac, ["product_account_id", "occurrence_number"], "inner")
    j = j.join(t["component_def"].select("prcmp_code", "prcmp_id", "prcmp_dsc", "billable_ind"), "prcmp_code", "left")
    if components is not None:
        j = semi_in(j, components, {"prcmp_dsc": comp_col})
    if "contract" in t:
        j = j.join(t["contract"].select("product_account_id", "contract_date", "term_length", "termination_date"), "product_account_id", "left")
    if "service_element" in t:
        j = j.join(t["service_element"].select("component_group_cd", "component_grp_val", "service_element_id"),
                   ["component_group_cd", "component_grp_val"], "left")
    if "product_acct" in t:
        j = j.join(t["product_acct"].select("product_account_id", "customer_acct_id", "product_code"), "product_account_id", "left")
    cols = [F.col(x) if x in j.columns else F.lit(None).cast("string").alias(x) for x in ACCOUNT_STAR_COLUMNS]
    return j.select(*cols).distinct()


# Service attribute holding the package of an invoice line (fixed code).
PACKAGE_PARAM = "742"


def invoice_amounts(
    invoice: DataFrame,
    detail: DataFrame,
    run_date: _dt.date,
    acct_map: DataFrame | None = None,
    service: DataFrame | None = None,
    service_attr: DataFrame | None = None,
    bans: DataFrame | None = None,
    ban_col: str = "inv_ban",
) -> DataFrame:
    """Package amounts (``amount/100`` summed per package) of the invoices
    prepared since the first of the previous month.

    With the account map, service and service-attribute tables the package
    is the service's package attribute (lines without one are dropped) and
    ``bans`` restricts to invoice BANs (semi-join); without them the
    detail's own ``package_id`` is used."""
    inv = invoice.where(
        (F.col("statement_date") >= ts_literal(invoice, "statement_date", first_of_prev_month_date(run_date))) & (F.col("prep_status") == 1)
    ).select("account_no", "bill_ref_no")
    if acct_map is not None:
        ban = acct_map.where(F.col("external_id_type") == ACCT_INVOICE_BAN).select("account_no", F.col("external_id").alias("ban"))
        if bans is not None:
            ban = semi_in(ban, bans, {"ban": ban_col})
        inv = inv.join(ban, "account_no", "left_semi")
    d = detail.where(
        (F.col("package_id") != 1111) & F.col("package_id").isNotNull() & (F.col("subtype_code") >= 0) & (F.col("type_code") != 5)
    )
    j = d.join(inv.select("bill_ref_no"), "bill_ref_no", "left_semi")
    if service is not None and service_attr is not None:
        pkg = service_attr.where(F.col("param_id") == PACKAGE_PARAM).select("view_id", F.col("param_value").alias("pkg"))
        svc = service.select("subscr_no", "subscr_no_resets", "view_id").join(pkg, "view_id").drop("view_id")
        j = j.join(svc, ["subscr_no", "subscr_no_resets"], "inner").where(F.col("pkg").isNotNull())
        key = F.col("pkg")
    else:
        key = F.col("package_id").cast("string")
    return j.groupBy(key.alias("package_id")).agg(
        (F.sum(F.col("amount").cast("decimal(18,0)")) / 100).cast("decimal(18,2)").alias("amount"))


def package_status_source(active_products: DataFrame, rate_header: DataFrame, rows: DataFrame) -> DataFrame:
    """Package lines of the cycle's package instances: active products of
    the package group values joined to the rate header on the last eight
    characters of the instance id (an equi-join on an expression), only
    for the cycle's rate ids (the WHERE on the header makes it inner).
    ``diff`` = estimated revenue - current rate."""
    ap = semi_in(active_products, rows.where(F.col("pkg_cgv").isNotNull()), {"component_grp_val": "pkg_cgv"})
    opt = lambda c: F.col(c) if c in rate_header.columns else F.lit(None).cast("string").alias(c)
    h = semi_in(rate_header, rows, {"piid_meid": "rr_piid_meid"}).select(
        F.right(F.col("product_inst_id"), F.lit(8)).alias("h_cgv"), opt("bill_acct_nbr"), opt("inv_ban"), "piid_meid", "workflowstatus",
        "piid_current_rate", "piid_new_rate",
    )
    j = ap.join(h, ap["component_grp_val"] == h["h_cgv"], "inner")
    return j.select(
        "component_grp_val", F.concat("component_group_cd", "component_grp_val").alias("scid"), "bill_acct_nbr", "inv_ban", "piid_meid",
        "workflowstatus", "pkg_dsc", F.col("monthly_rev_est").cast("double").alias("monthly_rev_est"),
        F.col("piid_current_rate").cast("double").alias("piid_current_rate"),
        (F.col("monthly_rev_est") - F.col("piid_current_rate")).cast("double").alias("diff"),
        F.col("piid_new_rate").cast("double").alias("piid_new_rate"),
    )


def first_of_prev_month_date(run_date: _dt.date) -> _dt.date:
    first = run_date.replace(day=1)
    return (first - _dt.timedelta(days=1)).replace(day=1)


__all__ = ["account_star", "billing_star", "ses_star", "invoice_amounts", "package_status_source", "first_of_prev_month", "ci_eq"]
