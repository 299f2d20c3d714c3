"""The production pulls in full, each as one reduced star.

``billing_pull``, ``order_pull``, ``account_pull``, ``invoice_pull``, ``package_pull`` and ``term_pull`` join
every relation of the source's queries that decides about a row or a column; ``None`` tables are not
accepted, and an absent column is an error.
Filters on the optional side of an outer join come before it where the
source puts them into the join, and after it where it puts them into WHERE: a
product all of whose overrides are closed then drops out, one without any stays.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.functions.columns import money
from reckon.functions.dates import ts_literal
from reckon.operators.lookup import lookup, semi_in, sieved
from reckon.operators.pivot import pivot_attributes
from reckon.operators.star import Dim, decode_roles, star
from reckon.plans.stars import ACCT_BAN, ACCT_BUS_ORG, ACCT_INVOICE_BAN, EQUIP_ID_TYPES, PACKAGE_PARAM, PRODUCT_PARAMS, SERVICE_PARAMS

#: Fixed codes: language of display values, association of a component element with a product.
LANGUAGE, PRODUCT_ASSOCIATION = 1, 1
#: Fixed codes: kinds of alternate ids of a service.
CIRCUIT_ID_KINDS, INSTANCE_ID_KINDS = ("85454", "87879", "85469", "105652"), ("24256", "21701")

BILLING_TABLES = (
    "product", "id_map", "service", "config_values", "account", "acct_map", "customer_map", "component_element", "package_component", "package_values",
    "component_values", "product_key", "rate_override", "bill_periods", "currency", "product_attr", "service_attr",
)


def _need(t: dict[str, DataFrame], names) -> None:
    if missing := [n for n in names if t.get(n) is None]:
        raise ValueError(f"tables missing: {missing}")


def billing_pull(t: dict[str, DataFrame], keys: DataFrame, key_col: str, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Products still billing, of subscribers that carry one of the external ids in ``keys``, with
    service, accounts, packages, rates, display values and attributes. Distinct rows."""
    _need(t, BILLING_TABLES)
    subs, track = ["subscr_no", "subscr_no_resets"], ["tracking_id", "tracking_id_serv"]
    of_sub = {"parent_subscr_no": "subscr_no", "parent_subscr_no_resets": "subscr_no_resets"}
    own = {c: c for c in track}
    wanted = semi_in(t["id_map"], keys, {"external_id": key_col}, sieve=True).select(*subs)
    product = semi_in(t["product"].where(F.col("billing_inactive_dt").isNull()), wanted, of_sub, sieve=True)

    def shown(name: str) -> DataFrame:
        return t[name].where(F.col("language_code") == LANGUAGE)

    def attrs(name: str, on: dict[str, str], params: dict[str, str], parent: str) -> Dim:
        rows = t[name].where(F.col("param_id").isin(list(params)))
        return Dim(name, rows, on, {c: c for c in params.values()}, parent, after=lambda r: pivot_attributes(r, "view_id", "param_id", "param_value", params))

    ids = [
        Dim(f"id{kind}", t["id_map"].where(F.col("external_id_type") == kind), of_sub, {"external_id": name, "inactive_date": f"inactive_{kind}"})
        for kind, name in EQUIP_ID_TYPES.items()
    ]
    acct = t["acct_map"]
    # the wide rows are shuffled by line, view, subscriber and, last, by account, by which they are also made distinct
    dims = [
        Dim("component", shown("component_values"), {"component_id": "component_id"}, {"display_value": "component"}, inner=True, code=True),
        Dim("period_name", t["bill_periods"], {"bill_period": "bill_period"}, {"display_value": "period_name"}, code=True),
        Dim("override", t["rate_override"], own, {"override_rate": "override_rate", "inactive_dt": "override_inactive_dt"}),
        Dim("key", t["product_key"], own, {"create_dt": "create_dt"}),
        Dim("element", t["component_element"].where(F.col("association_type") == PRODUCT_ASSOCIATION), dict(zip(track, ["association_id", "association_id_serv"]))),
        Dim("package_component", t["package_component"], {c: c for c in ("component_inst_id", "component_inst_id_serv")}, parent="element"),
        Dim("package", shown("package_values"), {"package_id": "package_id"}, {"display_value": "package"}, parent="package_component", code=True),
        attrs("product_attr", {"view_id": "view_id"}, PRODUCT_PARAMS, ""),
        *ids,
        Dim("service", t["service"], of_sub, {"emf_config_id": "config_id", "no_bill": "service_no_bill", "chg_who": "last_changed_by"}, inner=True),
        Dim("config", shown("config_values"), {"emf_config_id": "emf_config_id"}, {"display_value": "config_value"}, parent="service", inner=True, code=True),
        attrs("service_attr", {"view_id": "view_id"}, SERVICE_PARAMS, "service"),
        Dim("account", t["account"], {"parent_account_no": "account_no"},
            {"account_type": "account_type", "bill_company": "bill_company", "no_bill": "account_no_bill", "bill_period": "account_period"}, inner=True),
        Dim("ban", acct.where(F.col("external_id_type") == ACCT_BAN), {"account_no": "account_no"}, {"external_id": "ban"}, parent="account", inner=True),
        Dim("invoice_ban", acct.where(F.col("external_id_type") == ACCT_INVOICE_BAN), {"account_no": "account_no"}, {"external_id": "invoice_ban"}, parent="account", inner=True),
        Dim("bus_org", t["customer_map"].where((F.col("external_id_type") == ACCT_BUS_ORG) & (F.col("is_current") == 1)), {"account_no": "account_no"}, {"external_id": "bus_org_id"}, parent="account"),
        Dim("currency", shown("currency"), {"currency_code": "currency_code"}, {"display_value": "currency"}, parent="account", code=True),
        Dim("account_period_name", t["bill_periods"], {"bill_period": "bill_period"}, {"display_value": "account_period_name"}, parent="account", code=True),
    ]
    j = star(product, dims, cut)
    # filters that the source puts into WHERE: unmatched rows stay
    j = j.where(F.col("inactive_1").isNull() & F.col("override_inactive_dt").isNull())
    return j.select(
        F.col("parent_subscr_no").alias("subscr_no"), "account_type", "bus_org_id", "ban", "invoice_ban",
        F.col("parent_account_no").cast(t["account"].schema["account_no"].dataType).alias("account_no"), "bill_company", "package", "component",
        "config_id", "config_value", "product_active_dt", "product_inactive_dt", *[f"inactive_{k}" for k in EQUIP_ID_TYPES],
        F.col("no_bill").alias("product_no_bill"), "account_no_bill", "service_no_bill",
        F.when(F.col("bill_period").isNotNull(), F.col("period_name")).otherwise(F.col("account_period_name")).alias("bill_period"),
        *EQUIP_ID_TYPES.values(), "create_dt", "currency", (F.col("override_rate") / 100).alias("bill_rate"), "last_changed_by",
        *PRODUCT_PARAMS.values(), *SERVICE_PARAMS.values(),
    ).distinct()


#: The roles of the order lookup table: result column -> foreign key.
ORDER_ROLES = {
    "service_provisioning_status": "provisioning_status_id", "service_action": "service_action_id", "service_status": "service_status_id",
    "order_action": "order_action_id", "order_type": "order_type_id", "order_status": "order_status_id",
}


def order_pull(t: dict[str, DataFrame], keys: DataFrame, key_col: str, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Orders of the services in ``keys`` with notes, circuit and instance ids (a service with several has a row
    for each) and six codes decoded through one lookup table with one join. Rows as they come, not distinct."""
    _need(t, ("order", "service", "alternate_id", "note", "order_lookup"))
    service = semi_in(t["service"], keys, {"service_id": key_col}, sieve=True)
    kind = F.col("kind_id")
    dims = [
        Dim("order", t["order"], {"order_no": "order_no"},
            {c: c for c in ("order_id", "customer_order_id", "created_date", "last_updated_date", "order_action_id", "order_type_id", "order_status_id")}, inner=True),
        Dim("circuit", t["alternate_id"].where(kind.isin(*CIRCUIT_ID_KINDS)), {"service_no": "service_no"}, {"value": "circuit"}),
        Dim("instance", t["alternate_id"].where(kind.isin(*INSTANCE_ID_KINDS)), {"service_no": "service_no"}, {"value": "instance_id"}),
        Dim("note", t["note"], {"service_no": "service_no"}, {"note_text": "note_text"}),
    ]
    j = decode_roles(star(service, dims, cut), t["order_lookup"], "lookup_id", "lookup_value", ORDER_ROLES)
    return j.select("order_id", "customer_order_id", "service_id", "created_date", "bill_start_date", "last_updated_date", "note_text", "instance_id", "circuit", *ORDER_ROLES)


ACCOUNT_TABLES = ("acct_group", "contract", "service_element", "acct_component", "product_acct", "application", "component_def", "component_group")


def account_pull(
    t: dict[str, DataFrame], instances: DataFrame | None = None, inst_col: str = "product_inst_id", cut: Callable[[DataFrame], DataFrame] | None = None,
    values: DataFrame | None = None, value_col: str = "component_grp_val_id", components: DataFrame | None = None, component_col: str = "component",
) -> DataFrame:
    """Component groups of the circuits in ``instances`` (of the group values in ``values``, with the component
    descriptions in ``components``) with application, contract, service elements, open
    components and their definitions, product account and group (its columns as ``cg_*``). Distinct rows.

    A group without any component stays, with nulls; one whose components are all closed drops out.
    Relations of the source that give no column (element attributes, customers, product combinations) are
    not joined: each is an outer join that only repeats rows, and the result is distinct.
    """
    _need(t, ACCOUNT_TABLES)
    root, definition, named = t["acct_group"], t["component_def"], components is not None
    if instances is not None:
        root = semi_in(root, instances, {"common_ckt": inst_col})
    if values is not None:
        root = semi_in(root, values, {"component_grp_val": value_col})
    if named:  # a condition on the definition makes its joins inner
        definition = semi_in(definition, components, {"prcmp_dsc": component_col})
    account, place = {"product_account_id": "product_account_id"}, {c: c for c in ("component_grp_val", "component_group_cd")}
    component = ("prcmp_code", "prcmp_override_dt", "promotion_bgn_date", "promotion_end_date", "bill_eff_bgn_date", "bill_eff_end_date", "billed_thru_date", "monthly_rev_est")
    group = {c: f"cg_{c}" for c in t["component_group"].columns}
    # by place last: the distinct rows need no shuffle of their own, and an account's wide rows travel before they fan out
    dims = [
        Dim("contract", t["contract"], account, {c: c for c in ("contract_date", "term_length", "termination_date")}),
        Dim("product_acct", t["product_acct"], account, {c: c for c in ("customer_acct_id", "product_code")}),
        Dim("component", t["acct_component"], account | {"occurrence_number": "occurrence_number"}, {c: c for c in component}, inner=named),
        Dim("application", t["application"], {"application_code": "application_code"}, {"application_cd_dsc": "application_cd_dsc"}, code=True),
        Dim("definition", definition, {"prcmp_code": "prcmp_code"}, {c: c for c in ("prcmp_id", "prcmp_dsc", "billable_ind")}, parent="component", inner=named, code=True),
        Dim("group", t["component_group"], {"component_group_cd": "component_group_cd"}, group, code=True),
        Dim("element", t["service_element"], place, {"service_element_id": "service_element_id"}),
    ]
    j = star(root, dims, cut).where(F.col("bill_eff_end_date").isNull())  # WHERE of the source: unmatched rows stay
    return j.select(
        "application_code", "application_cd_dsc", "occurrence_number", "product_account_id", "common_ckt", "component_group_cd", "component_grp_val", "customer_acct_id",
        "contract_date", "term_length", "termination_date", "prcmp_id", "prcmp_dsc", "billable_ind", *component, "service_element_id", "product_code", *group.values(),
    ).distinct()


INVOICE_TABLES = (
    "account", "invoice", "invoice_detail", "acct_map", "customer_map", "currency", "descriptions", "package_values", "id_map", "service", "service_attr",
)
#: Fixed codes: invoices before the checks and after them, a package and a type of line that are left out.
PREPARED, POSTED, NO_PACKAGE, NO_TYPE = 1, 4, 1111, 5


def invoice_pull(t: dict[str, DataFrame], bans: DataFrame, ban_col: str, since: _dt.date, cut: Callable[[DataFrame], DataFrame] | None = None, prep_status: int = PREPARED) -> DataFrame:
    """Package lines of the invoices of the accounts in ``bans`` that were stated from ``since`` on, with
    account ids, display values, circuit ids and the package of the service. Rows as they come: a line whose
    service has two ids of a type occurs twice, as in the source."""
    _need(t, INVOICE_TABLES)
    of_sub = {c: c for c in ("subscr_no", "subscr_no_resets")}
    account = {"account_no": "account_no"}
    d, inv = t["invoice_detail"], t["invoice"]
    lines = d.where((F.col("package_id") != NO_PACKAGE) & (F.col("subtype_code") >= 0) & (F.col("type_code") != NO_TYPE))
    invoices = inv.where((F.col("statement_date") >= ts_literal(inv, "statement_date", since)) & (F.col("prep_status") == prep_status))
    own_ban = semi_in(t["acct_map"].where(F.col("external_id_type") == ACCT_INVOICE_BAN), bans, {"external_id": ban_col})
    if cut:  # the few invoices of the accounts sieve the lines
        own_ban = cut(own_ban)
        invoices = cut(semi_in(invoices, own_ban, account))
        lines = sieved(lines, invoices, {"bill_ref_no": "bill_ref_no"})
    packages = t["service_attr"].where((F.col("param_id") == PACKAGE_PARAM) & F.col("param_value").isNotNull())

    def shown(name: str) -> DataFrame:
        return t[name].where(F.col("language_code") == LANGUAGE)

    def circuit(kind: int) -> DataFrame:
        return t["id_map"].where(F.col("external_id_type") == kind)

    dims = [
        # key sets pass from the last relation on: the few invoices of the accounts reduce the lines before their services do
        Dim("service", t["service"], of_sub, {}, inner=True),
        Dim("attr", packages, {"view_id": "view_id"}, {"param_value": "service_package_id"}, parent="service", inner=True),
        Dim("invoice", invoices, {"bill_ref_no": "bill_ref_no"}, {c: c for c in ("prep_date", "statement_date", "prep_status")}, inner=True),
        Dim("account", t["account"], account, {"bill_company": "bill_company"}, parent="invoice", inner=True),
        Dim("ban", own_ban, account, {"external_id": "ban"}, parent="invoice", inner=True),
        Dim("bus_org", t["customer_map"].where((F.col("external_id_type") == ACCT_BUS_ORG) & (F.col("is_current") == 1)), account, {"external_id": "bus_org_id"}, parent="invoice"),
        Dim("currency", shown("currency"), {"rate_currency_code": "currency_code"}, {"short_display": "currency"}, code=True),
        Dim("description", shown("descriptions"), {"description_code": "description_code"}, {"description_text": "description_text"}),
        Dim("package", shown("package_values"), {"package_id": "package_id"}, {"display_value": "package"}, code=True),
        Dim("primary", circuit(1), of_sub, {"external_id": "primary_id"}),
        Dim("instance", circuit(5), of_sub, {"external_id": "piid"}),
    ]
    j = star(lines, dims, cut)
    return j.select(
        F.when(F.col("billing_level") == 0, F.lit("ACCOUNT")).otherwise(F.lit("SERVICE")).alias("billing_level"), "prep_date", "statement_date", "prep_status", "bus_org_id",
        "bill_company", "ban", F.date_format("from_date", "MM/dd/yyyy").alias("from_date"), F.date_format("to_date", "MM/dd/yyyy").alias("to_date"), "package", "description_text",
        "currency", money(money("amount", 18, 0) / 100).alias("amount"), "primary_id", "piid", F.col("service_package_id").alias("package_id"),
        "type_code", "annotation", "discount", "discount_id", "subtype_code",
    )


def invoice_sums(lines: DataFrame) -> DataFrame:
    """package_id, amount: the exact sum of a package's lines (``invoice_pull``), combined before the shuffle."""
    return lines.groupBy("package_id").agg(money(F.sum("amount")).alias("amount"))


def package_pull(active_products: DataFrame, rate_header: DataFrame, packages: DataFrame, value_col: str, header_col: str) -> DataFrame:
    """Active products of the group values in ``packages`` with the header of their package instance (the last
    eight characters of its id), for the header ids in ``packages`` alone, so that the source's outer join is inner."""
    products = semi_in(active_products, packages, {"component_grp_val": value_col})
    header = semi_in(rate_header, packages, {"piid_meid": header_col}).withColumn("__value", F.right("product_inst_id", F.lit(8)))
    j = products.join(header, F.col("component_grp_val") == F.col("__value"))
    return j.select(
        "component_grp_val", F.concat("component_group_cd", "component_grp_val").alias("scid"), "bill_acct_nbr", "inv_ban", "piid_meid", "workflowstatus", "pkg_dsc",
        "monthly_rev_est", "piid_current_rate", (F.col("monthly_rev_est") - F.col("piid_current_rate")).alias("diff"), "piid_new_rate",
    )


def term_pull(circuit_component: DataFrame, circuit: DataFrame, rows: DataFrame) -> DataFrame:
    """product_inst_id, circuit_scid, circuit_piid, term_end_date: the latest term of the circuits on which
    the components (``serv_comp_id``) of each instance in ``rows`` lie; ties by largest ids. An
    instance whose circuits have no term has a null one; without a circuit it is not in the result.

    The source joins circuits, components and rows before it picks the latest. Here each relation is
    brought to one row a key first, so that both joins are many-to-one and a hot component repeats nothing.
    """
    wanted = rows.select("serv_comp_id", "product_inst_id").where("serv_comp_id is not null and product_inst_id is not null").distinct()
    parts = semi_in(circuit_component, wanted, {"circuit_scid": "serv_comp_id"}, sieve=True).select("circuit_scid", "circuit_piid").distinct()
    last = semi_in(circuit, parts, {"product_inst_id": "circuit_piid"}).groupBy(F.col("product_inst_id").alias("circuit_piid")).agg(F.max("term_end_date").alias("term_end_date"))
    best = F.max(F.struct("term_end_date", "circuit_scid", "circuit_piid")).alias("best")
    per_scid = lookup(parts, last, "circuit_piid", ["term_end_date"]).groupBy("circuit_scid").agg(best)
    found = wanted.join(per_scid, F.col("serv_comp_id") == F.col("circuit_scid"))
    found = found.groupBy("product_inst_id").agg(F.max("best").alias("best"))
    return found.select("product_inst_id", "best.circuit_scid", "best.circuit_piid", "best.term_end_date")
