import datetime as dt

from reckon.plans.stars import billing_star, invoice_amounts, ses_star

D = dt.datetime


def test_billing_star(spark):
    t = {
        "product": spark.createDataFrame(
            [(1, 0, 10, 0, 100, "T1", 0, None, D(2024, 1, 1), None, 7),   # active product
             (2, 0, 20, 0, 200, "T2", 0, None, D(2024, 1, 1), None, 8),   # no active type-1 id -> dropped
             (1, 0, 10, 0, 100, "T3", 0, D(2025, 1, 1), D(2024, 1, 1), None, 7)],  # billing stopped -> dropped
            "parent_subscr_no int, parent_subscr_no_resets int, parent_account_no int, x int, component_id int, tracking_id string, "
            "tracking_id_serv int, billing_inactive_dt timestamp, product_active_dt timestamp, product_inactive_dt timestamp, view_id int"),
        "id_map": spark.createDataFrame(
            [(1, 0, "SCID1", 1, None), (1, 0, "OLD1", 1, D(2020, 1, 1)), (1, 0, "PIID1", 5, None), (1, 0, "S6", 6, None),
             (2, 0, "SCID2", 1, D(2020, 1, 1))],
            "subscr_no int, subscr_no_resets int, external_id string, external_id_type int, inactive_date timestamp"),
        "account": spark.createDataFrame([(10, 1, 5, "USD"), (20, 1, 5, "USD")], "account_no int, account_type int, bill_company int, currency_code string"),
        "acct_map": spark.createDataFrame([(10, "BAN1", 1, 1), (10, "IBAN1", 150, 1), (10, "BO1", 80, 1), (10, "BO-old", 80, 0)],
                                          "account_no int, external_id string, external_id_type int, is_current int"),
        "rate_override": spark.createDataFrame([("T1", 0, 1250, None), ("T1", 0, 9999, D(2020, 1, 1))],
                                               "tracking_id string, tracking_id_serv int, override_rate long, inactive_dt timestamp"),
        "currency": spark.createDataFrame([("USD", 2)], "currency_code string, implied_decimal int"),
        "product_attr": spark.createDataFrame([(7, "166", "Port"), (7, "165", "PC1"), (7, "1", "x")], "view_id int, param_id string, param_value string"),
    }
    keys = spark.createDataFrame([("SCID1",), ("SCID2",)], "serv_comp_id string")
    out = billing_star(t, keys).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.primary_type_1, r.piid_type_5, r.scid_type_6, r.former_prim_type_65) == ("SCID1", "PIID1", "S6", None)
    assert (r.ban, r.invoice_ban, r.bus_org_id) == ("BAN1", "IBAN1", "BO1")
    assert (r.bill_rate, r.bill_rate_scaled) == (12.5, 12.5)
    assert (r.prcmp_desc, r.prcmp_code, r.prcmp_id) == ("Port", "PC1", None)


def test_billing_star_keeps_every_id(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    t = {
        "product": spark.createDataFrame([(1, 0, 10, "T1", 0, None, D(2024, 1, 1), None, 7)],
                                         "parent_subscr_no int, parent_subscr_no_resets int, parent_account_no int, tracking_id string, tracking_id_serv int, "
                                         "billing_inactive_dt timestamp, product_active_dt timestamp, product_inactive_dt timestamp, view_id int"),
        "id_map": spark.createDataFrame([(1, 0, "A-CIRCUIT", 1, None), (1, 0, "Z-CIRCUIT", 1, None), (1, 0, "S1", 6, None), (1, 0, "S2", 6, None)],
                                        "subscr_no int, subscr_no_resets int, external_id string, external_id_type int, inactive_date timestamp"),
        "account": spark.createDataFrame([(10, 1, 5, "USD")], "account_no int, account_type int, bill_company int, currency_code string"),
        "acct_map": spark.createDataFrame([(10, "BAN1", 1, 1), (10, "BAN2", 1, 1), (10, "IBAN1", 150, 1)],
                                          "account_no int, external_id string, external_id_type int, is_current int"),
        "rate_override": none("tracking_id string, tracking_id_serv int, override_rate long, inactive_dt timestamp"),
        "currency": none("currency_code string, implied_decimal int"),
        "product_attr": none("view_id int, param_id string, param_value string"),
    }
    out = billing_star(t, spark.createDataFrame([("A-CIRCUIT",)], "serv_comp_id string")).collect()
    assert sorted((r.primary_type_1, r.scid_type_6, r.ban) for r in out) == [
        (p, s, b) for p in ("A-CIRCUIT", "Z-CIRCUIT") for s in ("S1", "S2") for b in ("BAN1", "BAN2")]


def test_ses_star_role_playing(spark):
    lookup_dim = spark.createDataFrame([(1, "Open"), (2, "Disconnect"), (3, "Change")], "id int, value string")
    order = spark.createDataFrame([("O1", D(2025, 1, 1), D(2025, 1, 2), 1, 3), ("O2", D(2025, 2, 1), None, 1, 3)],
                                  "order_id string, created_date timestamp, last_updated_date timestamp, status_id int, type_id int")
    osvc = spark.createDataFrame([("S1", "O1", 2), ("S1", "O2", 3), ("S9", "O2", 2)], "service_id string, order_id string, action_id int")
    keys = spark.createDataFrame([("S1",)], "serv_comp_id string")
    out = sorted((r.order_id, r.order_status, r.order_type, r.service_action) for r in ses_star(order, osvc, lookup_dim, keys).collect())
    assert out == [("O1", "Open", "Change", "Disconnect"), ("O2", "Open", "Change", "Change")]


def test_invoice_amounts(spark):
    inv = spark.createDataFrame([(1, "B1", D(2025, 5, 3), 1), (1, "B2", D(2025, 4, 30), 1), (2, "B3", D(2025, 5, 9), 0)],
                                "account_no int, bill_ref_no string, statement_date timestamp, prep_status int")
    det = spark.createDataFrame([("B1", 1050, 7, 0, 1), ("B1", 250, 7, 0, 1), ("B1", 500, 1111, 0, 1), ("B1", 300, 7, 0, 5), ("B2", 100, 7, 0, 1),
                                 ("B3", 100, 7, 0, 1)],
                                "bill_ref_no string, amount int, package_id int, subtype_code int, type_code int")
    out = {r.package_id: float(r.amount) for r in invoice_amounts(inv, det, dt.date(2025, 6, 17)).collect()}
    assert out == {"7": 13.0}  # previous month only, prepared, package 1111 and type 5 excluded, cents -> units


def test_invoice_amounts_by_package_attribute(spark):
    inv = spark.createDataFrame([(1, "B1", D(2025, 5, 3), 1), (2, "B2", D(2025, 5, 3), 1)],
                                "account_no int, bill_ref_no string, statement_date timestamp, prep_status int")
    det = spark.createDataFrame([("B1", 1000, 7, 0, 1, 11, 0), ("B1", 500, 7, 0, 1, 12, 0), ("B2", 300, 7, 0, 1, 11, 0)],
                                "bill_ref_no string, amount int, package_id int, subtype_code int, type_code int, subscr_no int, subscr_no_resets int")
    am = spark.createDataFrame([(1, "IB1", 150, 1), (2, "IB2", 150, 1)], "account_no int, external_id string, external_id_type int, is_current int")
    svc = spark.createDataFrame([(11, 0, 100), (12, 0, 200)], "subscr_no int, subscr_no_resets int, view_id int")
    attr = spark.createDataFrame([(100, "742", "PKA"), (200, "1", "x")], "view_id int, param_id string, param_value string")
    bans = spark.createDataFrame([("IB1",)], "inv_ban string")
    out = {r.package_id: float(r.amount) for r in invoice_amounts(inv, det, dt.date(2025, 6, 1), am, svc, attr, bans).collect()}
    assert out == {"PKA": 10.0}  # line without a package attribute dropped; other BAN excluded


def test_package_status_source(spark):
    from reckon.plans.stars import package_status_source

    ap = spark.createDataFrame([("PK", "12345678", 20.0, "Pack"), ("PK", "99999999", 1.0, "Other")],
                               "component_group_cd string, component_grp_val string, monthly_rev_est double, pkg_dsc string")
    hdr = spark.createDataFrame([("M1", "PK-12345678", "In Progress", 18.0, 20.0), ("M2", "PK-12345678", "In Progress", 1.0, 2.0)],
                                "piid_meid string, product_inst_id string, workflowstatus string, piid_current_rate double, piid_new_rate double")
    rows = spark.createDataFrame([("M1", "12345678")], "rr_piid_meid string, pkg_cgv string")
    out = package_status_source(ap, hdr, rows).collect()
    assert [(r.scid, r.piid_meid, r.diff, r.pkg_dsc) for r in out] == [("PK12345678", "M1", 2.0, "Pack")]
