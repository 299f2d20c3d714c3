import datetime as dt

from reckon.plans.cycle_prep import Statuses, cycle_prep

S = Statuses()
D = dt.datetime

DETAIL = ("rr_piid_meid string, serv_comp_id string, component_id string, component_grp_val_id string, component string, "
          "scp_current_rate double, scp_increase double, scp_new_rate double, qty int, service_element_id string, promo_code string, "
          "prod_cmpnt_cd string, pre_billed_ind string, rollup_to_piid string, dw_source_system_cd string, rerate_date timestamp, meid string, "
          "inv_ban string, prod_acct_id string, batch string, bill_acct_nbr string, reversal_date timestamp, reversal_reason string, "
          "invoice_kenan_acct_nbr string")
HEADER = ("piid_meid string, product_inst_id string, redblue string, subprojname string, workflowstatus string, rerate_month_actual int, "
          "fiscalyear int, invoice_day int, frequency string, bus_org_id string, product string, cust_acct_sales_channel_desc string, "
          "business_unit string, cust_contract_term_end_dt timestamp, non_opp_reason string, piid_current_rate double, piid_new_rate double")


def _row(m, cid, grp, comp="COMP", cur=10.0, new=11.0, piid=None, wf="In Progress", sub="Core", red="green", month=6, freq="MRC",
         inc=1.0, src="SDP", seid="SE", promo=None, pre=None, rev_date=None, bu="RETAIL", cust_term=None):
    detail = (m, cid + grp, cid, grp, comp, cur, inc, new, 1, seid, promo, "PCC", pre, "Y", src, D(2025, 6, 1), "me", "IB1", "PA", "b", "ba",
              rev_date, None, "k")
    header = (m, piid or f"P{m}", red, sub, wf, month, 2025, 31, freq, "BO", "prod", "ch", bu, cust_term, None, None, None)
    return detail, header


def _tables(spark):
    rs = [
        _row("1", "CI", "G1", cur=10.0, piid="P1"),                      # billed rate equal -> no status
        _row("2", "CI", "G2", cur=12.0),                                  # billed 11.5 mismatched -> billing star 12 overwrites
        _row("3", "CI", "G3", cur=5.0, new=7.0, wf="Reversal", rev_date=D(2025, 6, 15)),  # reversal, no rate anywhere -> move back
        _row("4", "X-", "G4", comp="C4", cur=20.0),                       # split id: estimated revenue fills the rate
        _row("5", "CI", "G5", cur=9.0, piid="P1"),                        # no rate, ordered disconnect -> Cancel - Disconnect
        _row("5b", "CI", "G5", comp="COMP2", cur=10.0, piid="P5b"),       # same component id, has a rate: disconnect too
        _row("7b", "CI", "G7", comp="COMP7", cur=10.0, piid="PK-77777777"),  # package row sharing the hidden group value
        _row("6", "pk", "G6", cur=10.0, piid="P6"),                       # package id without package instance
        _row("7", "CI", "G7", cur=10.0, piid="P7"),                       # hidden package
        _row("8", "CI", "G8", cur=10.0, piid="PK-12345"),                 # package status proceed
        _row("9", "CI", "G9", cur=10.0, piid="P9"),                       # in term -> cancel
        _row("10", "CI", "G10", cur=10.0, piid="P10", sub="In Term TDM Cost Increase Pass Thru"),
        _row("11", "CI", "G11", cur=10.0, piid="P11", sub="Offnet TDM Discontinuance", bu="WHOLESALE", cust_term=D(2026, 3, 1)),
        _row("12", "CI", "G12", cur=10.0, piid="P12", promo="xpkg", pre="N"),
        _row("13", "CI", "G13", cur=10.0, piid="P13", seid=None),
        _row("20", "CI", "G20", red="red"),                               # filtered out
        _row("21", "CI", "G21", freq="NRC"),                              # filtered out
        _row("22", "CI", "G22", inc=0.0),                                 # filtered out
        _row("23", "CI", "G23", month=5),                                 # other month
        _row("24", "CI", "G24", wf="canceled"),                           # canceled
    ]
    billed = [("CIG5", "COMP2", 10.0), ("CIG7", "COMP7", 10.0), ("CIG1", "COMP", 10.0), ("CIG2", "COMP", 11.5), ("pkG6", "COMP", 10.0), ("CIG7", "COMP", 10.0), ("CIG8", "COMP", 10.0),
              ("CIG9", "COMP", 10.0), ("CIG10", "COMP", 10.0), ("CIG11", "COMP", 10.0), ("CIG12", "COMP", 10.0), ("CIG13", "COMP", 10.0)]
    active = [("X-", "G4", "P4", "PR", "C4", "PC", 20.0, "CA", "PAID", None, None), ("CI", "G7", "P7", "PR7", "C7", "PC7", 1.0, "CA", "PAID", "PKA", "pk")]
    t = {
        "rate_detail": spark.createDataFrame([r[0] for r in rs], DETAIL),
        "rate_header": spark.createDataFrame([r[1] for r in rs], HEADER),
        "billed_records": spark.createDataFrame(billed, "primary_id string, prcmp_desc string, rate double"),
        "active_products": spark.createDataFrame(active, "component_group_cd string, component_grp_val string, prcmp_id string, prcmp_code string, "
                                                 "prcmp_dsc string, product_code string, monthly_rev_est double, customer_acct_id string, "
                                                 "product_account_id string, pkg_acct_id string, pkg_dsc string"),
        # Source order is inactive date desc with nulls first and the last row wins, so the
        # closed product (inactive 2023) supplies the rate, not the open one.
        "billing_rates": spark.createDataFrame([("CIG2", 99.0, None, D(2024, 1, 1)), ("CIG2", 12.0, D(2023, 1, 1), D(2022, 1, 1))],
                                               "primary_type_1 string, bill_rate double, product_inactive_dt timestamp, product_active_dt timestamp"),
        "account_rates": spark.createDataFrame([("P4", 19.0, D(2020, 1, 1))], "common_ckt string, monthly_rev_est double, bill_eff_bgn_date timestamp"),
        "ses": spark.createDataFrame([("CIG5", "Disconnect"), ("CIG5", "Add"), ("CIG3", "Add")], "service_id string, service_action string"),
        "quantity_guide": spark.createDataFrame([("PCPR", "Always > 1")], "unique_product_prcmp string, quantity_status string"),
        "package_status": spark.createDataFrame([("12345", "PKG8", "In Progress", 0.0, 10.0, 10.0, 11.0, "Pack", "IB1")],
                                                "component_grp_val string, scid string, workflowstatus string, diff double, monthly_rev_est double, "
                                                "piid_current_rate double, piid_new_rate double, pkg_dsc string, inv_ban string"),
        "term_primary": spark.createDataFrame([("CIG9", "x", D(2026, 1, 1)), ("CIG9", "x", D(2025, 1, 1)), ("CIG10", "y", D(2026, 1, 1))],
                                              "circuit_scid string, circuit_piid string, r4_termenddate timestamp"),
        "term_fallback": spark.createDataFrame([("CI", "G11", "P11", D(2026, 2, 1)), ("CI", "G9", "P9", D(2030, 1, 1))],
                                               "component_group_cd string, scid string, piid string, service_end_date timestamp"),
        "service_elements": spark.createDataFrame([("CI", "G13", "COMP", "SE13", "PC13")],
                                                  "component_group_cd string, component_grp_val string, prcmp_dsc string, service_element_id string, prcmp_code string"),
    }
    return t


def test_cycle_prep(spark):
    out = cycle_prep(_tables(spark), 2025, 6, 31)
    assert set(out) >= {"tstage", "latis_active", "kenan_prod", "ses", "r4_ted", "ctd_ted", "seid", "rr_scid"}
    rr = out["rr_scid"]
    all_rows = rr.collect()
    # A reversal of the cycle month passes the rerate filter too (its status
    # is not 'canceled'), so the source pulls it twice: once as a rerate, once
    # swapped as a reversal. Both rows share the unique key.
    assert len(all_rows) == 16
    cig3 = sorted((r.is_reversal, r.scp_current_rate, r.status) for r in all_rows if r.serv_comp_id == "CIG3")
    assert cig3 == [(False, 5.0, S.move_back), (True, 7.0, S.move_back)]
    by_uniq = {r.unique: r for r in all_rows}
    assert (by_uniq["CIG5COMP2"].kenan, by_uniq["CIG5COMP2"].status) == (10.0, S.disconnect)
    assert by_uniq["CIG7COMP7"].status == S.hidden_pkg  # flagged through the group value, though it is a package row
    got = {r.serv_comp_id: r for r in all_rows if not (r.serv_comp_id == "CIG3" and not r.is_reversal)
           and r.unique not in ("CIG5COMP2", "CIG7COMP7")}
    assert set(got) == {"CIG1", "CIG2", "CIG3", "X-G4", "CIG5", "pkG6", "CIG7", "CIG8", "CIG9", "CIG10", "CIG11", "CIG12", "CIG13"}
    assert (got["CIG1"].kenan, got["CIG1"].difference, got["CIG1"].status) == (10.0, 0.0, None)
    assert (got["CIG2"].kenan, got["CIG2"].difference, got["CIG2"].status) == (12.0, 0.0, None)
    r3 = got["CIG3"]
    assert (r3.scp_current_rate, r3.scp_new_rate) == (7.0, 5.0)  # swapped for reversals
    assert r3.reversal_date == D(2025, 6, 30)  # forced to the (clamped) cycle date
    assert r3.status == S.move_back
    r4 = got["X-G4"]
    assert (r4.latis_active, r4.kenan, r4.difference, r4.status, r4.qty) == ("G4", 20.0, 0.0, None, "Always > 1")
    assert got["CIG5"].status == S.disconnect
    assert got["CIG5"].piid_level_status == S.disconnect and got["CIG1"].piid_level_status == S.disconnect
    assert got["pkG6"].status == S.pk_no_piid
    assert got["CIG7"].status == S.hidden_pkg
    assert (got["CIG8"].pkg_cgv, got["CIG8"].pkg_status, got["CIG8"].pkg_description, got["CIG8"].status) == ("12345", S.proceed_rerate, "Pack", S.proceed_rerate)
    assert (got["CIG9"].r4_term_end_date, got["CIG9"].status) == (D(2026, 1, 1), S.in_term)  # primary wins over fallback
    assert got["CIG10"].status is None  # pass-through exemption
    assert (got["CIG11"].r4_term_end_date, got["CIG11"].status) == (D(2026, 2, 1), None)  # fallback date, wholesale exemption
    assert got["CIG12"].pre_billed_ind == "N" and got["CIG1"].pre_billed_ind == "Y"
    assert (got["CIG13"].service_element_id, got["CIG13"].prod_cmpnt_cd) == ("SE13", "PC13")
    assert got["CIG1"].service_element_id is None  # replaced (source behaviour), not filled


def test_package_status_rules(spark):
    from reckon.plans.cycle_prep import package_status

    pkg = spark.createDataFrame(
        [("g1", "PK1", "In Progress", 0.0, 5.0, 5.0, 6.0, "d", "B"),     # no difference -> proceed
         ("g2", "PK2", "Reversal", 3.0, 6.0, 5.0, 6.0, "d", "B"),        # estimate = new rate -> proceed with reversal, diff 0 (X5)
         ("g3", "PK3", "In Progress", 2.0, 7.0, 10.0, 11.0, "d", "B"),   # invoice 10 = current -> proceed
         ("g4", "PK4", "In Progress", 2.0, 7.0, 10.0, 11.0, "d", "B"),   # invoice 9 = neither -> cost change
         ("g5", "PK5", "In Progress", 2.0, 9.0, 10.0, 11.0, "d", "B"),   # invoice 9 = estimate -> unchanged (blank)
         ("g6", "PK3", "Complete", 0.0, 7.0, 10.0, 11.0, "d", "B")],     # any line of an invoiced package is re-evaluated
        "component_grp_val string, scid string, workflowstatus string, diff double, monthly_rev_est double, piid_current_rate double, "
        "piid_new_rate double, pkg_dsc string, inv_ban string")
    inv = spark.createDataFrame([("PK3", 10.0), ("PK4", 9.0), ("PK5", 9.0)], "package_id string, amount double")
    _, out = package_status(pkg, inv, S)
    got = {r.component_grp_val: (r.pkg_status, r.diff) for r in out.collect()}
    assert got == {"g1": (S.proceed_rerate, 0.0), "g2": (S.proceed_reversal, 0.0), "g3": (S.proceed_rerate, 2.0), "g4": (S.mrr, 2.0),
                   "g5": (None, 2.0), "g6": (S.proceed_rerate, 0.0)}


def test_cycle_prep_from_star_tables(spark):
    """Same cycle with the billing and order inputs built from their star
    tables instead of pre-joined frames."""
    t = _tables(spark)
    del t["billing_rates"], t["ses"], t["account_rates"], t["service_elements"]
    t.update({
        "acct_group": spark.createDataFrame([("PA1", 1, "P4", "X-", "G4", "APP"), ("PA2", 1, "P13", "CI", "G13", "APP")],
                                            "product_account_id string, occurrence_number int, common_ckt string, component_group_cd string, "
                                            "component_grp_val string, application_code string"),
        "acct_component": spark.createDataFrame([("PA1", 1, "PR", D(2020, 1, 1), None, 19.0), ("PA2", 1, "PC13", D(2020, 1, 1), None, 5.0),
                                                 ("PA2", 1, "OLD", D(2019, 1, 1), D(2019, 6, 1), 1.0)],
                                                "product_account_id string, occurrence_number int, prcmp_code string, bill_eff_bgn_date timestamp, "
                                                "bill_eff_end_date timestamp, monthly_rev_est double"),
        "component_def": spark.createDataFrame([("PR", "P1", "C4", "Y"), ("PC13", "P2", "COMP", "Y"), ("OLD", "P3", "COMP", "Y")],
                                               "prcmp_code string, prcmp_id string, prcmp_dsc string, billable_ind string"),
        "service_element": spark.createDataFrame([("CI", "G13", "SE13")], "component_group_cd string, component_grp_val string, service_element_id string"),
        "product": spark.createDataFrame([(1, 0, 10, "T1", 0, None, D(2024, 1, 1), None, 7)],
                                         "parent_subscr_no int, parent_subscr_no_resets int, parent_account_no int, tracking_id string, "
                                         "tracking_id_serv int, billing_inactive_dt timestamp, product_active_dt timestamp, "
                                         "product_inactive_dt timestamp, view_id int"),
        "id_map": spark.createDataFrame([(1, 0, "CIG2", 1, None)],
                                        "subscr_no int, subscr_no_resets int, external_id string, external_id_type int, inactive_date timestamp"),
        "account": spark.createDataFrame([(10, 1, 5, "USD")], "account_no int, account_type int, bill_company int, currency_code string"),
        "acct_map": spark.createDataFrame([(10, "BAN1", 1, 1), (10, "IBAN1", 150, 1)],
                                          "account_no int, external_id string, external_id_type int, is_current int"),
        "rate_override": spark.createDataFrame([("T1", 0, 1200, None)], "tracking_id string, tracking_id_serv int, override_rate long, inactive_dt timestamp"),
        "currency": spark.createDataFrame([("USD", 2)], "currency_code string, implied_decimal int"),
        "product_attr": spark.createDataFrame([(7, "166", "COMP")], "view_id int, param_id string, param_value string"),
        "order": spark.createDataFrame([("O1", D(2025, 5, 1), None, 1, 1)],
                                       "order_id string, created_date timestamp, last_updated_date timestamp, status_id int, type_id int"),
        "order_service": spark.createDataFrame([("CIG5", "O1", 2)], "service_id string, order_id string, action_id int"),
        "order_lookup": spark.createDataFrame([(1, "Open"), (2, "Disconnect")], "id int, value string"),
    })
    got = {r.serv_comp_id: r for r in cycle_prep(t, 2025, 6, 31)["rr_scid"].collect() if r.is_reversal or r.serv_comp_id != "CIG3"}
    assert (got["CIG2"].kenan, got["CIG2"].status) == (12.0, None)
    assert got["CIG5"].status == S.disconnect
    assert (got["CIG13"].service_element_id, got["CIG13"].prod_cmpnt_cd) == ("SE13", "PC13")  # from the account star, open component only
    assert (got["X-G4"].kenan, got["X-G4"].status) == (20.0, None)


def test_shared_component_ids_and_several_lines(spark):
    """A component id on two instances and one without, package lines of different
    status, a null service element beside a real one."""
    t = _tables(spark)
    more = [_row("30", "CI", "G30", cur=10.0, piid="A30"), _row("31", "CI", "G30", cur=10.0, piid="Z30", comp="C31"),
            _row("33", "CI", "G33", cur=10.0, piid="A33"), _row("34", "CI", "G33", cur=10.0, piid="Z33", comp="C34"),
            _row("35", "CI", "G35", cur=10.0, piid="P35a"), _row("36", "CI", "G35", cur=10.0, piid="P35b", sub="In Term TDM Cost Increase Pass Thru")]
    no_instance = _row("32", "CI", "G30", cur=10.0, comp="C32")
    no_instance = (no_instance[0], (no_instance[1][0], None, *no_instance[1][2:]))
    more.append(no_instance)
    t["rate_detail"] = t["rate_detail"].unionByName(spark.createDataFrame([r[0] for r in more], DETAIL))
    t["rate_header"] = t["rate_header"].unionByName(spark.createDataFrame([r[1] for r in more], HEADER))
    add = lambda name, new: t.update({name: t[name].unionByName(spark.createDataFrame(new, t[name].schema))})
    add("term_primary", [("CIG30", "x", D(2027, 1, 1)), ("CIG35", "x", D(2027, 3, 1))])
    add("term_fallback", [("CI", "G33", "A33", D(2027, 2, 1))])
    add("package_status", [("12345", "PKG8", "In Progress", 2.0, 7.0, 10.0, 11.0, "Pack", "IB1")])
    add("service_elements", [("CI", "G13", "COMP", None, "PC0")])
    t["invoice_amounts"] = spark.createDataFrame([("PKNONE", 1.0)], "package_id string, amount double")
    got = {r.unique + (r.product_inst_id or ""): r for r in cycle_prep(t, 2025, 6, 31)["rr_scid"].collect()}
    assert got["CIG30COMPA30"].r4_term_end_date == got["CIG30C31Z30"].r4_term_end_date == D(2027, 1, 1)
    assert got["CIG30C32"].r4_term_end_date is None
    assert got["CIG33COMPA33"].r4_term_end_date == got["CIG33C34Z33"].r4_term_end_date == D(2027, 2, 1)
    # one of the rows of a unique key is in term: both are cancelled
    assert got["CIG35COMPP35a"].status == got["CIG35COMPP35b"].status == S.in_term
    assert got["CIG8COMPPK-12345"].pkg_status == S.proceed_rerate
    assert (got["CIG13COMPP13"].service_element_id, got["CIG13COMPP13"].prod_cmpnt_cd) == ("SE13", "PC13")
    t["invoice_amounts"] = spark.createDataFrame([("PKCANCEL", 9.0)], "package_id string, amount double")
    add("package_status", [("12345", "PKCANCEL", "In Progress", 2.0, 7.0, 10.0, 11.0, "Pack", "IB1")])
    got = {r.serv_comp_id: r for r in cycle_prep(t, 2025, 6, 31)["rr_scid"].collect()}
    assert (got["CIG8"].pkg_status, got["CIG8"].status) == (S.mrr, S.mrr)


def test_billed_duplicates_keep_grain_unless_fanout(spark):
    t = _tables(spark)
    t["billed_records"] = t["billed_records"].unionByName(
        spark.createDataFrame([("CIG1", "COMP", 9.0), ("CIG1", "COMP", 10.0)], "primary_id string, prcmp_desc string, rate double"))
    one = [r for r in cycle_prep(t, 2025, 6, 31)["rr_scid"].collect() if r.serv_comp_id == "CIG1"]
    assert [(r.kenan, r.status) for r in one] == [(10.0, None)]
    many = [r for r in cycle_prep(t, 2025, 6, 31, fanout_billed=True)["rr_scid"].collect() if r.serv_comp_id == "CIG1"]
    assert sorted(r.kenan for r in many) == [9.0, 10.0, 10.0]


def test_move_back_is_decided_per_product(spark):
    """A component with a rated and an unrated product takes the rate and moves its reversals back; rates alone do not."""
    t = _tables(spark)
    cols = "primary_type_1 string, bill_rate double, product_inactive_dt timestamp, product_active_dt timestamp"
    status = {}
    for name, rates in (("rated", [6.0]), ("both", [6.0, None]), ("unrated", [None]), ("none", [])):
        t["billing_rates"] = spark.createDataFrame([("CIG3", r, None, D(2024, 1, 1)) for r in rates], cols)
        out = [r for r in cycle_prep(t, 2025, 6, 31)["rr_scid"].collect() if r.serv_comp_id == "CIG3"]
        status[name] = ({r.kenan for r in out}, {r.status == S.move_back for r in out})
    assert status["rated"][0] == status["both"][0] == {6.0} and status["both"][1] == status["unrated"][1] == status["none"][1] == {True}
