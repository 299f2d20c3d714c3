"""Account, invoice, package and term pulls on small relations."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from helpers import plan_text, rows
from reckon.plans.pulls import account_pull, invoice_pull, invoice_sums, package_pull, term_pull

D = dt.datetime


def _frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


@pytest.fixture(scope="module")
def account(spark):
    f = lambda schema, *data: _frame(spark, schema, *data)
    return {
        "acct_group": f("product_account_id int, occurrence_number int, common_ckt string, component_group_cd string, component_grp_val string, application_code int",
                        (1, 1, "K1", "G1", "10", 1), (2, 1, "K1", "G1", "20", 9), (3, 1, "K1", "G2", "30", None), (4, 1, "K2", "G1", "10", 1), (5, 1, None, "G1", "10", 1)),
        "contract": f("product_account_id int, contract_date timestamp, term_length int, termination_date timestamp", (1, D(2024, 1, 1), 36, None)),
        "service_element": f("component_group_cd string, component_grp_val string, service_element_id string", ("G1", "10", "E1"), ("G1", "10", "E2"), ("G9", "20", "E3")),
        "acct_component": f("product_account_id int, occurrence_number int, prcmp_code string, prcmp_override_dt timestamp, promotion_bgn_date timestamp, promotion_end_date timestamp, "
                            "bill_eff_bgn_date timestamp, bill_eff_end_date timestamp, billed_thru_date timestamp, monthly_rev_est double",
                            (1, 1, "PC", None, None, None, D(2024, 2, 1), None, None, 5.0), (1, 1, "PC", None, None, None, D(2023, 2, 1), D(2024, 1, 1), None, 4.0),
                            (2, 1, "PC", None, None, None, D(2023, 2, 1), D(2024, 1, 1), None, 3.0), (4, 1, "PC", None, None, None, D(2023, 2, 1), None, None, 2.0)),
        "product_acct": f("product_account_id int, customer_acct_id int, product_code string", (1, 7, "P7")),
        "application": f("application_code int, application_cd_dsc string", (1, "App")),
        "component_def": f("prcmp_code string, prcmp_id string, prcmp_dsc string, billable_ind string", ("PC", "ID", "Port", "Y")),
        "component_group": f("component_group_cd string, cmp_group_code_dsc string", ("G1", "Group 1")),
    }


def test_account_pull(spark, account):
    out = account_pull(account, _frame(spark, "k string", ("K1",), ("K1",), (None,)), "k")
    got = rows(out, "product_account_id", "service_element_id", "monthly_rev_est", "prcmp_dsc", "application_cd_dsc", "customer_acct_id", "cg_cmp_group_code_dsc")
    # the closed line of 1 goes; 2 has closed lines alone and goes; 3 has no component and stays
    assert got == [(1, "E1", 5.0, "Port", "App", 7, "Group 1"), (1, "E2", 5.0, "Port", "App", 7, "Group 1"), (3, None, None, None, None, None, None)]
    assert account_pull(account, _frame(spark, "k string"), "k").count() == 0


@pytest.mark.parametrize("gone", ["acct_group", "component_group", "application"])
def test_account_pull_refuses_absent_tables(spark, account, gone):
    with pytest.raises(ValueError, match=f"tables missing: \\['{gone}'\\]"):
        account_pull({k: v for k, v in account.items() if k != gone}, _frame(spark, "k string", ("K1",)), "k")


@pytest.fixture(scope="module")
def invoices(spark):
    f = lambda schema, *data: _frame(spark, schema, *data)
    line = "bill_ref_no string, subscr_no int, subscr_no_resets int, billing_level int, from_date timestamp, to_date timestamp, package_id int, description_code int, rate_currency_code int, amount int, type_code int, annotation string, discount int, discount_id int, subtype_code int"
    mk = lambda ref, sub, pkg, amount, kind=1, sub_type=0: (ref, sub, 0, sub % 2, D(2025, 5, 1), D(2025, 5, 31), pkg, 1, 1, amount, kind, "a", None, None, sub_type)
    return {
        "account": f("account_no int, bill_company string", (1, "C1"), (2, "C2")),
        "invoice": f("account_no int, bill_ref_no string, prep_date timestamp, statement_date timestamp, prep_status int",
                     (1, "B1", D(2025, 5, 2), D(2025, 5, 1), 1), (1, "OLD", D(2025, 4, 2), D(2025, 4, 30, 23), 1), (1, "POST", D(2025, 5, 2), D(2025, 5, 3), 4), (2, "B2", D(2025, 5, 2), D(2025, 5, 3), 1)),
        "invoice_detail": f(line, mk("B1", 11, 7, 1050), mk("B1", 12, 7, 250), mk("B1", 11, 1111, 1), mk("B1", 11, None, 1), mk("B1", 11, 7, 1, kind=5), mk("B1", 11, 7, 1, sub_type=-1),
                            mk("B1", 13, 7, 1), mk("B1", 99, 7, 1), mk("OLD", 11, 7, 1), mk("POST", 11, 7, 900), mk("B2", 11, 7, 1)),
        "acct_map": f("account_no int, external_id string, external_id_type int", (1, "I1", 150), (1, "B1", 1), (2, "I2", 150)),
        "customer_map": f("account_no int, external_id string, external_id_type int, is_current int", (1, "O1", 80, 1), (1, "OLD", 80, 0)),
        "currency": f("currency_code int, language_code int, short_display string", (1, 1, "USD"), (1, 2, "xx")),
        "descriptions": f("description_code int, language_code int, description_text string", (1, 1, "Port"), (1, 2, "xx")),
        "package_values": f("package_id int, language_code int, display_value string", (7, 1, "Pack")),
        "id_map": f("subscr_no int, subscr_no_resets int, external_id string, external_id_type int", (11, 0, "C11", 1), (12, 0, "C12", 1), (12, 0, "D12", 1), (11, 0, "P11", 5)),
        "service": f("subscr_no int, subscr_no_resets int, view_id int", (11, 0, 100), (12, 0, 200), (13, 0, 300)),
        "service_attr": f("view_id int, param_id string, param_value string", (100, "742", "PK1"), (200, "742", "PK2"), (300, "742", None), (300, "1", "x")),
    }


def test_invoice_pull(spark, invoices):
    bans = _frame(spark, "b string", ("I1",), ("I1",), (None,))
    lines = invoice_pull(invoices, bans, "b", dt.date(2025, 5, 1))
    got = rows(lines, "package_id", "amount", "primary_id", "piid", "billing_level", "currency", "description_text", "package", "ban", "bus_org_id", "from_date")
    tail = ("USD", "Port", "Pack", "I1", "O1", "05/01/2025")
    # the circuit with two primary ids occurs twice
    assert got == [("PK1", Decimal("10.50"), "C11", "P11", "SERVICE", *tail), ("PK2", Decimal("2.50"), "C12", None, "ACCOUNT", *tail), ("PK2", Decimal("2.50"), "D12", None, "ACCOUNT", *tail)]
    assert rows(invoice_sums(lines)) == [("PK1", Decimal("10.50")), ("PK2", Decimal("5.00"))]
    assert rows(invoice_pull(invoices, bans, "b", dt.date(2025, 5, 1), prep_status=4), "package_id", "amount") == [("PK1", Decimal("9.00"))]
    with pytest.raises(ValueError, match="tables missing"):
        invoice_pull({k: v for k, v in invoices.items() if k != "descriptions"}, bans, "b", dt.date(2025, 5, 1))


def test_package_pull(spark):
    active = _frame(spark, "component_group_cd string, component_grp_val string, monthly_rev_est double, pkg_dsc string", ("PK", "12345678", 20.0, "Pack"), ("PK", "99999999", 1.0, "Other"))
    header = _frame(spark, "piid_meid string, product_inst_id string, bill_acct_nbr string, inv_ban string, workflowstatus string, piid_current_rate double, piid_new_rate double",
                    ("M1", "PK-12345678", "A", "I", "In Progress", 18.0, 20.0), ("M2", "PK-12345678", "A", "I", "In Progress", 1.0, 2.0), ("M3", None, "A", "I", "In Progress", 1.0, 2.0))
    wanted = _frame(spark, "v string, m string", ("12345678", "M1"), ("12345678", "M3"), (None, None))
    assert rows(package_pull(active, header, wanted, "v", "m"), "scid", "piid_meid", "diff", "inv_ban") == [("PK12345678", "M1", 2.0, "I")]


def test_term_pull_equals_the_plain_joins(spark):
    rng = random.Random(5)
    pick = lambda p, n: rng.choice([None, *(f"{p}{k}" for k in range(n))])
    parts = [("S0", pick("P", 9)) if rng.random() < 0.4 else (pick("S", 12), pick("P", 9)) for _ in range(60)]  # one component with a third of the rows
    circuits = [(pick("P", 7), rng.choice([None, D(2024, 1 + rng.randrange(12), 1)])) for _ in range(30)]
    lines = [("S0", pick("I", 8)) if rng.random() < 0.4 else (pick("S", 14), pick("I", 8)) for _ in range(60)]
    best = {}
    for scid, piid in parts:
        for s, i in lines:
            if s is None or i is None or s != scid:
                continue
            ends = [end for p, end in circuits if p is not None and p == piid] or [None]
            for end in ends:
                key = tuple((x is not None, x or "") if not isinstance(x, dt.datetime) else (True, x.isoformat()) for x in (end, scid, piid))
                if i not in best or key > best[i][0]:
                    best[i] = (key, (scid, piid, end))
    got = term_pull(_frame(spark, "circuit_scid string, circuit_piid string", *parts), _frame(spark, "product_inst_id string, term_end_date timestamp_ntz", *circuits),
                    _frame(spark, "serv_comp_id string, product_inst_id string", *lines))
    assert {r.product_inst_id: (r.circuit_scid, r.circuit_piid, r.term_end_date) for r in got.collect()} == {i: v for i, (_, v) in best.items()}


def test_invoice_lines_are_sieved_by_their_invoices(spark, invoices):
    """The same lines with written key sets; those of other invoices are left out before any shuffle of the lines."""
    bans, seen = _frame(spark, "b string", ("I1",), (None,)), []

    def cut(df):
        seen.append(plan_text(df))
        return df

    got = invoice_pull(invoices, bans, "b", dt.date(2025, 5, 1), cut)
    assert len(seen) == 3 and "bitmap_construct_agg" in seen[-1]
    assert rows(got) == rows(invoice_pull(invoices, bans, "b", dt.date(2025, 5, 1)))
