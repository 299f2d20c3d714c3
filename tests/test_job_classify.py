import datetime as dt
import tempfile

from reckon.plans.classify import Labels, classify_circuits

L = Labels()
RUN = dt.date(2025, 6, 17)  # check date 2025-09-01, previous snapshot 202505

MS_COLS = ("ecckt_aml_id string, ecckt_stripped_name string, sap_account_cd string, rev_product_compnt_id string, rev_mrr double, "
           "solution_id_prime string, gov_ind string, bill_src_sys_cd string, last_rerate_date string, jrnl_yr_mnth_nbr int, "
           "dnt_reason_code string, hold_expiration_date string, dnt_exclusion_level string")
MC_COLS = ("solution_id_prime string, product_concat string, business_unit string, rev_region_concat string, in_term_tdm_rr string, "
           "customer_term_end_dt string, rev_mrr double, occ_region_concat string")


def _case(n, name=None, **kw):
    base = dict(
        ecckt=name or f"C{n:02d}", gl_desc="Direct cost", tier3="Direct Netex", rev_mrr=100.0, compnt=f"CMP{n}", sol=f"S{n}", gov="N",
        src="KEN", product="Ethernet", region="NA", term="2025-01-01", tdm="N", jrnl=202501, last_rr=None, marc=100.0, dnt=None, hold=None,
    )
    base.update(kw)
    return base


CASES = {
    4: _case(4, tier3="Fixed Netex"),
    5: _case(5, rev_mrr=None, gl_desc="X Disco Shelf Y"),
    6: _case(6, rev_mrr=None),
    7: _case(7, rev_mrr=None, compnt="UNMATCHED-7"),
    8: _case(8, sol="S8", compnt="K8a"),
    9: _case(9, gov="xY"),
    10: _case(10, src="ENS1"),
    11: _case(11, compnt="abcVantive"),
    12: _case(12, src="CABS"),
    13: _case(13, product="Enterprise BROADBAND plus"),
    14: _case(14, region="EMEA"),
    15: _case(15, sol="123456789012"),
    16: _case(16, term="2025-09-02"),
    17: _case(17, term="2026-01-01", tdm="Y"),
    18: _case(18, dnt="Contractual", hold="2025-12-31"),
    19: _case(19, sol="S19", last_rr="2025-07-01"),
    20: _case(20, last_rr="2025-03-15", jrnl=202503),
    21: _case(21, name="C21-revshare"),
    22: _case(22, marc=0.0),
    23: _case(23),
    24: _case(24, sol="S8", compnt="K8b"),   # second member of S8 (also found with a date)
    25: _case(25, sol="S25", compnt="K25a"),  # S25: one member missing from billing -> no disconnect
    26: _case(26, sol="S25", compnt="K25b"),
    27: _case(27, term="9999-12-31"),       # out-of-range date reads as missing -> not in term
    28: _case(28, sol="1234567890"),        # X11: ten digits is not "more than 10"
    29: _case(29, last_rr="2025-01-15", jrnl=202412),  # X14: 202501 >= 202412 although month 1 < 12
}


def _tables(spark):
    ms, mc, gl = [], [], []
    for n, c in CASES.items():
        ms.append((f"A{n}", c["ecckt"], f"G{n}", c["compnt"], c["rev_mrr"], c["sol"], c["gov"], c["src"], c["last_rr"], c["jrnl"], c["dnt"], c["hold"], None))
        mc.append((c["sol"], c["product"], "BU", "R", c["tdm"], c["term"], c["marc"], c["region"]))
        gl.append((f"G{n}", c["gl_desc"], c["tier3"]))
    mc = list({r[0]: r for r in mc}.values())
    circuits = [(f"A{n}", c["ecckt"]) for n, c in CASES.items()] + [("A1", "C01"), ("A2", "C02"), ("A3", "C03"), ("A30", "C30"), ("A31", "C31")]
    snap_rows = [("C02", "Y", 1, 202505), ("C02", "N", 1, 202505), ("C03", "Y", 2, 202505), ("C01", "Y", 1, 202504), ("C30", "Y", None, 202505),
                 ("C31", "Y", 1, 202505)]
    snap_dir = tempfile.mkdtemp(prefix="reckon-snap-") + "/t"
    spark.createDataFrame(snap_rows, "stripped_ec_circuit_id string, active_ind string, dw_secure_company_nbr int, snapshot int") \
        .write.partitionBy("snapshot").parquet(snap_dir)
    billing = spark.createDataFrame(
        [("K8a", "2025-03-01"), ("K8a", None), ("K8b", "2025-04-01"), ("K8b", "2025-05-01"), ("K25a", "2025-02-01")],
        "primary_type_1 string, billing_inactive_dt string",
    )
    # K8a has an open row (null) which wins over the stop date -> value null but found; K8b -> 2025-05-01.
    hist = spark.createDataFrame(
        [("S19", "x", "m", "p", dt.datetime(2025, 6, 1), 1.0, "In Progress"), ("S19", "x", "m", "p", dt.datetime(2025, 1, 1), 1.0, "Complete"),
         ("S19", "x", "m", "p", dt.datetime(2025, 7, 1), 1.0, "Canceled"), ("S20", "x", "m", "p", dt.datetime(2025, 6, 1), 1.0, "Canceled")],
        "product_inst_id string, serv_comp_id string, piid_meid string, subprojname string, rerate_date timestamp, increase double, workflowstatus string",
    )
    return dict(
        circuits=spark.createDataFrame(circuits, "ecckt_aml_id string, ecckt_stripped_name string"),
        margin_service=spark.createDataFrame(ms, MS_COLS),
        margin_circuit=spark.createDataFrame(mc, MC_COLS),
        gl_account=spark.createDataFrame(gl, "gl_account_cd string, gl_account_desc string, gl_account_ess_tier3_desc string"),
        expense_snapshot=spark.read.parquet(snap_dir),
        billing=billing,
        rerate_history=hist,
    )


def test_classify_rules(spark):
    out = classify_circuits(run_date=RUN, **_tables(spark))
    assert set(out) == {"Data", "T_STG_NETEX_AIM_Data", "DISCO_DATE_INFO", "DNTL_INFO", "WorkFlowStatus", "final"}
    final = out["final"]
    got = {r.input_ecckt_stripped_name: (r.nonactionable_reason, r.actionable_nonactionable) for r in final.collect()}
    assert final.count() == len(CASES) + 5  # grain of the input list is kept
    NA, ACT = "NonActionable", "Actionable"
    exp = {
        "C01": (L.not_in_aim, NA), "C02": (L.not_active, NA), "C03": (L.other_company, NA), "C30": (L.other_company, NA),
        "C31": (L.no_bill, NA),  # C31: in the snapshot, active, own company -> falls to the blank-revenue rule
        "C04": (L.not_direct, NA),
        "C05": (L.disco_shelf, NA), "C06": (L.no_bill, NA), "C07": (L.not_matched, NA), "C08": (L.revenue_disco, NA),
        "C24": (L.revenue_disco, NA), "C09": (L.fed_govt, NA), "C10": (L.ensemble, NA), "C11": (L.vantive, NA), "C12": (L.cabs, NA),
        "C13": (L.broadband, NA), "C14": (L.non_na, NA), "C15": (L.oe_process, NA), "C16": (L.in_term, NA), "C17": (L.in_term_tdm, ACT),
        "C18": (L.dntl, NA), "C19": (L.rerate_in_progress, NA), "C20": (L.rerated_recently, "Potentially Actionable - Requires Cancel and Reload"),
        "C21-revshare": (L.revshare, NA), "C22": (L.zero_biller, ACT), "C23": (L.proceed, ACT), "C25": (L.proceed, ACT), "C26": (L.proceed, ACT),
        "C27": (L.proceed, ACT), "C28": (L.proceed, ACT), "C29": (L.rerated_recently, "Potentially Actionable - Requires Cancel and Reload"),
    }
    assert got == exp
    disco = {r.primary_type_1: r.billing_inactive_dt for r in out["DISCO_DATE_INFO"].collect()}
    assert disco == {"K8a": None, "K8b": dt.datetime(2025, 5, 1), "K25a": dt.datetime(2025, 2, 1)}
    wf = sorted((r.product_inst_id, r.workflowstatus) for r in out["WorkFlowStatus"].collect())
    assert wf == [("S19", "In Progress")]
    snap = sorted(r.stripped_ec_circuit_id for r in out["T_STG_NETEX_AIM_Data"].collect())
    assert snap == ["C02", "C02", "C03", "C30", "C31"]  # only last month's partition, only missing circuits
    piid = {r.input_ecckt_stripped_name: r.piid_any_actionable for r in final.collect()}
    assert piid["C22"] is True and piid["C04"] is False


def test_classify_with_billing_star_tables(spark):
    t = _tables(spark)
    prods = [(1, None), (1, dt.datetime(2025, 3, 1)), (2, dt.datetime(2025, 4, 1)), (2, dt.datetime(2025, 5, 1)), (3, dt.datetime(2025, 2, 1))]
    star = {
        "product": spark.createDataFrame([(s, 0, 10, f"T{i}", 0, d, dt.datetime(2024, 1, 1), None, 7) for i, (s, d) in enumerate(prods)],
                                         "parent_subscr_no int, parent_subscr_no_resets int, parent_account_no int, tracking_id string, "
                                         "tracking_id_serv int, billing_inactive_dt timestamp, product_active_dt timestamp, "
                                         "product_inactive_dt timestamp, view_id int"),
        "id_map": spark.createDataFrame([(1, 0, "K8a", 1, None), (2, 0, "K8b", 1, None), (3, 0, "K25a", 1, dt.datetime(2025, 2, 1))],
                                        "subscr_no int, subscr_no_resets int, external_id string, external_id_type int, inactive_date timestamp"),
        "account": spark.createDataFrame([(10, 1, 5, "USD")], "account_no int, account_type int, bill_company int, currency_code string"),
        "acct_map": spark.createDataFrame([(10, "BAN1", 1, 1), (10, "IBAN1", 150, 1)],
                                          "account_no int, external_id string, external_id_type int, is_current int"),
        "rate_override": spark.createDataFrame([], "tracking_id string, tracking_id_serv int, override_rate long, inactive_dt timestamp"),
        "currency": spark.createDataFrame([("USD", 2)], "currency_code string, implied_decimal int"),
        "product_attr": spark.createDataFrame([], "view_id int, param_id string, param_value string"),
    }
    t["billing"] = star
    out = classify_circuits(run_date=RUN, **t)
    disco = {r.primary_type_1: r.billing_inactive_dt for r in out["DISCO_DATE_INFO"].collect()}
    assert disco == {"K8a": None, "K8b": dt.datetime(2025, 5, 1), "K25a": dt.datetime(2025, 2, 1)}  # inactive ids kept here
    got = {r.input_ecckt_stripped_name: r.nonactionable_reason for r in out["final"].collect()}
    assert got["C08"] == L.revenue_disco and got["C24"] == L.revenue_disco and got["C25"] == L.proceed


def test_every_label_is_observed(spark):
    """All 23 labels occur in the cases; their counts come with the job that reads the result."""
    from collections import Counter

    import pytest

    from reckon.operators.rules import observe_labels

    labels = list(vars(L).values())
    out, seen = observe_labels(classify_circuits(run_date=RUN, **_tables(spark))["final"], "nonactionable_reason", labels)
    want = Counter(r.nonactionable_reason for r in out.collect())
    got = dict(seen.get)
    assert len(labels) == 23 and {x: got[x] for x in labels} == dict(want) and min(want.values()) > 0
    assert (got["rows"], got["unlabelled"], got["other"]) == (sum(want.values()), 0, 0)
    few, seen = observe_labels(spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "label string"), "label", ["a", "b"])
    few.collect()
    assert seen.get == {"rows": 4, "unlabelled": 1, "other": 1, "a": 2, "b": 0}
    with pytest.raises(ValueError):
        observe_labels(few, "label", ["a", "rows"])
