import datetime as dt

from helpers import rows
from reckon.plans.forecast import forecast_compare
from reckon.plans.validator import validator_update

D = dt.datetime


def test_forecast_compare(spark):
    f_old, f_new = D(2025, 4, 28), D(2025, 5, 28)
    hist = spark.createDataFrame(
        [
            ("I1", "up", D(2025, 1, 3), 100.0, f_new), ("I1", "up", D(2025, 1, 20), 0.0, f_new),   # +20 exactly
            ("I1", "up", D(2025, 2, 3), 100.0, f_new),                                            # +21
            ("I2", "dn", D(2025, 1, 3), 100.0, f_new),                                            # -20 exactly
            ("I2", "dn", D(2025, 2, 3), 100.0, f_new),                                            # -21
            (None, "up", D(2025, 3, 3), 50.0, f_new),                                             # null key part
            ("I3", "z", D(2025, 1, 3), 0.0, f_new),                                               # base 0
            ("I4", "neg", D(2025, 1, 3), -10.0, f_new),                                           # negative base
            ("I5", "gone", D(2025, 1, 3), 10.0, f_new),                                           # missing current side
            ("I1", "up", D(2025, 1, 3), 999.0, f_old),                                            # older snapshot ignored
            ("I1", "up", D(2024, 1, 3), 999.0, f_new),                                            # other year ignored
        ],
        "initiative string, rerate_type string, rerate_month timestamp, increase double, finalized_date timestamp",
    )
    curr = spark.createDataFrame(
        [
            ("I1", "up", D(2025, 1, 9), 120.0), ("I1", "up", D(2025, 2, 9), 121.0), ("I2", "dn", D(2025, 1, 9), 80.0),
            ("I2", "dn", D(2025, 2, 9), 79.0), (None, "up", D(2025, 3, 9), 60.0), ("I3", "z", D(2025, 1, 9), 5.0),
            ("I4", "neg", D(2025, 1, 9), -20.0), ("I6", "new", D(2025, 1, 9), 1.0),
        ],
        "initiative string, rerate_type string, rerate_month timestamp, increase double",
    )
    out = forecast_compare(hist, curr, 2025, "may", "june")
    assert set(out) == {"may", "june", "compare"}
    c = out["compare"]
    assert c.columns == ["initiative", "rerate_type", "rerate_month", "concat", "may_sum_increase", "june_sum_increase",
                         "percent_diff", "over_20_increase", "over_20_decrease"]
    got = {(r.initiative, r.rerate_month): (r.may_sum_increase, r.june_sum_increase, r.percent_diff, r.over_20_increase, r.over_20_decrease)
           for r in c.collect()}
    assert got[("I1", 1)] == (100.0, 120.0, 20.0, 0, 0)
    assert got[("I1", 2)] == (100.0, 121.0, 21.0, 1, 0)
    assert got[("I2", 1)] == (100.0, 80.0, -20.0, 0, 0)
    assert got[("I2", 2)] == (100.0, 79.0, -21.0, 0, 1)
    assert got[(None, 3)] == (50.0, 60.0, 20.0, 0, 0)
    assert got[("I3", 1)] == (0.0, 5.0, None, None, None)
    assert got[("I4", 1)] == (-10.0, -20.0, 100.0, 1, 0)
    assert got[("I5", 1)] == (10.0, None, None, None, None)
    assert ("I6", 1) not in got
    assert [r.concat for r in c.where("initiative is null").collect()] == ["up3"]


def test_validator_update(spark):
    log = spark.createDataFrame(
        [
            ("M1", "P1", "Green", "Core", "In Progress", 6, 2025, None, "Disconnect", "Y", None),
            ("M2", "P2", "green", "Core", "In Progress", 6, 2025, None, "Canceled due to Renewal", "N", None),
            ("M3", "P3", "green", "Core", "Complete", 6, 2025, None, "Disconnect", "N", None),
            ("M4", "P4", "red", "Core", "In Progress", 6, 2025, None, "Disconnect", "N", None),
            ("M5", "P5", "green", "Special Access West", "In Progress", 6, 2025, None, "Disconnect", "N", None),
            ("M6", "P6", "green", "Core", "In Progress", 6, 2025, None, "Overlap found", "N", None),
            # two log rows differing only in a column that is not kept -> two identical output rows
            ("M7", "P7", "green", "Core", "in progress", 6, 2025, D(2025, 6, 1), "Disconnect", "Y", None),
            ("M7", "P7", "green", "Core", "in progress", 6, 2025, D(2025, 6, 1), "Disconnect", "N", None),
        ],
        "piid_meid string, product_inst_id string, redblue string, subprojname string, workflowstatus string, rerate_month int, "
        "fiscalyear int, disconnectdate timestamp, disposition string, disconnected string, dtedisconnected timestamp",
    )
    header = spark.createDataFrame(
        [(m, "In Progress", 6, 31, 2025, None) for m in ["M1", "M2", "M3", "M4", "M5", "M6", "M7"]] + [("M9", "Canceled", 6, 31, 2025, None)],
        "piid_meid string, workflowstatus string, rerate_month_actual int, invoice_day int, fiscalyear int, non_opp_reason string",
    )
    out = validator_update(log, header, 6, 31, 2025)
    assert out.columns == ["piid_meid", "product_inst_id", "disconnectdate", "workflowstatus", "non_opp_reason", "notes1"]
    got = rows(out, "piid_meid", "workflowstatus", "non_opp_reason", "notes1")
    assert got == [
        ("M1", "Canceled", "Disconnect", "Disconnect per validator"),
        ("M2", "Canceled", "Renewal", "Renewal per validator"),
        ("M3", None, None, None),
        ("M7", None, None, None),  # 'in progress' is not 'In Progress' (exact text)
        ("M7", None, None, None),
    ]
