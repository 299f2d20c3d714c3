"""Differential property tests: operators vs row-at-a-time Python models on
random small frames (tests only; the library has no Python row logic)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reckon.operators.lookup import lookup
from reckon.operators.rollup import complete_group_max, priority_rollup

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
VALS = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(left=st.lists(st.tuples(KEYS, VALS), min_size=1, max_size=8),
       ref=st.lists(st.tuples(KEYS, VALS), max_size=6),
       mode=st.sampled_from(["replace", "fill", "overwrite"]))
def test_lookup_first_matches_model(spark, left, ref, mode):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(left)], "id int, k string, v int")
    rf = spark.createDataFrame(ref, "rk string, rv int") if ref else spark.createDataFrame([], "rk string, rv int")
    out = {r.id: r.v for r in lookup(df, rf, {"k": "rk"}, {"rv": "v"}, mode=mode, on_multi="first", order=["rv desc nulls last"]).collect()}
    # model: first reference row per key = largest value (nulls last); null keys never match
    best = {}
    for k, v in ref:
        if k is None:
            continue
        if k not in best or (v is not None and (best[k] is None or v > best[k])):
            best[k] = v
    for i, (k, v) in enumerate(left):
        found = k is not None and k in best
        r = best.get(k) if found else None
        exp = r if mode == "replace" else (v if v is not None else r) if mode == "fill" else (r if r is not None else v)
        assert out[i] == exp, (mode, k, v, r)


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, st.one_of(st.none(), st.sampled_from(["R", "A", "N", "X"]))), min_size=1, max_size=12))
def test_priority_rollup_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "g string, f string")
    got = {r.g: r.p for r in priority_rollup(df, "g", "f", ["R", "A", "N"], "dflt", "p").collect()}
    exp = {}
    for g, f in rows:
        if g is None:
            continue
        exp.setdefault(g, [])
        exp[g].append(f)
    exp = {g: next((x for x in ["R", "A", "N"] if x in fs), "dflt") for g, fs in exp.items()}
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(KEYS, VALS, st.booleans()), min_size=1, max_size=12), require_all=st.booleans())
def test_complete_group_max_matches_model(spark, rows, require_all):
    df = spark.createDataFrame(rows, "g string, v int, found boolean")
    got = {r.g: r.m for r in complete_group_max(df, "g", "v", F.col("found"), "m", require_all=require_all).collect()}
    groups = {}
    for g, v, f in rows:
        if g is not None:
            groups.setdefault(g, []).append((v, f))
    exp = {}
    for g, members in groups.items():
        vals = [v for v, _ in members if v is not None]
        ok = all(f for _, f in members) and len(vals) > 0 and (not require_all or len(vals) == len(members))
        exp[g] = max(vals) if ok else None
    assert got == exp
