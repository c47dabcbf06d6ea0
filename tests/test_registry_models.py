import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.operators import calibrate, model
from cutpoint.sources import policy_doc as pdoc

GOOD = {
    "schema_version": 1, "generated_at": "2026-03-01",
    "guardrails": {"max_review_rate": 0.1, "min_flagged_fraud_capture": 0.85, "max_decline_fpr": 0.02},
    "profiles": {"primary": {"approve_threshold": 0.11, "decline_threshold": 0.45},
                 "fallback": {"approve_threshold": 0.19, "decline_threshold": 0.8},
                 "phase2_guarded": {"approve_threshold": 0.2, "decline_threshold": 0.8, "meets_guardrails": True}},
}


def variant(**changes):
    d = json.loads(json.dumps(GOOD))
    for k, v in changes.items():
        if k == "drop_profile":
            d["profiles"].pop(v)
        elif k == "guardrail":
            d["guardrails"].update(v)
        elif k == "profile":
            d["profiles"]["primary"].update(v)
        else:
            d[k] = v
    return json.dumps(d)


def test_registry_validation(spark):
    docs = [("good", json.dumps(GOOD)), ("v2", variant(schema_version=2)), ("vstr", variant(schema_version="1")),
            ("nofb", variant(drop_profile="fallback")), ("g15", variant(guardrail={"max_review_rate": 1.5})),
            ("gstr", variant(guardrail={"max_decline_fpr": "x"})), ("order", variant(profile={"approve_threshold": 0.7})),
            ("flag", variant(profile={"meets_guardrails": "yes"})), ("arr", "[1, 2]"), ("junk", "{not json")]
    texts = spark.createDataFrame(docs, "doc_id string, json string")
    v = {}
    for r in pdoc.validate_documents(texts).collect():
        v.setdefault(r["doc_id"], set()).add(r["rule"])
    assert "good" not in v
    assert v["v2"] == {"schema_version_unsupported"}
    assert v["vstr"] == {"schema_version_type"}
    assert v["nofb"] == {"missing_profile"}
    assert v["g15"] == {"guardrail_range"}
    assert v["gstr"] == {"guardrail_type"}
    assert v["order"] == {"invalid_thresholds"}
    assert v["flag"] == {"meets_guardrails_type"}
    assert v["arr"] == {"root_not_object"} and v["junk"] == {"root_not_object"}
    st = {r["doc_id"]: r["valid"] for r in pdoc.registry_status(texts).collect()}
    assert st["good"] and not st["v2"]


def parsed(spark, docs):
    return pdoc.parse_documents(spark.createDataFrame(docs, "doc_id string, json string"))


def test_drift_check(spark):
    cur = parsed(spark, [("a", json.dumps(GOOD))])
    assert pdoc.compare_documents(cur, parsed(spark, [("a", json.dumps(GOOD))])).count() == 0
    fresh = json.loads(json.dumps(GOOD))
    fresh["profiles"]["phase2_guarded"]["approve_threshold"] = 0.21
    fresh["guardrails"]["max_review_rate"] = 0.12
    d = {(r["scope"], r["key"]): (r["current"], r["fresh"])
         for r in pdoc.compare_documents(cur, parsed(spark, [("a", json.dumps(fresh))])).collect()}
    assert d == {("profile phase2_guarded", "approve_threshold"): (0.2, 0.21),
                 ("guardrail", "max_review_rate"): (0.1, 0.12)}
    # a profile missing on one side compares as 0.0
    nofb = json.loads(json.dumps(GOOD))
    nofb["profiles"].pop("fallback")
    d2 = pdoc.compare_documents(cur, parsed(spark, [("a", json.dumps(nofb))])).collect()
    assert {(r["key"], r["fresh"]) for r in d2} == {("approve_threshold", 0.0), ("decline_threshold", 0.0)}


def test_status_and_profiles(spark):
    docs = parsed(spark, [("a", json.dumps(GOOD))])
    s = pdoc.policy_status(docs).first()
    assert s["available_profiles"] == "fallback,phase2_guarded,primary"
    assert s["approve_threshold"] == 0.2 and s["meets_guardrails"] is True
    p = {r["profile"]: (r["approve_threshold"], r["decline_threshold"]) for r in pdoc.explode_profiles(docs).collect()}
    assert p["primary"] == (0.11, 0.45)


def pava(x, y, w):
    """Brute-force increasing isotonic fit at distinct x (weighted PAVA)."""
    blocks = [[yi * wi, wi, [xi]] for xi, yi, wi in zip(x, y, w)]
    i = 0
    while i < len(blocks) - 1:
        if blocks[i][0] / blocks[i][1] > blocks[i + 1][0] / blocks[i + 1][1]:
            a, b = blocks[i], blocks.pop(i + 1)
            a[0] += b[0]; a[1] += b[1]; a[2] += b[2]
            i = max(i - 1, 0)
        else:
            i += 1
    xs, ys = [], []
    for s, w_, xx in blocks:
        for xi in xx:
            xs.append(xi); ys.append(s / w_)
    return np.array(xs), np.array(ys)


def test_isotonic_matches_pava(spark):
    rng = np.random.default_rng(2)
    s = np.round(rng.random(800), 2)
    y = (rng.random(800) < s ** 2).astype(int)
    cal = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    m = calibrate.fit_isotonic(cal)
    ev_s = np.round(rng.random(50) * 1.2 - 0.1, 3)
    ev = spark.createDataFrame([(i, float(v)) for i, v in enumerate(ev_s)], "id long, score double")
    got = {r["id"]: r["score"] for r in calibrate.apply_isotonic(m, ev).collect()}
    ux = np.unique(s)
    uy = np.array([y[s == v].mean() for v in ux])
    uw = np.array([np.sum(s == v) for v in ux])
    fx, fy = pava(ux, uy, uw)
    exp = np.interp(np.clip(ev_s, fx[0], fx[-1]), fx, fy)
    for i, e in enumerate(exp):
        assert got[i] == pytest.approx(e, abs=1e-9)


def test_platt_and_class_weights(spark):
    rng = np.random.default_rng(4)
    s = rng.random(2000)
    y = (rng.random(2000) < s).astype(int)
    cal = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    out = calibrate.apply_platt(calibrate.fit_platt(cal), cal).select("score").collect()
    assert all(0 < r[0] < 1 for r in out)
    w = {r["label"]: r["__w"] for r in model.class_weights(cal).collect()}
    n1 = int(y.sum())
    assert w[1] == pytest.approx(2000 / (2 * n1)) and w[0] == pytest.approx(2000 / (2 * (2000 - n1)))
    with pytest.raises(ValueError):
        calibrate.require_both_classes(cal.filter("label = 1"))


def test_logistic_fit_is_optimal_and_bundle_roundtrips(spark, tmp_path):
    rng = np.random.default_rng(8)
    x1, x2 = rng.normal(size=3000), rng.normal(size=3000) * 50
    y = (rng.random(3000) < 1 / (1 + np.exp(-(0.5 * x1 + 0.01 * x2 - 2)))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x1, x2, y)], "a double, b double, label int")
    for scaled in (False, True):
        m = model.fit_logistic(df, ["a", "b"], c_value=1.0, scaled=scaled)
        g = model.gradient_check(m, df).first()
        assert g["max_abs_gradient"] < 1e-4 and g["max_abs_scaled_gradient"] < 1e-4
    model.save_bundle(m, ["a", "b"], 0.02, 0.4, str(tmp_path / "b"))
    b = model.load_bundle(spark, str(tmp_path / "b"))
    assert b.feature_columns == ["a", "b"] and b.decline_threshold == 0.4
    s1 = model.score(m, df, "s").select("s").collect()
    s2 = model.score(b.model, df, "s").select("s").collect()
    assert s1 == s2


def test_isotonic_query_matches_pava_on_small_tables(spark, sf001):
    from cutpoint.plans import models as M
    _, cal, _ = M._parts(spark, sf001)
    c = [(r["score"], r["label"]) for r in cal.select("score", "label").collect()]
    s = np.array([x for x, _ in c]); y = np.array([v for _, v in c])
    ux = np.unique(s)
    uy = np.array([y[s == v].mean() for v in ux])
    uw = np.array([np.sum(s == v) for v in ux])
    fx, fy = pava(ux, uy, uw)
    out = M.q_isotonic_calibration(spark, sf001).select("raw_score", "calibrated_score").collect()
    exp = np.interp(np.clip([r[0] for r in out], fx[0], fx[-1]), fx, fy)
    assert np.allclose([r[1] for r in out], exp, atol=1e-9)


def test_scaler_uses_population_std(spark):
    x = np.array([1.0, 2.0, 4.0, 8.0])
    df = spark.createDataFrame([(float(v), 7.0) for v in x], "a double, c double")
    sc = model.population_scaler(df, ["a", "c"])
    assert sc["a"] == (pytest.approx(x.mean()), pytest.approx(x.std(ddof=0)))
    assert sc["c"] == (7.0, 1.0)                       # zero variance -> scale 1
