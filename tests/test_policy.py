import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.functions import guardrails
from cutpoint.functions.pairs import (default_pairs, neighbourhood_pairs, parse_pair_specs,
                                      parse_tag_specs, threshold_grid)
from cutpoint.operators import policy, ranking


def ys(spark, y, s, parts=1):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double").repartition(parts)


def test_evaluate_policy_fixture(spark):
    df = ys(spark, [0, 0, 1, 1, 0], [0.01, 0.20, 0.30, 0.90, 0.60])
    r = policy.evaluate_policy(df, 0.10, 0.50).first()
    assert (r["approve_rate"], r["review_rate"], r["decline_rate"]) == (0.2, 0.4, 0.4)
    assert r["fraud_capture_decline"] == 0.5 and r["fraud_capture_flagged"] == 1.0
    assert abs(r["decline_fpr"] - 1 / 3) < 1e-12


def test_policy_cost_fixture(spark):
    df = ys(spark, [0, 0, 1, 1], [0.01, 0.30, 0.20, 0.90])
    r = policy.evaluate_policy_cost(df, 0.10, 0.50, 10.0, 3.0, 0.5).first()
    assert r["total_cost"] == 1.0
    assert (r["approve_rate"], r["review_rate"], r["decline_rate"]) == (0.25, 0.5, 0.25)


def test_published_cost_arithmetic(spark):
    # 3 missed fraud, 95 false declines, 1,470 reviews at costs 25 / 5 / 0.4
    n = 28481
    y = [1] * 3 + [0] * 95 + [0] * 1470 + [0] * (n - 3 - 95 - 1470)
    s = [0.05] * 3 + [0.9] * 95 + [0.5] * 1470 + [0.01] * (n - 1568)
    r = policy.evaluate_policy_cost(ys(spark, y, s, 4), 0.20, 0.80, 25.0, 5.0, 0.4).first()
    assert r["total_cost"] == pytest.approx(1138.0)
    assert r["cost_per_row"] == pytest.approx(1138.0 / n)


def brute(y, s, t1, t2):
    y, s = np.asarray(y), np.asarray(s)
    a, d = s < t1, s >= t2
    rv = ~a & ~d
    return dict(approve_count=a.sum(), review_count=rv.sum(), decline_count=d.sum(),
                fraud_approve=(a & (y == 1)).sum(), fraud_review=(rv & (y == 1)).sum(),
                fraud_decline=(d & (y == 1)).sum(), nonfraud_decline=(d & (y == 0)).sum())


@pytest.mark.parametrize("parts", [1, 7])
def test_sweep_equals_brute_force(spark, parts):
    rng = np.random.default_rng(7)
    n = 3000
    s = np.round(rng.beta(0.6, 4.0, n), 3)           # many ties, values on the grid
    y = (rng.random(n) < s).astype(int)
    pairs = threshold_grid(spark, 0.02, 0.20, 0.20, 0.80, 0.01)
    got = {r["pair_no"]: r for r in policy.sweep_counts(ys(spark, y, s, parts), pairs).collect()}
    plist = {r["pair_no"]: (r["t1"], r["t2"]) for r in pairs.collect()}
    assert len(got) == len(plist) == 1158
    for k, (t1, t2) in list(plist.items())[::37]:
        b = brute(y, s, t1, t2)
        for c, v in b.items():
            assert got[k][c] == v, (k, c)


def test_sweep_by_group(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), int(rng.random() < 0.2), float(np.round(rng.random(), 2))) for g in rng.integers(0, 3, 600)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    pairs = spark.createDataFrame([(1, 0.1, 0.5), (2, 0.3, 0.9)], "pair_no int, t1 double, t2 double")
    got = policy.sweep_counts(df, pairs, by=["g"]).collect()
    assert len(got) == 6
    for r in got:
        sub = [(y, s) for g, y, s in rows if g == r["g"]]
        b = brute([a for a, _ in sub], [c for _, c in sub], r["approve_threshold"], r["decline_threshold"])
        assert all(r[c] == v for c, v in b.items())


def test_grid_and_errors(spark):
    g = [(r["t1"], r["t2"]) for r in threshold_grid(spark, 0.1, 0.2, 0.2, 0.3, 0.1).orderBy("pair_no").collect()]
    assert g == [(0.1, 0.2), (0.1, 0.3), (0.2, 0.3)]
    with pytest.raises(ValueError):
        threshold_grid(spark, 0.1, 0.2, 0.2, 0.3, 0.0)
    assert threshold_grid(spark, 0.02, 0.20, 0.20, 0.80, 0.01).count() == 1158


def ranked_sim(spark, rows):
    df = spark.createDataFrame(rows, "policy_id string, review_rate double, fraud_capture_flagged double, "
                                     "decline_fpr double, rank int")
    return df


def test_feasible_choice(spark):
    r = ranked_sim(spark, [("p1", 0.20, 1.00, 0.03, 1), ("p2", 0.08, 0.96, 0.01, 2)])
    out = ranking.recommend_simulation(r, 0.10, 0.95, 0.02).first()
    assert out["policy_id"] == "p2" and out["meets_guardrails"]


def test_infeasible_choice_lowest_violation(spark):
    r = ranked_sim(spark, [("p1", 0.30, 1.00, 0.03, 1), ("p2", 0.11, 0.96, 0.015, 2),
                           ("p3", 0.095, 0.92, 0.012, 3)])
    out = ranking.recommend_simulation(r, 0.08, 0.95, 0.01).first()
    assert out["policy_id"] == "p2" and not out["meets_guardrails"]


def test_fallback_policy(spark):
    r = ranked_sim(spark, [("p1", 0.18, 0.99, 0.02, 1), ("p2", 0.08, 0.95, 0.015, 2), ("p3", 0.10, 0.96, 0.010, 3)])
    rec = r.filter(F.col("policy_id") == "p1")
    assert ranking.fallback_policy(r, rec).first()["policy_id"] == "p2"
    assert ranking.fallback_policy(r.filter("policy_id = 'p1'"), rec).count() == 0


def test_guardrail_flags_and_gate(spark):
    df = spark.createDataFrame([(0.04, 0.92, 0.01, 100.0), (0.12, 0.80, 0.03, 90.0)],
                               "review_rate double, flagged_fraud_capture double, decline_fpr double, total_cost double")
    a = guardrails.annotate(df, "flagged_fraud_capture", 0.1, 0.9, 0.02, capture_first=True).collect()
    assert [r["meets_guardrails"] for r in a] == [True, False]
    assert a[1]["violation_score"] == pytest.approx(0.1 * 2 + 0.02 * 1 + 0.01 * 1.5)
    with pytest.raises(ValueError):
        guardrails.check_guardrails(1.5, 0.9, 0.02)
    gate = ranking.promotion_gate(spark.createDataFrame([(False,)], "meets_guardrails boolean"))
    with pytest.raises(ranking.PromotionError):
        ranking.enforce_promotion_gate(gate, True)
    ranking.enforce_promotion_gate(gate, False)


def test_cost_choice_feasible_beats_cheap(spark):
    cols = ("pair_no int, approve_threshold double, decline_threshold double, review_rate double, "
            "flagged_fraud_capture double, decline_fpr double, total_cost double, cost_per_row double, rank int")
    df = spark.createDataFrame([(1, 0.10, 0.5, 0.20, 0.95, 0.01, 50.0, 0.05, 1),
                                (2, 0.12, 0.6, 0.05, 0.90, 0.01, 80.0, 0.08, 2)], cols)
    r = ranking.recommend_cost(df, 0.10, 0.85, 0.02).first()
    assert r["approve_threshold"] == 0.12 and r["meets_guardrails"]
    r = ranking.recommend_cost(df.filter("pair_no = 1"), 0.10, 0.85, 0.02).first()
    assert r["approve_threshold"] == 0.10 and not r["meets_guardrails"]


def test_parse_pairs(spark):
    df = spark.createDataFrame([("a", "0.05:0.45, 0.08:0.50"), ("b", "0.05-0.45"), ("c", "0.50:0.20"), ("d", " , ")],
                               "k string, spec string")
    out = {(r["k"], r["pair_no"]): r for r in parse_pair_specs(df, "spec", ["k"]).collect()}
    assert (out[("a", 1)]["t1"], out[("a", 1)]["t2"], out[("a", 1)]["error"]) == (0.05, 0.45, None)
    assert out[("a", 2)]["t2"] == 0.50
    assert out[("b", 1)]["error"] == "missing ':'"
    assert out[("c", 1)]["error"] == "invalid thresholds"
    assert out[("d", 0)]["error"] == "empty"


def test_parse_tags(spark):
    df = spark.createDataFrame([(1, "a=1, b = x=y ,a=2"), (2, "novalue,=v"), (3, None)], "id int, spec string")
    out = {r["id"]: r for r in parse_tag_specs(df, "spec", ["id"]).collect()}
    assert out[1]["tags"] == {"a": "2", "b": "x=y"} and out[1]["bad_tokens"] == []
    assert out[2]["bad_tokens"] == ["novalue", "=v"]
    assert out[3]["tags"] == {}


@pytest.mark.parametrize("base,expected", [
    (0.50, [(0.03, 0.44), (0.05, 0.46), (0.08, 0.5), (0.1, 0.53), (0.12, 0.56)]),
    (0.10, [(0.03, 0.19), (0.05, 0.21), (0.08, 0.25), (0.1, 0.28), (0.12, 0.31)]),
    (0.99, [(0.03, 0.84), (0.05, 0.86), (0.08, 0.9), (0.1, 0.93), (0.12, 0.96)]),
])
def test_default_pairs(spark, base, expected):
    out = default_pairs(spark.createDataFrame([(base,)], "base double")).orderBy("pair_no").collect()
    assert [(r["t1"], r["t2"]) for r in out] == expected


def test_neighbourhood_has_25_pairs(spark):
    c = spark.createDataFrame([(0.11, 0.45)], "t1 double, t2 double")
    assert neighbourhood_pairs(c).count() == 25


def test_weighted_histogram_sweep_equals_rows(spark):
    rng = np.random.default_rng(12)
    s = np.round(rng.random(2000), 2)
    y = (rng.random(2000) < s / 3).astype(int)
    df = ys(spark, y, s, 3)
    pairs = threshold_grid(spark, 0.02, 0.20, 0.20, 0.80, 0.05)
    h = policy.score_label_histogram(df)
    a = {r["pair_no"]: r.asDict() for r in policy.search_best_policy(df, pairs, 25, 5, 0.4).collect()}
    b = {r["pair_no"]: r.asDict() for r in policy.search_best_policy(h, pairs, 25, 5, 0.4, weight="n").collect()}
    assert a == b


def test_zero_denominators_and_empty_input(spark):
    df = ys(spark, [0, 0, 0], [0.1, 0.5, 0.9])          # no fraud at all
    r = policy.evaluate_policy(df, 0.2, 0.8).first()
    assert r["fraud_capture_flagged"] == 0.0 and r["fraud_capture_decline"] == 0.0
    assert r["review_precision"] == 0.0 and r["decline_fpr"] == pytest.approx(1 / 3)
    with pytest.raises(Exception, match="empty"):
        policy.evaluate_policy(df.filter("score > 5"), 0.2, 0.8).collect()
    with pytest.raises(Exception, match="empty"):
        policy.evaluate_policy_cost(df.filter("score > 5"), 0.2, 0.8, 25, 5, 0.4).collect()
