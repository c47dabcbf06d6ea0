import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.operators import errors, monitor, split


def timed(spark, n=2000, days=40, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    d0 = dt.datetime(2024, 1, 1)
    rows = [(i, d0 + dt.timedelta(days=int(rng.integers(0, days))), int(rng.integers(0, 10**6)),
             float(np.round(rng.random(), 3)), int(rng.random() < 0.1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, ts timestamp, tie long, score double, label int").repartition(parts)


def expected_labels(rows, cuts, labels):
    order = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    out = {}
    for pos, r in enumerate(order):
        out[r[0]] = labels[sum(pos >= c for c in cuts)]
    return out


@pytest.mark.parametrize("test_size", [0.2, 0.37])
def test_temporal_split_positions_with_time_ties(spark, test_size):
    rows, df = timed(spark)
    got = {r["id"]: r["split"] for r in split.temporal_split(df, "ts", ["tie", "id"], test_size, buckets=5).collect()}
    cut = int(len(rows) * (1 - test_size))
    assert got == expected_labels(rows, [cut], ["train", "test"])


def test_three_way_split(spark):
    rows, df = timed(spark, seed=3)
    got = {r["id"]: r["split"] for r in split.temporal_three_way(df, "ts", ["tie", "id"], 0.2, 0.5).collect()}
    c1 = int(len(rows) * 0.8)
    c2 = c1 + int((len(rows) - c1) * 0.5)
    assert got == expected_labels(rows, [c1, c2], ["train", "calibration", "evaluation"])
    with pytest.raises(ValueError):
        split.temporal_three_way(df, "ts", ["tie", "id"], 0.2, 0.95)


def test_split_same_for_any_partitioning(spark):
    rows, df = timed(spark, seed=4, parts=1)
    a = {r["id"]: r["split"] for r in split.temporal_split(df, "ts", ["tie", "id"]).collect()}
    b = {r["id"]: r["split"] for r in split.temporal_split(df.repartition(64), "ts", ["tie", "id"]).collect()}
    assert a == b


def test_stratified_split_counts(spark):
    rows, df = timed(spark, seed=5)
    s = split.stratified_split(df, "label", "tie", ["id"], 0.2)
    got = {(r["label"], r["split"]): r["count"] for r in s.groupBy("label", "split").count().collect()}
    for lab in (0, 1):
        n = sum(1 for r in rows if r[4] == lab)
        assert got[(lab, "test")] == int(np.ceil(n * 0.2))


def np_psi(ref, cur, bins=10):
    edges = np.quantile(ref, np.linspace(0, 1, bins + 1))
    edges[0], edges[-1] = -np.inf, np.inf
    r, _ = np.histogram(ref, edges)
    c, _ = np.histogram(cur, edges)
    rp = np.clip(r / max(r.sum(), 1), 1e-8, 1)
    cp = np.clip(c / max(c.sum(), 1), 1e-8, 1)
    return float(np.sum((cp - rp) * np.log(cp / rp)))


def one_col(spark, xs):
    return spark.createDataFrame([(float(x),) for x in xs], "score double")


def test_psi_same_and_shifted(spark):
    same = monitor.psi(one_col(spark, [0.1, 0.2, 0.3, 0.4, 0.5]), one_col(spark, [0.1, 0.2, 0.3, 0.4, 0.5]), bins=5).first()
    assert same["psi"] < 1e-6 and same["drift_level"] == "low"
    sh = monitor.psi(one_col(spark, [0.05, 0.10, 0.15, 0.20, 0.25]), one_col(spark, [0.5, 0.6, 0.7, 0.8, 0.9]), bins=5).first()
    assert sh["psi"] > 0.5 and sh["drift_level"] == "high"


@pytest.mark.parametrize("seed", range(4))
def test_psi_tied_edges_match_histogram(spark, seed):
    rng = np.random.default_rng(seed)
    ref = rng.choice([0.1, 0.2, 0.2, 0.2, 0.5, 0.9], 300)
    cur = rng.choice([0.1, 0.2, 0.3, 0.5, 0.9], 200)
    got = monitor.psi(one_col(spark, ref), one_col(spark, cur)).first()["psi"]
    assert got == pytest.approx(np_psi(ref, cur), rel=1e-12, abs=1e-12)


def test_ks(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.random(500), 2), np.round(rng.random(400) ** 2, 2)
    grid = np.union1d(a, b)
    exp = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a)
                        - np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert monitor.ks_drift(one_col(spark, a), one_col(spark, b)).first()["ks_stat"] == pytest.approx(exp)


def test_review_alert_needs_consecutive_days(spark):
    daily = spark.createDataFrame(
        [("2024-01-01", 0.13, 0.95, 0.01), ("2024-01-02", 0.14, 0.95, 0.01), ("2024-01-04", 0.20, 0.90, 0.03),
         ("2024-01-05", 0.05, 0.95, 0.01)], "day string, review_rate double, flagged_capture double, decline_fpr double")
    got = {r["day"]: r for r in monitor.review_alerts(daily).collect()}
    assert [got[d]["review_alert"] for d in sorted(got)] == [False, True, False, False]
    assert got["2024-01-04"]["capture_alert"] and got["2024-01-04"]["fpr_alert"]


def test_decision_mix_unknown_labels_count_in_total(spark):
    df = spark.createDataFrame([("approve",), ("review",), ("other",), ("decline",)], "decision string")
    r = monitor.decision_mix(df).first()
    assert r["rows"] == 4 and r["approve_rate"] == 0.25 and r["decline_rate"] == 0.25


def test_label_quality_review_precision(spark):
    df = spark.createDataFrame([("review", 1), ("review", 0), ("decline", 1), ("approve", 0)], "decision string, label int")
    r = monitor.label_quality(df).first()
    assert r["review_precision"] == 0.5 and r["decline_precision"] == 1.0 and r["flagged_capture"] == 1.0


def test_confusion_fixture(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9), (1, 0.1), (1, 0.9)], "label int, score double")
    r = errors.confusion(df, 0.5).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (1, 1, 1, 1)


def test_top_errors_fixture(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 0, 0.9), (2, 0.0, 2.0, 0, 0.2), (3, 0.0, 3.0, 1, 0.1), (4, 0.0, 4.0, 1, 0.8)],
                               "id long, Time double, Amount double, label int, score double")
    out = errors.top_errors(df, 0.5, 2, keep=["id", "Time", "Amount"], tiebreak=["id"]).collect()
    assert sorted((r["id"], r["error_type"]) for r in out) == [(1, "false_positive"), (3, "false_negative")]


@pytest.mark.parametrize("n", [1, 37, 500, 5000])
def test_fixed_sample_is_exact_top_n(spark, n):
    rows, df = timed(spark, n=3000, seed=11)
    got = [r["id"] for r in split.fixed_sample(df, n, ["tie", "id"]).collect()]
    exp = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))[:n]]
    assert sorted(got) == sorted(exp)


def test_confusion_from_points_equals_rows(spark):
    from cutpoint.operators import curves
    rng = np.random.default_rng(6)
    rows = [(int(rng.random() < 0.2), float(np.round(rng.random(), 2))) for _ in range(1500)]
    df = spark.createDataFrame(rows, "label int, score double")
    a = errors.confusion(df, 0.37).first().asDict()
    b = errors.confusion_from_points(curves.score_points(df), 0.37).first().asDict()
    assert a == b


def test_psi_by_group_matches_numpy(spark):
    rng = np.random.default_rng(21)
    rows = []
    for g in range(3):
        ref = rng.choice([0.1, 0.2, 0.2, 0.5, 0.9 - g * 0.1], 200)
        cur = rng.choice([0.1, 0.3, 0.5, 0.7], 150)
        rows += [(g, "ref", float(x)) for x in ref] + [(g, "cur", float(x)) for x in cur]
    df = spark.createDataFrame(rows, "g int, pop string, score double")
    h = df.groupBy("g", "pop", "score").count().withColumnRenamed("count", "n")
    got = {r["g"]: r["psi"] for r in monitor.psi_by(h, ["g"]).collect()}
    for g in range(3):
        ref = np.array([x for gg, p, x in rows if gg == g and p == "ref"])
        cur = np.array([x for gg, p, x in rows if gg == g and p == "cur"])
        assert got[g] == pytest.approx(np_psi(ref, cur), rel=1e-12, abs=1e-12)


def test_published_confusion_rates(spark):
    # TN / FP / FN / TP = 55,753 / 1,134 / 8 / 67 at one threshold
    i = F.col("id")
    df = spark.range(56962).select(
        F.when(i < 55753 + 1134, 0).otherwise(1).alias("label"),
        F.when((i < 55753) | ((i >= 55753 + 1134) & (i < 55753 + 1134 + 8)), 0.1).otherwise(0.9).alias("score"))
    r = errors.confusion(df, 0.5).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (55753, 1134, 8, 67)
    assert (round(r["recall"], 6), round(r["precision"], 6), round(r["fpr"], 6)) == (0.893333, 0.055787, 0.019934)
