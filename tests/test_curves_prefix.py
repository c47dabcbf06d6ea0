import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.operators import curves
from cutpoint.operators.prefix import exact_quantiles, global_position, running_total


def clf_curve(y, s):
    """Cumulative (fps, tps, thresholds) at distinct scores, descending."""
    order = np.argsort(-s, kind="mergesort")
    s, y = s[order], y[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    return fps, tps, s[idx]


def roc(y, s, drop=True):
    fps, tps, th = clf_curve(y, s)
    if drop and len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, th = fps[keep], tps[keep], th[keep]
    fps, tps, th = np.r_[0, fps], np.r_[0, tps], np.r_[np.inf, th]
    return fps / fps[-1], tps / tps[-1], th


def recall_at(y, s, target, drop=True):
    fpr, tpr, th = roc(y, s, drop)
    valid = np.where(fpr <= target)[0]
    if len(valid) == 0:
        return 0.0, 1.0
    return float(tpr[valid[-1]]), float(th[valid[-1]])


def ap(y, s):
    fps, tps, _ = clf_curve(y, s)
    prec = tps / (tps + fps)
    rec = tps / tps[-1]
    return float(np.sum(np.diff(np.r_[0, rec]) * prec))


def auc(y, s):
    fpr, tpr, _ = roc(y, s)
    return float(np.trapezoid(tpr, fpr))


def data(seed, n, decimals):
    rng = np.random.default_rng(seed)
    s = np.round(rng.beta(0.7, 3.0, n), decimals)
    y = (rng.random(n) < 0.3 * s + 0.01).astype(int)
    return y, s


@pytest.mark.parametrize("seed,decimals,parts", [(1, 2, 1), (2, 3, 5), (3, 6, 3)])
def test_curves_match_definition(spark, seed, decimals, parts):
    y, s = data(seed, 4000, decimals)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double").repartition(parts)
    pts = curves.score_points(df, buckets=16)
    m = curves.auc_metrics(pts).first()
    assert m["pr_auc"] == pytest.approx(ap(y, s), abs=1e-12)
    assert m["roc_auc"] == pytest.approx(auc(y, s), abs=1e-12)
    for target in (0.0, 0.02, 0.1, 0.5):
        for prune in (True, False):
            r = curves.recall_at_fpr(pts, target, prune=prune).first()
            er, et = recall_at(y, s, target, prune)
            assert (r["recall"], r["threshold"]) == pytest.approx((er, et)), (target, prune)


def test_auc_is_mann_whitney(spark):
    y, s = data(9, 2000, 2)
    pos, neg = s[y == 1], s[y == 0]
    mw = (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (len(pos) * len(neg))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert curves.auc_metrics(curves.score_points(df)).first()["roc_auc"] == pytest.approx(mw, abs=1e-12)


def test_recall_without_negatives(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.8)], "label int, score double")
    r = curves.recall_at_fpr(curves.score_points(df), 0.02).first()
    assert (r["recall"], r["threshold"]) == (0.0, 1.0)


def test_pruning_moves_threshold_not_recall(spark):
    # equal horizontal steps: the last valid cut sits inside a collinear run
    y = np.array([1, 0, 0, 0, 0, 1, 0, 0])
    s = np.array([0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2])
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pts = curves.score_points(df)
    a = curves.recall_at_fpr(pts, 0.5, prune=True).first()
    b = curves.recall_at_fpr(pts, 0.5, prune=False).first()
    assert (a["recall"], a["threshold"]) == pytest.approx(recall_at(y, s, 0.5, True))
    assert (b["recall"], b["threshold"]) == pytest.approx(recall_at(y, s, 0.5, False))


@pytest.mark.parametrize("buckets,parts", [(1, 1), (7, 3), (64, 8)])
def test_running_total_equals_cumsum(spark, buckets, parts):
    rng = np.random.default_rng(buckets)
    k = rng.permutation(5000).astype(float)
    v = rng.integers(0, 10, 5000)
    df = spark.createDataFrame([(float(a), int(b), int(a) % 3) for a, b in zip(k, v)], "k double, v long, g long") \
        .repartition(parts)
    got = {r["k"]: r["cum_v"] for r in running_total(df, "k", ["v"], buckets=buckets).collect()}
    order = np.argsort(k)
    exp = dict(zip(k[order], np.cumsum(v[order])))
    assert got == exp
    gb = {(r["g"], r["k"]): r["cum_v"] for r in running_total(df, "k", ["v"], by=["g"], descending=True,
                                                               buckets=buckets).collect()}
    for g in range(3):
        m = (k.astype(int) % 3) == g
        kk, vv = k[m], v[m]
        o = np.argsort(-kk)
        for a, b in zip(kk[o], np.cumsum(vv[o])):
            assert gb[(g, a)] == b


def test_running_total_ties_are_range_frames(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 2), (2.0, 5)], "k double, v long")
    got = sorted((r["k"], r["cum_v"]) for r in running_total(df, "k", ["v"], buckets=4).collect())
    assert got == [(1.0, 3), (1.0, 3), (2.0, 8)]


def test_global_position(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(0, 50, 3000)
    b = rng.permutation(3000)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").repartition(4)
    got = {(r["a"], r["b"]): r["pos"] for r in global_position(df, ["a", "b"], buckets=9).collect()}
    order = sorted(zip(a.tolist(), b.tolist()))
    assert all(got[k] == i + 1 for i, k in enumerate(order))


@pytest.mark.parametrize("decimals", [1, 6])
def test_exact_quantiles_match_numpy(spark, decimals):
    rng = np.random.default_rng(decimals)
    x = np.round(rng.normal(size=2001), decimals)
    qs = [float(q) for q in np.linspace(0, 1, 11)] + [0.95, 0.99]
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(x)], "x double, g long")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "x", qs, buckets=8).collect()}
    for q in qs:
        assert got[q] == np.quantile(x, q), q
    by = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, "x", [0.5, 0.95], by=["g"]).collect()}
    for g in (0, 1):
        for q in (0.5, 0.95):
            assert by[(g, q)] == pytest.approx(np.quantile(x[np.arange(len(x)) % 2 == g], q), abs=1e-15)


def test_percentile_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "v", [0.5, 0.95]).collect()}
    assert got[0.5] == 2.5 and got[0.95] == pytest.approx(3.85)
