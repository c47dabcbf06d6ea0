"""Model, calibration and optimizer queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.functions.pairs import GRID_DEFAULTS, threshold_grid
from cutpoint.operators import calibrate, curves, model, policy, ranking
from cutpoint.operators.prefix import reuse
from cutpoint.plans import catalog as C
from cutpoint.plans.common import ts_text
from cutpoint.session import ensure_checkpoint_dir
from cutpoint.sources import policy_doc as pdoc
from cutpoint.sources.contract import resolve_feature_columns
from cutpoint.sources.tables import TXN_FEATURES, TXN_KEY

# Optimality tolerance on the normalised gradient (the reference solver's
# default stopping tolerance).
GRAD_TOL = 1e-4
#: Places to which fitted numbers are reported: two solvers that both converge agree on these.
FIT_PLACES = 4


def three_way(spark, sf) -> DataFrame:
    from cutpoint.operators import split
    return split.temporal_three_way(C.txn_tie(spark, sf), "ts", C.TIE_ORDER, C.TEST_SIZE,
                                    C.CALIBRATION_FRACTION)


def _parts(spark, sf):
    s = three_way(spark, sf)
    return (s.filter(F.col("split") == "train"), s.filter(F.col("split") == "calibration"),
            s.filter(F.col("split") == "evaluation"))


def q_logreg_fit(spark, sf):
    """M1: balanced L2 logistic on raw features over the train part; the
    check is first-order optimality for the reference objective, measured in
    standardised coordinates so it does not depend on feature units."""
    tr, _, _ = _parts(spark, sf)
    m = model.fit_logistic(tr, TXN_FEATURES, c_value=1.0, max_iter=1000, scaled=False)
    g = model.gradient_check(m, tr, c_value=1.0)
    got = model.train_summary(tr, TXN_FEATURES)     # what the fit used, for comparison by value
    parts = [F.lit(v).alias(f"{name}_{c}") for c in TXN_FEATURES for name, v in zip(("mean", "std"), got.scaler[c], strict=True)]
    # The coefficients in units of one standard deviation, the intercept at the mean of all features.
    lr = m.stages[-1]
    at_mean = float(lr.intercept) + sum(float(b) * got.scaler[c][0] for b, c in zip(lr.coefficients, TXN_FEATURES, strict=True))
    parts += [F.lit(round(float(b) * got.scaler[c][1], FIT_PLACES)).alias(f"effect_{c}")
              for b, c in zip(lr.coefficients, TXN_FEATURES, strict=True)] + [F.lit(round(at_mean, FIT_PLACES)).alias("intercept")]
    return g.select(F.lit("raw_logreg_c1.0").alias("candidate"),
                    (F.col("max_abs_scaled_gradient") <= GRAD_TOL).alias("gradient_small"),
                    F.lit(got.n).cast("long").alias("train_rows"),
                    F.lit(got.n / (2.0 * got.n_positive)).alias("weight_positive"),
                    F.lit(got.n / (2.0 * (got.n - got.n_positive))).alias("weight_negative"), *parts)


def q_model_sweep(spark, sf):
    """M2 + O1: fit each candidate on train, score the test part once per
    candidate, and measure all candidates in one curve job (by candidate)."""
    s = three_way(spark, sf)
    # The summary and the fits read the same training rows: keep the narrow projection.
    tr = reuse(s.filter(F.col("split") == "train").select(*TXN_FEATURES, "label"))
    wide = s.filter(F.col("split") != "train").select(*TXN_FEATURES, "label")
    cands = model.default_candidates()
    for i, m in enumerate(model.fit_candidates(tr, TXN_FEATURES, cands), 1):
        wide = model.score(m, wide, out=f"score_{i}")
    # One pass over the test rows gives every candidate's score.
    scored = wide.select("label", F.inline(F.array(*(
        F.struct(F.lit(i).alias("candidate_no"), F.lit(c.name).alias("candidate"), F.col(f"score_{i}").alias("score"))
        for i, c in enumerate(cands, 1)))))
    pts = curves.score_points(scored, by=["candidate_no", "candidate"])
    auc = curves.auc_metrics(pts, by=["candidate_no", "candidate"])
    rec = curves.recall_at_fpr(pts, C.TARGET_FPR, by=["candidate_no", "candidate"]) \
        .select("candidate_no", "candidate", F.col("recall").alias("recall_at_target_fpr"),
                F.round("threshold", FIT_PLACES).alias("threshold_at_target_fpr"))
    res = auc.join(rec, ["candidate_no", "candidate"])
    return ranking.rank_models(res)


def q_platt_calibration(spark, sf):
    """M5: the Platt fit on the calibration part satisfies optimality."""
    _, cal, _ = _parts(spark, sf)
    fitted = calibrate.fit_platt(cal)
    _, m = fitted
    n = cal.count()
    t = cal.select(F.col("score").cast("double").alias("score"), F.col("label").cast("double").alias("label"))
    r = calibrate.platt(fitted, F.col("score")) - F.col("label")
    row = t.agg(F.sum(r).alias("g0"), F.sum(r * F.col("score")).alias("g1")).first()
    coef = float(m.coefficients[0])
    g = max(abs(row["g0"] / n), abs(row["g1"] / n + coef / n))
    return spark.range(1).select(F.lit("platt").alias("method"), F.lit(bool(g <= GRAD_TOL)).alias("gradient_small"),
                                 F.lit(int(n)).cast("long").alias("rows"), F.lit(round(coef, FIT_PLACES)).alias("slope"),
                                 F.lit(round(float(m.intercept), FIT_PLACES)).alias("intercept"))


def q_isotonic_calibration(spark, sf):
    """M6: calibrated evaluation scores (checked against a brute-force
    pool-adjacent-violators fit in the tests)."""
    _, cal, ev = _parts(spark, sf)
    iso = calibrate.fit_isotonic(cal)
    out = calibrate.apply_isotonic(iso, ev.select(*TXN_KEY, "ts", "score", "label").withColumn("raw_score", F.col("score")))
    return out.select(*TXN_KEY, ts_text(), "label", "raw_score", F.col("score").alias("calibrated_score"))


def q_calibration_none(spark, sf):
    """M4: evaluation-part scores as doubles."""
    _, _, ev = _parts(spark, sf)
    return calibrate.calibrate_none(ev).select(*TXN_KEY, ts_text(), "score", "label")


def optimizer_summary(spark, sf, methods=calibrate.METHODS):
    """M7: per method -> cost sweep -> guardrails -> recommendation, then the
    best method (O7); one sweep job for all methods (``by=method``)."""
    # One pass over the split: (split, score, label, n); everything after it
    # (both calibration fits, every method's sweep) reads this histogram.
    h = policy.score_label_histogram(three_way(spark, sf), by=["split"])
    cal = h.filter(F.col("split") == "calibration").drop("split")
    ev = h.filter(F.col("split") == "evaluation").drop("split")
    u = calibrate.calibrated_union(cal, ev, methods, weight="n")
    grid = threshold_grid(spark, **GRID_DEFAULTS)
    ranked = policy.search_best_policy(u, grid, **C.COSTS, by=["method", "method_no"], weight="n")
    rec = ranking.recommend_cost(ranked, **C.COST_GUARDRAILS, by=["method", "method_no"])
    best = ranking.best_method(rec).select("method", F.lit(True).alias("is_best"))
    return rec.join(best, "method", "left").withColumn("is_best", F.coalesce("is_best", F.lit(False)))


def q_optimizer_job(spark, sf):
    s = optimizer_summary(spark, sf)
    return s.select("method", "method_no", "approve_threshold", "decline_threshold", "total_cost",
                    "cost_per_row", "review_rate", "decline_fpr", "flagged_fraud_capture",
                    "meets_guardrails", "is_best")


def _policy_texts(spark, sf) -> DataFrame:
    """M7 -> S6: the best method's policy as a document, (doc_id, json)."""
    best = optimizer_summary(spark, sf).filter("is_best")
    docs = pdoc.build_documents(best, [], calibrate.METHODS, C.COST_GUARDRAILS, GRID_DEFAULTS["step"],
                                generated_at=F.lit("2024-01-01"))
    return pdoc.to_json_text(docs)


def q_policy_recompute_drift(spark, sf):
    """M7 -> S6 -> S4 -> J4: write the optimised policy, run the whole optimiser again, and
    compare the stored document with the new one: its validity and number of differences."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/policy_{uuid.uuid4().hex}"
    _policy_texts(spark, sf).write.json(path)
    stored, fresh = pdoc.read_documents(spark, path), _policy_texts(spark, sf)
    found = pdoc.compare_documents(pdoc.parse_documents(stored), pdoc.parse_documents(fresh))
    counted = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("differences"))
    return (pdoc.registry_status(stored).join(counted, "doc_id", "left")
            .select("doc_id", "violations", "valid", F.coalesce("differences", F.lit(0)).cast("long").alias("differences")))


def q_bundle_roundtrip(spark, sf):
    """S7 + S8: save a fitted bundle to the shared folder, load it, and score
    the test part with both; report rows and the largest difference."""
    s = three_way(spark, sf)
    tr = s.filter(F.col("split") == "train")
    te = s.filter(F.col("split") != "train").select(*TXN_KEY, *TXN_FEATURES, "label")
    m = model.fit_logistic(tr, TXN_FEATURES, c_value=1.0, max_iter=200, scaled=True)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bundle_{uuid.uuid4().hex}"
    model.save_bundle(m, TXN_FEATURES, C.TARGET_FPR, 0.5, path)
    b = model.load_bundle(spark, path)
    feats = resolve_feature_columns(te, b.feature_columns)        # P3: bundle order wins
    # Both models score the same rows: no key is needed, and no join.
    both = model.score(b.model, model.score(m, te, "s1").select(*TXN_KEY, "s1", *feats), "s2")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_abs_diff"),
                 F.lit(",".join(b.feature_columns or [])).alias("feature_columns"))


QUERIES = {
    "logreg_fit": q_logreg_fit,
    "model_sweep": q_model_sweep,
    "platt_calibration": q_platt_calibration,
    "isotonic_calibration": q_isotonic_calibration,
    "calibration_none": q_calibration_none,
    "optimizer_job": q_optimizer_job,
    "bundle_roundtrip": q_bundle_roundtrip,
    "policy_recompute_drift": q_policy_recompute_drift,
}
