"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (through the ``txn`` view or directly)
over their whole extent. Parameters mirror the reference defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.functions import bands
from cutpoint.functions.pairs import GRID_DEFAULTS, threshold_grid
from cutpoint.functions import guardrails
from cutpoint.functions.pairs import neighbourhood_pairs
from cutpoint.functions.pairs import default_pairs
from cutpoint.operators import brackets, curves, errors, monitor, policy, ranking, split
from cutpoint.operators.prefix import exact_quantiles
from cutpoint.plans.common import round_doubles, ts_text
from cutpoint.sources import contract
from cutpoint.sources.tables import TXN_KEY, TXN_TIEBREAK, read_table, tie_hash, txn, typed_load

# Query parameters (reference defaults and published policies).
T1, T2 = 0.20, 0.80                      # phase2_guarded profile
COSTS = dict(c_fn=25.0, c_fd=5.0, c_rev=0.4)
SIM_GUARDRAILS = dict(max_review_rate=0.08, min_capture=0.95, max_decline_fpr=0.02)
COST_GUARDRAILS = dict(max_review_rate=0.10, min_capture=0.85, max_decline_fpr=0.02)
SENSITIVITY_CENTER = (0.11, 0.45)
SENSITIVITY_GUARDRAILS = dict(max_review_rate=0.102, min_capture=0.95, max_decline_fpr=0.02)
SIM_PAIRS = [(0.05, 0.45), (0.08, 0.50), (0.11, 0.45), (0.19, 0.80), (0.20, 0.80),
             (0.03, 0.40), (0.12, 0.60), (0.10, 0.30)]
WIDE_GRID = dict(t1_min=0.01, t1_max=0.50, t2_min=0.10, t2_max=0.99, step=0.01)
TARGET_FPR = 0.02
TEST_SIZE = 0.2
CALIBRATION_FRACTION = 0.5
REQUIRED_TXN_COLUMNS = ("ts", "amount", "l_quantity", "l_discount", "l_tax", "label", "score")


def pairs_df(spark: SparkSession, pairs) -> DataFrame:
    return spark.createDataFrame([(i + 1, float(a), float(b)) for i, (a, b) in enumerate(pairs)],
                                 "pair_no int, t1 double, t2 double")


# ------------------------------------------------------------- contract / bands

def q_contract_check(spark, sf):
    t = txn(spark, sf)
    # One more column than the table has, so that the check reports an absence too.
    return contract.column_profile(t, [*REQUIRED_TXN_COLUMNS, "channel"]).na.fill(-1, ["null_count", "nan_count"])


def q_score_band(spark, sf):
    t = txn(spark, sf)
    return t.select(*TXN_KEY, ts_text(), "score", bands.decision(F.col("score"), T1, T2).alias("decision"))


def q_predicted_class(spark, sf):
    t = txn(spark, sf)
    return t.select(*TXN_KEY, ts_text(), "score",
                    bands.predicted_class(F.col("score"), T2).alias("predicted_class"))


# ------------------------------------------------------------------ policies

def q_policy_eval(spark, sf):
    """Flagship: typed scan (S2: contract, double features, tinyint label)
    -> bands at (T1, T2) -> the 18 policy metrics (G3)."""
    typed = typed_load(txn(spark, sf))
    return round_doubles(policy.evaluate_policy(typed, T1, T2))


def q_policy_cost(spark, sf):
    return round_doubles(policy.evaluate_policy_cost(txn(spark, sf), T1, T2, **COSTS))


def q_policy_sweep(spark, sf):
    return round_doubles(policy.evaluate_threshold_pairs(txn(spark, sf), pairs_df(spark, SIM_PAIRS)))


def q_cost_sweep(spark, sf):
    grid = threshold_grid(spark, **GRID_DEFAULTS)
    return round_doubles(policy.search_best_policy(txn(spark, sf), grid, **COSTS))


def sim_ranked(spark, sf):
    return policy.evaluate_threshold_pairs(txn(spark, sf), pairs_df(spark, SIM_PAIRS))


def cost_ranked(spark, sf):
    grid = threshold_grid(spark, **GRID_DEFAULTS)
    return policy.search_best_policy(txn(spark, sf), grid, **COSTS)


def q_guardrail_annotate(spark, sf):
    g = COST_GUARDRAILS
    return round_doubles(guardrails.annotate(cost_ranked(spark, sf), "flagged_fraud_capture",
                                             g["max_review_rate"], g["min_capture"],
                                             g["max_decline_fpr"], capture_first=True))


def q_recommend_sim(spark, sf):
    return round_doubles(ranking.recommend_simulation(sim_ranked(spark, sf), **SIM_GUARDRAILS))


def q_recommend_cost(spark, sf):
    return round_doubles(ranking.recommend_cost(cost_ranked(spark, sf), **COST_GUARDRAILS))


def q_fallback_policy(spark, sf):
    ranked = sim_ranked(spark, sf)
    rec = ranking.recommend_simulation(ranked, **SIM_GUARDRAILS)
    return round_doubles(ranking.fallback_policy(ranked, rec))


def q_promotion_gate(spark, sf):
    rec = ranking.recommend_cost(cost_ranked(spark, sf), **COST_GUARDRAILS)
    return ranking.promotion_gate(rec)


def q_wide_sweep(spark, sf):
    """D3: the simulation rule over a wide grid (thousands of pairs); the
    cost stays one scan plus a histogram of (cuts + 1) x 2 rows."""
    ranked = policy.evaluate_threshold_pairs(txn(spark, sf), threshold_grid(spark, **WIDE_GRID))
    g = SIM_GUARDRAILS
    ok = guardrails.meets(F.col("review_rate"), F.col("fraud_capture_flagged"), F.col("decline_fpr"),
                          g["max_review_rate"], g["min_capture"], g["max_decline_fpr"])
    return round_doubles(ranked.withColumn("meets_guardrails", ok))


def q_sensitivity(spark, sf):
    """25 pairs around the primary policy; metric ranges and pass count."""
    center = spark.range(1).select(F.lit(SENSITIVITY_CENTER[0]).alias("t1"),
                                   F.lit(SENSITIVITY_CENTER[1]).alias("t2"))
    ranked = policy.evaluate_threshold_pairs(txn(spark, sf), neighbourhood_pairs(center))
    g = SENSITIVITY_GUARDRAILS
    ok = guardrails.meets(F.col("review_rate"), F.col("fraud_capture_flagged"), F.col("decline_fpr"),
                          g["max_review_rate"], g["min_capture"], g["max_decline_fpr"])
    out = ranked.agg(F.count(F.lit(1)).alias("n_pairs"),
                     F.min("review_rate").alias("review_rate_min"),
                     F.max("review_rate").alias("review_rate_max"),
                     F.min("decline_fpr").alias("decline_fpr_min"),
                     F.max("decline_fpr").alias("decline_fpr_max"),
                     F.min("fraud_capture_flagged").alias("capture_min"),
                     F.max("fraud_capture_flagged").alias("capture_max"),
                     F.count_if(ok).alias("pass_count"))
    return round_doubles(out)


# ------------------------------------------------------------------- curves

def txn_points(spark, sf):
    return curves.score_points(txn(spark, sf))


def q_pr_auc(spark, sf):
    return round_doubles(curves.auc_metrics(txn_points(spark, sf)).select("pr_auc"))


def q_roc_auc(spark, sf):
    return round_doubles(curves.auc_metrics(txn_points(spark, sf)).select("roc_auc"))


def q_recall_at_fpr(spark, sf):
    pts = txn_points(spark, sf)
    pr = curves.recall_at_fpr(pts, TARGET_FPR, prune=True).withColumn("pruned", F.lit(True))
    un = curves.recall_at_fpr(pts, TARGET_FPR, prune=False).withColumn("pruned", F.lit(False))
    return round_doubles(pr.unionByName(un))


def q_roc_points(spark, sf):
    return round_doubles(curves.roc_points(txn_points(spark, sf), prune=True))


def q_suggest_t1(spark, sf):
    """M8: T1 = 0.90 quantile of scores, T2 = threshold at the FPR cap."""
    t = txn(spark, sf)
    t1 = exact_quantiles(t, "score", [0.9]).first()["value"]
    t2 = curves.recall_at_fpr(curves.score_points(t), TARGET_FPR).first()["threshold"]
    return round_doubles(spark.range(1).select(
        F.lit(float(t1)).alias("t1"), F.lit(float(t2)).alias("t2"),
        F.lit(bool(t1 > t2)).alias("t1_above_t2")))


def q_default_pairs(spark, sf):
    """F4 around the decline threshold found at the FPR cap (the bundle's
    threshold_for_target_fpr in the reference)."""
    base = curves.recall_at_fpr(txn_points(spark, sf), TARGET_FPR).select(F.col("threshold").alias("base"))
    return round_doubles(default_pairs(base))


# ------------------------------------------------------------------- splits

SAMPLE_SIZE = 20000
SEED = 42
TOP_N = 20


def txn_tie(spark, sf):
    """txn plus two integer spread keys every engine computes identically."""
    t = txn(spark, sf)
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return (t.withColumn("tie", tie_hash(ok, ln))
             .withColumn("h", ((ok % 2147483647) * 48271 + ln * 16807 + SEED) % 2147483647))


TIE_ORDER = ["tie", *TXN_TIEBREAK]
SAMPLE_ORDER = ["h", *TXN_TIEBREAK, "ts"]


def split_summary(df: DataFrame, by=("split",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum("label").cast("long").alias("positives"),
                               F.sum("l_orderkey").cast("long").alias("key_sum"),
                               F.sum("l_linenumber").cast("long").alias("line_sum"))


def q_temporal_split(spark, sf):
    return split_summary(split.temporal_split(txn_tie(spark, sf), "ts", TIE_ORDER, TEST_SIZE))


def q_calibration_split(spark, sf):
    return split_summary(split.temporal_three_way(txn_tie(spark, sf), "ts", TIE_ORDER, TEST_SIZE,
                                                  CALIBRATION_FRACTION))


def q_stratified_split(spark, sf):
    s = split.stratified_split(txn_tie(spark, sf), "label", "h", list(TXN_TIEBREAK) + ["ts"], TEST_SIZE)
    return split_summary(s, by=("split", "label"))


def q_fixed_sample(spark, sf):
    return split.fixed_sample(txn_tie(spark, sf), SAMPLE_SIZE, SAMPLE_ORDER) \
        .select(*TXN_KEY, ts_text(), "h", "score", "label")


# --------------------------------------------------------------- monitoring

def scored_txn(spark, sf, t1=T1, t2=T2):
    t = txn(spark, sf)
    return t.withColumn("decision", bands.decision(F.col("score"), t1, t2))


def q_decision_mix(spark, sf):
    return round_doubles(monitor.decision_mix(scored_txn(spark, sf)))


def q_score_stats(spark, sf):
    return round_doubles(monitor.score_stats(txn(spark, sf)))


def q_label_quality(spark, sf):
    return round_doubles(monitor.label_quality(scored_txn(spark, sf)))


def split_pops(spark, sf):
    s = split.temporal_split(txn_tie(spark, sf), "ts", TIE_ORDER, TEST_SIZE)
    return monitor.split_populations(s, "train", "test")


def q_psi(spark, sf):
    return round_doubles(monitor.psi_of(split_pops(spark, sf)))


def q_psi_by_segment(spark, sf):
    """G9 by segment: each return flag's test part against its own train part."""
    s = split.temporal_split(txn_tie(spark, sf), "ts", TIE_ORDER, TEST_SIZE)
    h = monitor.split_histogram(s, "train", "test", by=["l_returnflag"])
    return round_doubles(monitor.psi_by(h, ["l_returnflag"]))


def q_ks_by_segment(spark, sf):
    s = split.temporal_split(txn_tie(spark, sf), "ts", TIE_ORDER, TEST_SIZE)
    h = monitor.split_histogram(s, "train", "test", by=["l_returnflag"])
    return round_doubles(monitor.ks_by(h, ["l_returnflag"]))


def q_segment_curves(spark, sf):
    """G10-G12 per segment: one distinct-score pass grouped by return flag."""
    pts = curves.score_points(txn(spark, sf), by=["l_returnflag"])
    auc = curves.auc_metrics(pts, by=["l_returnflag"])
    rec = curves.recall_at_fpr(pts, TARGET_FPR, by=["l_returnflag"])
    return round_doubles(auc.join(rec, "l_returnflag"))


def q_ks_drift(spark, sf):
    return round_doubles(brackets.ks(split_pops(spark, sf), "pop"))


def q_daily_mix(spark, sf):
    return round_doubles(monitor.daily_mix(scored_txn(spark, sf)))


def q_review_alerts(spark, sf):
    return round_doubles(monitor.review_alerts(monitor.daily_mix(scored_txn(spark, sf))))


def q_segment_metrics(spark, sf):
    """Policy metrics per amount bucket x ship year."""
    t = (txn(spark, sf).withColumn("amount_bucket", F.floor(F.col("amount") / 25000.0).cast("long"))
         .withColumn("year", F.year("ts").cast("long")))
    return round_doubles(policy.evaluate_policy(t, T1, T2, by=["amount_bucket", "year"]))


def q_band_capture(spark, sf):
    return round_doubles(monitor.band_capture(scored_txn(spark, sf)))


def q_duration_percentiles(spark, sf):
    ev = read_table(spark, sf, "events")
    return round_doubles(monitor.duration_percentiles(ev, "value", by=["event_type"]))


# ------------------------------------------------------------------- errors

def cap_threshold(spark, sf) -> float:
    return float(curves.recall_at_fpr(txn_points(spark, sf), TARGET_FPR).first()["threshold"])


def q_confusion(spark, sf):
    pts = txn_points(spark, sf)
    th = float(curves.recall_at_fpr(pts, TARGET_FPR).first()["threshold"])
    return round_doubles(errors.confusion_from_points(pts, th).withColumn("threshold", F.lit(th)))


def q_top_errors(spark, sf):
    th = cap_threshold(spark, sf)
    out = errors.top_errors(txn(spark, sf), th, TOP_N, keep=[*TXN_KEY, "ts", "amount"],
                            tiebreak=list(TXN_TIEBREAK))
    # Export the listed columns that exist, in order (row id = the key).
    out = errors.export_columns(out, [*TXN_KEY, "ts", "amount", "Time", "Amount", "score",
                                      "label", "predicted_class", "error_type"])
    return round_doubles(out.withColumn("ts", ts_text()))


QUERIES = {
    "contract_check": q_contract_check,
    "score_band": q_score_band,
    "predicted_class": q_predicted_class,
    "policy_eval": q_policy_eval,
    "policy_cost": q_policy_cost,
    "policy_sweep": q_policy_sweep,
    "cost_sweep": q_cost_sweep,
    "guardrail_annotate": q_guardrail_annotate,
    "recommend_sim": q_recommend_sim,
    "recommend_cost": q_recommend_cost,
    "fallback_policy": q_fallback_policy,
    "promotion_gate": q_promotion_gate,
    "sensitivity": q_sensitivity,
    "wide_sweep": q_wide_sweep,
    "pr_auc": q_pr_auc,
    "roc_auc": q_roc_auc,
    "recall_at_fpr": q_recall_at_fpr,
    "roc_points": q_roc_points,
    "suggest_t1": q_suggest_t1,
    "default_pairs": q_default_pairs,
    "temporal_split": q_temporal_split,
    "calibration_split": q_calibration_split,
    "stratified_split": q_stratified_split,
    "fixed_sample": q_fixed_sample,
    "decision_mix": q_decision_mix,
    "score_stats": q_score_stats,
    "label_quality": q_label_quality,
    "psi": q_psi,
    "psi_by_segment": q_psi_by_segment,
    "ks_drift": q_ks_drift,
    "ks_by_segment": q_ks_by_segment,
    "segment_curves": q_segment_curves,
    "daily_mix": q_daily_mix,
    "review_alerts": q_review_alerts,
    "segment_metrics": q_segment_metrics,
    "band_capture": q_band_capture,
    "duration_percentiles": q_duration_percentiles,
    "confusion": q_confusion,
    "top_errors": q_top_errors,
}
