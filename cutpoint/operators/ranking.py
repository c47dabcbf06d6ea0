"""Policy and model choice.

Inputs are the per-pair metric tables of a sweep: small by construction
(one row per threshold pair, per group). Each choice is one ordering that
ends in the unique input ordinal, and ``row_number() == 1`` per group, so
group-wise choices need no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions import guardrails


def _first(df: DataFrame, order, by: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__pick", F.row_number().over(w)).filter("__pick = 1").drop("__pick")


def recommend_simulation(ranked: DataFrame, max_review_rate: float = 0.08,
                         min_capture: float = 0.95, max_decline_fpr: float = 0.02,
                         by: Sequence[str] = ()) -> DataFrame:
    """The first feasible policy in O2 rank order; if none, the lowest
    weighted violation, then capture desc, review asc, FPR asc, rank."""
    a = guardrails.annotate(ranked, "fraud_capture_flagged", max_review_rate, min_capture,
                            max_decline_fpr, capture_first=False)
    feas = F.col("meets_guardrails")
    order = [feas.desc(),
             F.when(feas, F.col("rank")).asc_nulls_last(),
             F.col("violation_score").asc(), F.col("fraud_capture_flagged").desc(),
             F.col("review_rate").asc(), F.col("decline_fpr").asc(), F.col("rank").asc()]
    return _first(a, order, by)


def recommend_cost(ranked: DataFrame, max_review_rate: float = 0.10, min_capture: float = 0.85,
                   max_decline_fpr: float = 0.02, by: Sequence[str] = ()) -> DataFrame:
    """Cheapest feasible policy (O3 order); if none, lowest violation then O3."""
    a = guardrails.annotate(ranked, "flagged_fraud_capture", max_review_rate, min_capture,
                            max_decline_fpr, capture_first=True)
    feas = F.col("meets_guardrails")
    order = [feas.desc(),
             F.when(~feas, F.col("violation_score")).asc_nulls_first(),
             F.col("total_cost").asc(), F.col("flagged_fraud_capture").desc(),
             F.col("review_rate").asc(), F.col("decline_fpr").asc(), F.col("rank").asc()]
    return _first(a, order, by)


def fallback_policy(ranked: DataFrame, recommended: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """O6 + J6: among the other policies, lowest review rate, then FPR, then
    capture desc, then rank. Empty when the recommended policy is alone."""
    others = ranked.join(recommended.select(*by, F.col("policy_id").alias("__rec")), list(by), "left") \
        .filter(F.col("policy_id") != F.col("__rec")).drop("__rec") if by else \
        ranked.join(recommended.select("policy_id"), "policy_id", "left_anti")
    order = [F.col("review_rate").asc(), F.col("decline_fpr").asc(),
             F.col("fraud_capture_flagged").desc(), F.col("rank").asc()]
    return _first(others, order, by)


class PromotionError(ValueError):
    """A promotion was asked for that the gate refuses."""


def promotion_gate(recommended: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (per group) saying whether promotion may proceed; the
    caller raises when ``require_feasible`` and ``gate_pass`` is false."""
    agg = F.bool_or("meets_guardrails").alias("gate_pass")
    return recommended.groupBy(*by).agg(agg) if by else recommended.agg(agg)


def enforce_promotion_gate(gate: DataFrame, require_feasible: bool) -> None:
    if require_feasible and not all(r["gate_pass"] for r in gate.collect()):
        raise PromotionError("nothing to promote: every recommended policy breaks a guardrail")


def best_method(method_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Feasible first, then O3 keys, then the methods' input order."""
    order = [F.col("meets_guardrails").desc(), F.col("total_cost").asc(),
             F.col("flagged_fraud_capture").desc(), F.col("review_rate").asc(),
             F.col("decline_fpr").asc(), F.col("method_no").asc()]
    return _first(method_rows, order, by)


def rank_models(results: DataFrame) -> DataFrame:
    """O1: recall desc, PR-AUC desc, ROC-AUC desc, then candidate order."""
    w = Window.orderBy(F.col("recall_at_target_fpr").desc(), F.col("pr_auc").desc(),
                       F.col("roc_auc").desc(), F.col("candidate_no").asc())
    return results.withColumn("model_rank", F.row_number().over(w))
