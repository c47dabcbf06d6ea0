import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.functions.bands import ThresholdError
from cutpoint.plans.inference import (check_resolved, profile_table, python_model_scorer,
                                      resolve_thresholds, run_inference)
from cutpoint.sources.policy_doc import build_documents, parse_documents, to_json_text


def scores(spark, vals):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, score double")


def decisions(out):
    return [r["decision"] for r in out.orderBy("id").collect()]


@pytest.mark.parametrize("profile,vals,expected", [
    ("primary", [0.05, 0.15, 0.85], ["approve", "review", "decline"]),
    ("fallback", [0.05, 0.15, 0.85], ["approve", "approve", "decline"]),
    ("phase2_guarded", [0.05, 0.25, 0.85], ["approve", "review", "decline"]),
])
def test_profiles(spark, profile, vals, expected):
    prof = profile_table(spark, extra={"phase2_guarded": (0.20, 0.80)})
    out = run_inference(scores(spark, vals), lambda d: d, prof, profile)
    assert decisions(out) == expected


def test_artifact_profile_needs_no_document(spark):
    prof = profile_table(spark, bundle_threshold=0.4)
    out = run_inference(scores(spark, [0.02, 0.90]), lambda d: d, prof, "artifact")
    r = out.orderBy("id").collect()
    assert [x["decision"] for x in r] == ["approve", "decline"]
    assert abs(r[0]["approve_threshold"] - 0.11) < 1e-12 and abs(r[0]["decline_threshold"] - 0.4) < 1e-12


def test_override_wins_per_side(spark):
    prof = profile_table(spark, bundle_threshold=0.4)
    out = run_inference(scores(spark, [0.02, 0.15, 0.85]), lambda d: d, prof, "artifact", approve_override=0.1)
    assert decisions(out) == ["approve", "review", "decline"]


def test_bad_order_rejected(spark):
    prof = profile_table(spark)
    with pytest.raises(Exception, match="approve_threshold < decline_threshold"):
        run_inference(scores(spark, [0.1]), lambda d: d, prof, "primary", approve_override=0.7,
                      decline_override=0.6).collect()
    with pytest.raises(ThresholdError):
        check_resolved(resolve_thresholds(scores(spark, [0.1]), prof, "primary", 0.7, 0.6))


def test_unknown_profile_rejected(spark):
    with pytest.raises(Exception, match="profile=nope"):
        run_inference(scores(spark, [0.1]), lambda d: d, profile_table(spark), "nope").collect()


def test_profiles_from_document(spark):
    best = spark.createDataFrame([("x", 0.2, 0.8, "none", True, 0.05, 0.003, 0.86, 1138.0, 0.04)],
                                 "seg string, approve_threshold double, decline_threshold double, method string, "
                                 "meets_guardrails boolean, review_rate double, decline_fpr double, "
                                 "flagged_fraud_capture double, total_cost double, cost_per_row double")
    g = dict(max_review_rate=0.1, min_capture=0.85, max_decline_fpr=0.02)
    docs = parse_documents(to_json_text(build_documents(best, ["seg"], ["none"], g, 0.01)))
    prof = profile_table(spark, docs=docs)
    out = run_inference(scores(spark, [0.05, 0.30, 0.90]), lambda d: d, prof, "phase2_guarded")
    assert decisions(out) == ["approve", "review", "decline"]


class StubModel:
    """Any object with predict_proba (the reference's duck typing)."""

    def __init__(self, values):
        self.values = values

    def predict_proba(self, x):
        p = np.clip(x[:, 0], 0, 1)
        return np.column_stack([1 - p, p])


def test_python_model_scorer_arrow_batches(spark):
    df = spark.createDataFrame([(0, 0.05), (1, 0.30), (2, 0.90)], "id long, f double")
    prof = profile_table(spark, extra={"phase2_guarded": (0.20, 0.80)})
    out = run_inference(df, python_model_scorer(StubModel(None), ["f"]), prof, "phase2_guarded")
    assert decisions(out) == ["approve", "review", "decline"]
    with pytest.raises(ValueError):
        python_model_scorer(object(), ["f"])


def test_per_row_profile_join(spark):
    df = spark.createDataFrame([(0, 0.15, "primary"), (1, 0.15, "fallback")], "id long, score double, p string")
    out = run_inference(df, lambda d: d, profile_table(spark), F.col("p"))
    assert decisions(out) == ["review", "approve"]


def test_nan_score_fails_the_pass(spark):
    df = spark.createDataFrame([(0, 0.1), (1, float("nan"))], "id long, score double")
    with pytest.raises(Exception, match="null or NaN score"):
        run_inference(df, lambda d: d, profile_table(spark), "primary").collect()


def test_default_profiles_are_joined_without_a_shuffle_of_the_rows(spark):
    prof = profile_table(spark, extra={"phase2_guarded": (0.20, 0.80)})
    rows = spark.range(1000).selectExpr("id / 1000D AS score", "if(id % 2 = 0, 'primary', 'artifact') AS p")
    out = run_inference(rows, lambda d: d, prof, F.col("p"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert out.where("decision IS NULL").count() == 0
    assert {tuple(r) for r in prof.collect()} == {("primary", 0.11, 0.45), ("fallback", 0.19, 0.8),
                                                  ("phase2_guarded", 0.2, 0.8), ("artifact", 0.11, 0.45)}
