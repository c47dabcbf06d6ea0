"""Guardrail predicate and violations.

Two rule sets exist and differ in defaults, metric name and in the order the
weighted violation is summed (kept, so ties break identically).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed weights of the soft-violation score.
W_REVIEW, W_CAPTURE, W_FPR = 1.0, 2.0, 1.5


def check_guardrails(max_review_rate: float, min_capture: float, max_decline_fpr: float) -> None:
    """Each limit in [0, 1]."""
    for name, v in (("max_review_rate", max_review_rate), ("min_flagged_fraud_capture", min_capture),
                    ("max_decline_fpr", max_decline_fpr)):
        if not (0.0 <= float(v) <= 1.0):
            raise ValueError(f"{name} must be in [0, 1], got {v}.")


def meets(review: Column, capture: Column, fpr: Column, max_review_rate: float,
          min_capture: float, max_decline_fpr: float) -> Column:
    """P9."""
    return ((review <= F.lit(float(max_review_rate))) & (capture >= F.lit(float(min_capture)))
            & (fpr <= F.lit(float(max_decline_fpr))))


def annotate(df: DataFrame, capture_col: str, max_review_rate: float, min_capture: float,
             max_decline_fpr: float, capture_first: bool) -> DataFrame:
    """P10: flag, three violations and the weighted violation score.

    ``capture_first`` picks the cost rule's summation order
    (capture*2 + review*1 + fpr*1.5); otherwise review*1 + capture*2 + fpr*1.5.
    """
    check_guardrails(max_review_rate, min_capture, max_decline_fpr)
    rv = F.greatest(F.lit(0.0), F.col("review_rate") - F.lit(float(max_review_rate)))
    cv = F.greatest(F.lit(0.0), F.lit(float(min_capture)) - F.col(capture_col))
    fv = F.greatest(F.lit(0.0), F.col("decline_fpr") - F.lit(float(max_decline_fpr)))
    out = (df.withColumn("meets_guardrails", meets(F.col("review_rate"), F.col(capture_col),
                                                   F.col("decline_fpr"), max_review_rate,
                                                   min_capture, max_decline_fpr))
           .withColumn("review_violation", rv)
           .withColumn("capture_violation", cv)
           .withColumn("decline_fpr_violation", fv))
    r, c, f = F.col("review_violation"), F.col("capture_violation"), F.col("decline_fpr_violation")
    score = (c * W_CAPTURE + r * W_REVIEW + f * W_FPR) if capture_first else \
            (r * W_REVIEW + c * W_CAPTURE + f * W_FPR)
    return out.withColumn("violation_score", score)
