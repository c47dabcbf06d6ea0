"""Score curves: PR-AUC, ROC-AUC, ROC points, recall at an FPR cap.

Rows are first reduced to one row per distinct score with positive and
negative counts (map-side combine). Cumulative counts in descending score
order come from ``running_total`` (bucketed prefix sums, no single-task
sort). PR-AUC and ROC-AUC are then plain sums over distinct scores:

* AP  = sum_i pos_i * tps_i / (tps_i + fps_i) / P      (step rule, not trapezoid)
* AUC = sum_i neg_i * (2 tps_i - pos_i) / (2 P N)      (trapezoid, exact in integers)

Collinear-point pruning (W3) needs each point's successor; positions come
from a running count, and the successor is an equi-join on position + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.functions.bands import guarded, is_bad
from cutpoint.operators.prefix import AUTO, reuse, running_total


def score_points(scored: DataFrame, by: Sequence[str] = (), score: str = "score",
                 label: str = "label", buckets: int | None = AUTO) -> DataFrame:
    """One row per (group, distinct score), descending-order cumulative counts:
    pos, neg, tps, fps, pt (1-based point index in descending score order)."""
    pts = (scored.groupBy(*by, F.col(score).cast("double").alias("score"))
           .agg(F.count_if(F.col(label) == 1).alias("pos"),
                F.count_if(F.col(label) == 0).alias("neg"), F.count(F.lit(1)).alias("__n"))
           .withColumn("score", guarded(F.col("score"), F.when(is_bad(F.col("score")), F.col("__n"))))
           .drop("__n").withColumn("one", F.lit(1)))
    cum = running_total(pts, "score", ["pos", "neg", "one"], by=by, descending=True,
                        buckets=buckets)
    # Read by several jobs (totals, successor join, sums): one row per distinct score.
    return reuse(cum.select(*by, "score", "pos", "neg", F.col("cum_pos").alias("tps"),
                            F.col("cum_neg").alias("fps"), F.col("cum_one").alias("pt")))


def _totals(points: DataFrame, by: Sequence[str]) -> DataFrame:
    agg = [F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.max("pt").alias("m")]
    return points.groupBy(*by).agg(*agg) if by else points.agg(*agg)


def _with_totals(points: DataFrame, by: Sequence[str]) -> DataFrame:
    tot = _totals(points, by)
    if by:
        return points.join(tot, list(by))
    r = tot.first()
    return points.select("*", F.lit(r["P"] or 0).cast("long").alias("P"),
                         F.lit(r["N"] or 0).cast("long").alias("N"),
                         F.lit(r["m"] or 0).cast("long").alias("m"))


def auc_metrics(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """G10 + G11 per group: pr_auc, roc_auc (null when a class is absent)."""
    ap_term = F.col("pos").cast("double") * F.col("tps") / (F.col("tps") + F.col("fps"))
    auc_num = (F.col("neg").cast("decimal(38,0)")
               * (F.lit(2) * F.col("tps") - F.col("pos")).cast("decimal(38,0)"))
    aggs = [F.sum(ap_term).alias("ap_sum"), F.sum(auc_num).alias("auc_num"),
            F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    g = points.groupBy(*by).agg(*aggs) if by else points.agg(*aggs)
    P, N = F.col("P").cast("double"), F.col("N").cast("double")
    return g.select(*by,
                    F.when(F.col("P") > 0, F.col("ap_sum") / P).alias("pr_auc"),
                    F.when((F.col("P") > 0) & (F.col("N") > 0),
                           F.col("auc_num").cast("double") / (F.lit(2.0) * P * N)).alias("roc_auc"))


def roc_points(points: DataFrame, by: Sequence[str] = (), prune: bool = True) -> DataFrame:
    """W2 + W3: ROC points in descending score order, with the library's
    drop of collinear points (keep first, last, and any point whose
    successor's step differs), and the (0, 0, +inf) origin prepended.
    Columns: by, pt (0 for the origin), threshold, fps, tps, fpr, tpr."""
    p = _with_totals(points, by)
    if prune:
        nxt = points.select(*by, (F.col("pt") - 1).alias("pt"), F.col("pos").alias("npos"),
                            F.col("neg").alias("nneg"))
        p = p.join(nxt, [*by, "pt"], "left")
        keep = ((F.col("pt") == 1) | (F.col("pt") == F.col("m"))
                | (F.col("npos") != F.col("pos")) | (F.col("nneg") != F.col("neg")))
        p = p.filter(keep)
    pts = p.select(*by, "pt", F.col("score").alias("threshold"), "fps", "tps", "P", "N")
    origin_src = _totals(points, by)
    origin = origin_src.select(*by, F.lit(0).cast("long").alias("pt"),
                               F.lit(float("inf")).alias("threshold"),
                               F.lit(0).cast("long").alias("fps"), F.lit(0).cast("long").alias("tps"),
                               "P", "N")
    allp = pts.unionByName(origin)
    return allp.select(*by, "pt", "threshold", "fps", "tps",
                       F.when(F.col("N") > 0, F.col("fps") / F.col("N")).alias("fpr"),
                       F.when(F.col("P") > 0, F.col("tps") / F.col("P")).alias("tpr"))


def recall_at_fpr(points: DataFrame, target_fpr: float = 0.02, by: Sequence[str] = (),
                  prune: bool = True) -> DataFrame:
    """(recall, threshold) at the last ROC point whose FPR <= target,
    i.e. the lowest cut that keeps FPR within the cap (trap 1). With no
    negatives FPR is undefined and the result is (0.0, 1.0)."""
    roc = roc_points(points, by, prune)
    valid = roc.filter(F.col("fpr") <= F.lit(float(target_fpr)))
    aggs = [F.max_by(F.struct("tpr", "threshold"), "pt").alias("best")]
    best = valid.groupBy(*by).agg(*aggs) if by else valid.agg(*aggs)
    best = best.select(*by, F.col("best.tpr").alias("recall"), F.col("best.threshold").alias("threshold"))
    if by:
        groups = points.select(*by).distinct()
        best = groups.join(best, list(by), "left")
    return best.select(*by, F.lit(float(target_fpr)).alias("target_fpr"),
                       F.coalesce(F.col("recall"), F.lit(0.0)).alias("recall"),
                       F.coalesce(F.col("threshold"), F.lit(1.0)).alias("threshold"))
