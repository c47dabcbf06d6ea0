"""Policy evaluation (G3, G4) and the threshold sweep.

One pair is a single global aggregate of ``count_if`` terms with map-side
combine. Many pairs never join rows to pairs: every threshold of every pair
becomes a cut, each row is bucketed once by the number of cuts <= score
(binary search in ``Bucketizer``), the (bucket, label) histogram has at most
``2 * (cuts + 1)`` rows per group, and each pair reads two cumulative
histogram entries. One scan of the rows, whatever the number of pairs; exact,
because the bucket rule uses the same ``>=`` as the bands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions.bands import _c, guarded, is_bad
from cutpoint.operators.prefix import reuse

COUNT_COLS = ("total", "fraud_total", "nonfraud_total", "approve_count", "review_count",
              "decline_count", "fraud_approve", "fraud_review", "fraud_decline",
              "nonfraud_decline")


def ratio(num: Column, den: Column) -> Column:
    """G2 division rule: 0.0 when the denominator is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def band_count_aggs(score: Column, label: Column, t1: Column, t2: Column) -> list[Column]:
    appr = score < t1
    rev = (score >= t1) & (score < t2)
    dec = score >= t2
    pos, neg = label == 1, label == 0
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(pos).alias("fraud_total"),
        F.count_if(neg).alias("nonfraud_total"),
        F.count_if(appr).alias("approve_count"),
        F.count_if(rev).alias("review_count"),
        F.count_if(dec).alias("decline_count"),
        F.count_if(pos & appr).alias("fraud_approve"),
        F.count_if(pos & rev).alias("fraud_review"),
        F.count_if(pos & dec).alias("fraud_decline"),
        F.count_if(neg & dec).alias("nonfraud_decline"),
        F.count_if(is_bad(score)).alias("bad_scores"),
    ]


POLICY_METRICS = ("approve_threshold", "decline_threshold", "approve_count", "review_count",
                  "decline_count", "approve_rate", "review_rate", "decline_rate", "flagged_rate",
                  "fraud_total", "fraud_approve", "fraud_review", "fraud_decline",
                  "fraud_capture_decline", "fraud_capture_flagged", "decline_fpr",
                  "review_precision", "decline_precision")

COST_METRICS = ("approve_threshold", "decline_threshold", "approve_count", "review_count",
                "decline_count", "approve_rate", "review_rate", "decline_rate", "fraud_total",
                "fraud_approve", "fraud_review", "fraud_decline", "flagged_fraud_capture",
                "decline_fpr", "total_cost", "cost_per_row")


def nonempty(total: Column, value: Column) -> Column:
    """Trap 6: a global aggregate over no rows still returns a row; the
    reference refuses empty input, so that row fails when it is read."""
    return F.when(total > 0, value).otherwise(F.raise_error(F.lit("empty input: there are no rows to evaluate")))


def policy_metrics(counts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """G3 metrics from base counts (+ approve/decline threshold columns)."""
    c = F.col
    return counts.select(
        *keep,
        c("approve_threshold"), c("decline_threshold"),
        c("approve_count"), c("review_count"), c("decline_count"),
        nonempty(c("total"), ratio(c("approve_count"), c("total"))).alias("approve_rate"),
        ratio(c("review_count"), c("total")).alias("review_rate"),
        ratio(c("decline_count"), c("total")).alias("decline_rate"),
        ratio(c("review_count") + c("decline_count"), c("total")).alias("flagged_rate"),
        c("fraud_total"), c("fraud_approve"), c("fraud_review"), c("fraud_decline"),
        ratio(c("fraud_decline"), c("fraud_total")).alias("fraud_capture_decline"),
        ratio(c("fraud_review") + c("fraud_decline"), c("fraud_total")).alias("fraud_capture_flagged"),
        ratio(c("nonfraud_decline"), c("nonfraud_total")).alias("decline_fpr"),
        ratio(c("fraud_review"), c("review_count")).alias("review_precision"),
        ratio(c("fraud_decline"), c("decline_count")).alias("decline_precision"),
    )


def cost_metrics(counts: DataFrame, c_fn: float, c_fd: float, c_rev: float,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Every review is charged, fraud or not."""
    c = F.col
    cost = (c("fraud_approve").cast("double") * F.lit(float(c_fn))
            + c("nonfraud_decline").cast("double") * F.lit(float(c_fd))
            + c("review_count").cast("double") * F.lit(float(c_rev)))
    return counts.select(
        *keep,
        c("approve_threshold"), c("decline_threshold"),
        c("approve_count"), c("review_count"), c("decline_count"),
        nonempty(c("total"), ratio(c("approve_count"), c("total"))).alias("approve_rate"),
        ratio(c("review_count"), c("total")).alias("review_rate"),
        ratio(c("decline_count"), c("total")).alias("decline_rate"),
        c("fraud_total"), c("fraud_approve"), c("fraud_review"), c("fraud_decline"),
        ratio(c("fraud_review") + c("fraud_decline"), c("fraud_total")).alias("flagged_fraud_capture"),
        ratio(c("nonfraud_decline"), c("nonfraud_total")).alias("decline_fpr"),
        cost.alias("total_cost"),
        ratio(cost, c("total")).alias("cost_per_row"),
    )


def policy_counts(scored: DataFrame, t1, t2, by: Sequence[str] = (),
                  score: str = "score", label: str = "label") -> DataFrame:
    """Base counts of one policy. ``t1``/``t2`` are numbers, or per-row
    columns (then the output threshold columns are null: they vary by row)."""
    t1c, t2c = _c(t1), _c(t2)
    aggs = band_count_aggs(F.col(score).cast("double"), F.col(label), t1c, t2c)
    grouped = scored.groupBy(*by) if by else scored
    out = grouped.agg(*aggs) if by else scored.agg(*aggs)
    def shown(t) -> Column:
        return F.lit(None).cast("double") if isinstance(t, Column) else F.lit(float(t))
    return out.select(*by, shown(t1).alias("approve_threshold"), shown(t2).alias("decline_threshold"),
                      guarded(F.col("total"), F.col("bad_scores")).alias("total"), *COUNT_COLS[1:])


def evaluate_policy(scored: DataFrame, t1: float, t2: float, by: Sequence[str] = (),
                    score: str = "score", label: str = "label") -> DataFrame:
    """One row (per group) of 18 metrics."""
    from cutpoint.functions.bands import check_thresholds
    check_thresholds(t1, t2)
    return policy_metrics(policy_counts(scored, t1, t2, by, score, label), keep=by)


def evaluate_policy_cost(scored: DataFrame, t1: float, t2: float, c_fn: float, c_fd: float,
                         c_rev: float, by: Sequence[str] = (), score: str = "score",
                         label: str = "label") -> DataFrame:
    """One row (per group) of 16 metrics including cost."""
    from cutpoint.functions.bands import check_thresholds
    check_thresholds(t1, t2)
    return cost_metrics(policy_counts(scored, t1, t2, by, score, label), c_fn, c_fd, c_rev, keep=by)


# ---------------------------------------------------------------- sweep

def pair_cuts(pairs: DataFrame) -> list[float]:
    """Sorted distinct thresholds of a pair table (their number follows the grid
    parameters, never the rows). A table without pairs is an error."""
    rows = (pairs.select(F.explode(F.array("t1", "t2")).alias("c")).distinct()
            .orderBy("c").collect())
    cuts = [float(r["c"]) for r in rows]
    if not cuts:
        raise ValueError("the pair table has no pair with approve < decline threshold")
    return cuts


def bucket_by_cuts(df: DataFrame, col: str, cuts: Sequence[float], out: str) -> DataFrame:
    """``out`` = number of cuts <= col (binary search, JVM side)."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    tmp = f"__{out}_d"
    bz = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol=col, outputCol=tmp,
                    handleInvalid="keep")
    # Non-null by construction (-1 for a null score, which matches no bucket), so
    # joins on it infer no extra filter that would evaluate the score twice.
    return bz.transform(df.withColumn(col, F.col(col).cast("double"))) \
             .withColumn(out, F.coalesce(F.col(tmp).cast("int"), F.lit(-1))).drop(tmp)


def cumulative_histogram(scored: DataFrame, cuts: Sequence[float], by: Sequence[str] = (),
                         score: str = "score", label: str = "label",
                         weight: str | None = None) -> DataFrame:
    """Per group and bucket b in 0..m: rows/positives/negatives with bucket <= b,
    plus group totals. Dense in b, so any cut index can be looked up.
    ``weight`` names a row-count column when ``scored`` is already a
    (score, label, count) histogram."""
    spark = scored.sparkSession
    m = len(cuts)
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    base = bucket_by_cuts(scored.select(*by, score, label, w.alias("__wt")), score, cuts, "b")
    zero = F.lit(0).cast("long")
    # Null (-1) and NaN (the extra bucket) scores are counted, not lost: they go to
    # bucket 0 with a count of their own, which fails the totals below.
    bad = (F.col("b") < 0) | (F.col("b") > m)
    base = base.withColumn("__bad", F.when(bad, F.col("__wt")).otherwise(zero)).withColumn("b", F.when(bad, 0).otherwise(F.col("b")))
    hist = base.groupBy(*by, "b").agg(
        F.sum("__bad").alias("h_bad"),
        F.sum("__wt").alias("h_n"),
        F.sum(F.when(F.col(label) == 1, F.col("__wt")).otherwise(zero)).alias("h_pos"),
        F.sum(F.when(F.col(label) == 0, F.col("__wt")).otherwise(zero)).alias("h_neg"))
    if by:
        grid = hist.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(0), F.lit(m))).alias("b"))
    else:
        grid = spark.range(0, m + 1).select(F.col("id").cast("int").alias("b"))
    dense = grid.join(hist, [*by, "b"], "left").na.fill(0, ["h_n", "h_pos", "h_neg", "h_bad"])
    w = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wall = Window.partitionBy(*by)
    return dense.select(
        *by, "b",
        F.sum("h_n").over(w).alias("cum_n"), F.sum("h_pos").over(w).alias("cum_pos"),
        F.sum("h_neg").over(w).alias("cum_neg"),
        guarded(F.sum("h_n").over(wall), F.sum("h_bad").over(wall)).alias("tot_n"), F.sum("h_pos").over(wall).alias("tot_pos"),
        F.sum("h_neg").over(wall).alias("tot_neg"))


def sweep_counts(scored: DataFrame, pairs: DataFrame, by: Sequence[str] = (),
                 score: str = "score", label: str = "label", weight: str | None = None) -> DataFrame:
    """Base counts for every (group, pair) from one pass over ``scored``.

    ``pairs`` has columns (pair_no, t1, t2). Output: group columns, pair_no,
    approve_threshold, decline_threshold and COUNT_COLS.
    """
    cuts = pair_cuts(pairs)
    # Read at two cut indices: persist the small table (groups x (cuts + 1)
    # rows) so the rows are scanned once, not once per join side.
    cum = reuse(cumulative_histogram(scored, cuts, by, score, label, weight))
    # score < c_k  <=>  bucket <= k - 1, so a threshold reads the entry at k - 1.
    ids = scored.sparkSession.createDataFrame([(c, k) for k, c in enumerate(cuts)], "cut double, k int")
    pk = (pairs.select("pair_no", F.col("t1").cast("double").alias("approve_threshold"),
                       F.col("t2").cast("double").alias("decline_threshold"))
          .join(ids.select(F.col("cut").alias("approve_threshold"), F.col("k").alias("b1")), "approve_threshold")
          .join(ids.select(F.col("cut").alias("decline_threshold"), F.col("k").alias("b2")), "decline_threshold"))
    lo = cum.select(*by, F.col("b").alias("b1"), F.col("cum_n").alias("lo_n"),
                    F.col("cum_pos").alias("lo_pos"), F.col("cum_neg").alias("lo_neg"),
                    "tot_n", "tot_pos", "tot_neg")
    hi = cum.select(*by, F.col("b").alias("b2"), F.col("cum_n").alias("hi_n"),
                    F.col("cum_pos").alias("hi_pos"), F.col("cum_neg").alias("hi_neg"))
    j = lo.join(pk, "b1").join(hi, [*by, "b2"])
    c = F.col
    return j.select(
        *by, "pair_no", "approve_threshold", "decline_threshold",
        c("tot_n").alias("total"), c("tot_pos").alias("fraud_total"),
        c("tot_neg").alias("nonfraud_total"),
        c("lo_n").alias("approve_count"), (c("hi_n") - c("lo_n")).alias("review_count"),
        (c("tot_n") - c("hi_n")).alias("decline_count"),
        c("lo_pos").alias("fraud_approve"), (c("hi_pos") - c("lo_pos")).alias("fraud_review"),
        (c("tot_pos") - c("hi_pos")).alias("fraud_decline"),
        (c("tot_neg") - c("hi_neg")).alias("nonfraud_decline"))


def policy_id(pair_no: Column, t1: Column, t2: Column) -> Column:
    """policy_{idx:02d}_t1_{t1:.4f}_t2_{t2:.4f}."""
    return F.format_string("policy_%02d_t1_%.4f_t2_%.4f", pair_no, t1, t2)


def evaluate_threshold_pairs(scored: DataFrame, pairs: DataFrame, by: Sequence[str] = (),
                             score: str = "score", label: str = "label",
                             weight: str | None = None) -> DataFrame:
    """G5 (simulation rule): G3 metrics per pair, policy_id, rank by O2."""
    counts = sweep_counts(scored, pairs, by, score, label, weight)
    m = policy_metrics(counts.withColumn("policy_id", policy_id(F.col("pair_no"), F.col("approve_threshold"),
                                                                F.col("decline_threshold"))),
                       keep=[*by, "pair_no", "policy_id"])
    w = Window.partitionBy(*by).orderBy(
        F.col("fraud_capture_flagged").desc(), F.col("decline_precision").desc(),
        F.col("review_rate").asc(), F.col("decline_fpr").asc(), F.col("pair_no").asc())
    return m.withColumn("rank", F.row_number().over(w))


def search_best_policy(scored: DataFrame, pairs: DataFrame, c_fn: float, c_fd: float,
                       c_rev: float, by: Sequence[str] = (), score: str = "score",
                       label: str = "label", weight: str | None = None) -> DataFrame:
    """G5 (cost rule): G4 metrics per pair, rank by O3."""
    counts = sweep_counts(scored, pairs, by, score, label, weight)
    m = cost_metrics(counts, c_fn, c_fd, c_rev, keep=[*by, "pair_no"])
    w = Window.partitionBy(*by).orderBy(
        F.col("total_cost").asc(), F.col("flagged_fraud_capture").desc(),
        F.col("review_rate").asc(), F.col("decline_fpr").asc(), F.col("pair_no").asc())
    return m.withColumn("rank", F.row_number().over(w))


def score_label_histogram(scored: DataFrame, by: Sequence[str] = (), score: str = "score",
                          label: str = "label") -> DataFrame:
    """(by, score, label, n): rows reduced to distinct (score, label) with
    counts. Every sweep, calibration and drift step can run on this table
    (``weight="n"``), so work after it grows with distinct scores, not rows."""
    return reuse(scored.groupBy(*by, F.col(score).cast("double").alias(score), label)
                 .agg(F.count(F.lit(1)).alias("n")))
