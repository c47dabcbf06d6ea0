"""Monitoring of scored output.

Everything is an aggregate with map-side combine or an operator from
``prefix``; the daily alert compares each day with the previous calendar
day through an equi-join on day - 1 (no unpartitioned window).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions.bands import APPROVE, DECLINE, REVIEW
from cutpoint.operators import brackets
from cutpoint.operators.policy import ratio
from cutpoint.operators.prefix import AUTO, exact_quantiles, reuse, running_total

PSI_EPS = 1e-8
# Fixed drift-label cut points.
PSI_LOW, PSI_MODERATE = 0.1, 0.25
# Fixed alert rules.
REVIEW_ALERT_RATE = 0.12
CAPTURE_ALERT_MIN = 0.93
DECLINE_FPR_ALERT_MAX = 0.022


def _agg(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def decision_mix(scored: DataFrame, by: Sequence[str] = (), decision: str = "decision") -> DataFrame:
    """Counts and rates of the three decisions over all rows; other
    labels count in the total but in no rate (trap 8)."""
    d = F.col(decision)
    g = _agg(scored, by, F.count(F.lit(1)).alias("rows"),
             F.count_if(d == APPROVE).alias("approve_count"),
             F.count_if(d == REVIEW).alias("review_count"),
             F.count_if(d == DECLINE).alias("decline_count"))
    empty = F.raise_error(F.lit("empty input: there are no scored rows"))
    return g.select(*by, "rows", "approve_count", "review_count", "decline_count",
                    F.when(F.col("rows") > 0, ratio(F.col("approve_count"), F.col("rows")))
                    .otherwise(empty).alias("approve_rate"),
                    ratio(F.col("review_count"), F.col("rows")).alias("review_rate"),
                    ratio(F.col("decline_count"), F.col("rows")).alias("decline_rate"))


def score_stats(scored: DataFrame, score: str = "score", qs: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    """Mean and exact interpolated percentiles, one row."""
    # Two scans: sketch, mean and count, then exact ranks inside brackets.
    names = {f"p{int(round(q * 100))}_score": float(q) for q in qs}
    out = brackets.summary(scored, score, names, {"rows": F.count(F.lit(1)), "mean_score": F.avg(F.col(score).cast("double"))})
    empty = F.raise_error(F.lit("empty input: there are no scored rows"))
    return out.withColumn("rows", F.when(F.col("rows") > 0, F.col("rows")).otherwise(empty))


def label_quality(scored: DataFrame, by: Sequence[str] = (), decision: str = "decision",
                  label: str = "label") -> DataFrame:
    """Flagged / decline capture, decline FPR, review and decline precision."""
    d, y = F.col(decision), F.col(label)
    pos, neg = y == 1, y == 0
    flagged = d.isin(REVIEW, DECLINE)
    g = _agg(scored, by,
             F.count_if(pos).alias("fraud_total"), F.count_if(neg).alias("nonfraud_total"),
             F.count_if(pos & flagged).alias("fraud_flagged"),
             F.count_if(pos & (d == DECLINE)).alias("fraud_declined"),
             F.count_if(neg & (d == DECLINE)).alias("nonfraud_declined"),
             F.count_if(d == REVIEW).alias("review_count"),
             F.count_if(d == DECLINE).alias("decline_count"))
    c = F.col
    return g.select(*by, "fraud_total",
                    ratio(c("fraud_flagged"), c("fraud_total")).alias("flagged_capture"),
                    ratio(c("fraud_declined"), c("fraud_total")).alias("decline_capture"),
                    ratio(c("nonfraud_declined"), c("nonfraud_total")).alias("decline_fpr"),
                    ratio(c("fraud_flagged") - c("fraud_declined"), c("review_count")).alias("review_precision"),
                    ratio(c("fraud_declined"), c("decline_count")).alias("decline_precision"))


def psi_quantiles(bins: int) -> list[float]:
    """Quantile fractions exactly as numpy's linspace produces them (trap 7)."""
    return [float(x) for x in np.linspace(0.0, 1.0, bins + 1)]


def split_histogram(split_df: DataFrame, ref_label: str, cur_label: str, split_col: str = "split",
                    score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(by, pop, score, n) from one pass over a labelled split."""
    pop = (F.when(F.col(split_col) == ref_label, F.lit("ref"))
            .when(F.col(split_col) == cur_label, F.lit("cur")))
    return reuse(split_df.select(*by, pop.alias("pop"), F.col(score).cast("double").alias("score"))
                 .filter(F.col("pop").isNotNull()).groupBy(*by, "pop", "score")
                 .agg(F.count(F.lit(1)).alias("n")))


def psi_by(h0: DataFrame, by: Sequence[str], bins: int = 10, buckets: int | None = AUTO) -> DataFrame:
    """G9 + P18 per group from a (by, pop, score, n) histogram. Each group's
    edges are its own reference quantiles; they travel as an array column
    joined on the group keys (no per-group driver work), and every group
    keeps all ``bins`` bins (empty ones at 1e-8)."""
    qs = psi_quantiles(bins)
    inner = [float(q) for q in qs[1:-1]]
    quant = exact_quantiles(h0.filter(F.col("pop") == "ref"), "score", qs, by=by, buckets=buckets, weight="n")
    edges = (quant.filter(F.col("q").isin(inner)).groupBy(*by)
             .agg(F.array_sort(F.collect_list(F.struct("q", "value"))).alias("e"))
             .select(*by, F.transform("e", lambda x: x["value"]).alias("edges")))
    s = F.col("score")
    zero = F.lit(0).cast("long")
    binned = (h0.join(edges, list(by))
              .select(*by, "pop", F.size(F.filter("edges", lambda e: e <= s)).alias("bin"), "n")
              .groupBy(*by, "bin")
              .agg(F.sum(F.when(F.col("pop") == "ref", F.col("n")).otherwise(zero)).alias("ref_n"),
                   F.sum(F.when(F.col("pop") == "cur", F.col("n")).otherwise(zero)).alias("cur_n")))
    grid = edges.select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    h = grid.join(binned, [*by, "bin"], "left").na.fill(0, ["ref_n", "cur_n"])
    w = Window.partitionBy(*by)                       # bins rows per group
    rt = F.greatest(F.sum("ref_n").over(w), F.lit(1)).cast("double")
    ct = F.greatest(F.sum("cur_n").over(w), F.lit(1)).cast("double")
    rp = F.greatest(F.lit(PSI_EPS), F.least(F.lit(1.0), F.col("ref_n") / rt))
    cp = F.greatest(F.lit(PSI_EPS), F.least(F.lit(1.0), F.col("cur_n") / ct))
    terms = h.select(*by, ((cp - rp) * F.ln(cp / rp)).alias("t"))
    return terms.groupBy(*by).agg(F.sum("t").alias("psi")) \
        .select(*by, "psi", drift_level(F.col("psi")).alias("drift_level"))


def populations(reference: DataFrame, current: DataFrame, score: str = "score") -> DataFrame:
    """(pop, score): the rows of both populations; every drift measure below reads only this."""
    s = F.col(score).cast("double").alias("score")
    return (reference.select(F.lit("ref").alias("pop"), s).unionByName(current.select(F.lit("cur").alias("pop"), s)))


def split_populations(split_df: DataFrame, ref_label: str, cur_label: str, split_col: str = "split",
                      score: str = "score") -> DataFrame:
    """(pop, score) of a labelled split."""
    pop = F.when(F.col(split_col) == ref_label, F.lit("ref")).when(F.col(split_col) == cur_label, F.lit("cur"))
    return split_df.select(pop.alias("pop"), F.col(score).cast("double").alias("score")).filter(F.col("pop").isNotNull())


def psi(reference: DataFrame, current: DataFrame, score: str = "score", bins: int = 10) -> DataFrame:
    return psi_of(populations(reference, current, score), bins)


def psi_of(rows: DataFrame, bins: int = 10) -> DataFrame:
    """G9 + P18: population stability index of ``current`` against quantile bins of
    ``reference``; outer edges open; empty bins count at 1e-8. ``rows`` is (pop in {ref, cur},
    score). Edges are exact quantiles, found and counted in two scans (``brackets``). A value
    goes to bin count(edges[:-1] <= x) - 1, so tied edges leave empty bins exactly as
    numpy's histogram does.
    """
    h = brackets.psi_bins(rows, "pop", psi_quantiles(bins))
    all_ = Window.partitionBy()                           # `bins` rows

    def pct(c: str) -> Column:
        total = F.greatest(F.sum(c).over(all_), F.lit(1)).cast("double")
        return F.greatest(F.lit(PSI_EPS), F.least(F.lit(1.0), F.col(c) / total))

    terms = h.select(pct("ref_n").alias("r"), pct("cur_n").alias("c"))
    value = terms.agg(F.sum((F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r"))).alias("psi"))
    return value.select("psi", drift_level(F.col("psi")).alias("drift_level"))


def drift_level(p: Column) -> Column:
    """P18."""
    return (F.when(p < PSI_LOW, "low").when(p < PSI_MODERATE, "moderate").otherwise("high"))


def ks_drift(reference: DataFrame, current: DataFrame, score: str = "score") -> DataFrame:
    """Two-sample KS statistic max |F_ref(x) - F_cur(x)|, refined only where it can be."""
    return brackets.ks(populations(reference, current, score), "pop")


def ks_by(h0: DataFrame, by: Sequence[str], buckets: int | None = AUTO) -> DataFrame:
    """D5 per group from a (by, pop, score, n) histogram."""
    zero = F.lit(0).cast("long")
    pts = h0.groupBy(*by, "score").agg(
        F.sum(F.when(F.col("pop") == "ref", F.col("n")).otherwise(zero)).alias("r"),
        F.sum(F.when(F.col("pop") == "cur", F.col("n")).otherwise(zero)).alias("c"))
    sizes = pts.groupBy(*by).agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    cum = running_total(pts, "score", ["r", "c"], by=by, buckets=buckets).join(sizes, list(by))
    gap = F.abs(F.col("cum_r") / F.greatest(F.col("nr"), F.lit(1)) - F.col("cum_c") / F.greatest(F.col("nc"), F.lit(1)))
    return cum.groupBy(*by).agg(F.max(gap).alias("ks_stat"), F.first("nr").alias("reference_rows"),
                                F.first("nc").alias("current_rows"))


def daily_mix(scored: DataFrame, ts: str = "ts", decision: str = "decision",
              label: str = "label") -> DataFrame:
    """Per calendar day, the decision mix and label-aware quality, from
    one aggregation (map-side combine; one row per day out)."""
    d, y = F.col(decision), F.col(label)
    pos, neg = y == 1, y == 0
    g = scored.groupBy(F.date_format(F.to_date(F.col(ts)), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(d == APPROVE).alias("approve_count"),
        F.count_if(d == REVIEW).alias("review_count"),
        F.count_if(d == DECLINE).alias("decline_count"),
        F.count_if(pos).alias("fraud_total"), F.count_if(neg).alias("nonfraud_total"),
        F.count_if(pos & d.isin(REVIEW, DECLINE)).alias("fraud_flagged"),
        F.count_if(neg & (d == DECLINE)).alias("nonfraud_declined"))
    c = F.col
    return g.select("day", "rows", "approve_count", "review_count", "decline_count",
                    ratio(c("approve_count"), c("rows")).alias("approve_rate"),
                    ratio(c("review_count"), c("rows")).alias("review_rate"),
                    ratio(c("decline_count"), c("rows")).alias("decline_rate"),
                    "fraud_total",
                    ratio(c("fraud_flagged"), c("fraud_total")).alias("flagged_capture"),
                    ratio(c("nonfraud_declined"), c("nonfraud_total")).alias("decline_fpr"))


def review_alerts(daily: DataFrame, review_rate: float = REVIEW_ALERT_RATE,
                  capture_min: float = CAPTURE_ALERT_MIN,
                  fpr_max: float = DECLINE_FPR_ALERT_MAX) -> DataFrame:
    """D6 alerts: review rate above the cap on this day and on the previous
    calendar day (a missing day breaks the run); capture and FPR alerts per
    day. The previous day comes from a window over the daily table: one scan."""
    w = Window.orderBy("day")       # one row per calendar day: its size follows the calendar, not the rows
    over = F.col("review_rate") > F.lit(float(review_rate))
    next_day = F.date_format(F.date_add(F.to_date(F.lag("day").over(w)), 1), "yyyy-MM-dd")
    prev_over = F.coalesce((next_day == F.col("day")) & F.lag(over).over(w), F.lit(False))
    return daily.select("day", "review_rate",
                    (over & prev_over).alias("review_alert"),
                    (F.col("flagged_capture") < F.lit(float(capture_min))).alias("capture_alert"),
                    (F.col("decline_fpr") > F.lit(float(fpr_max))).alias("fpr_alert"))


def review_runs(daily: DataFrame, review_rate: float = REVIEW_ALERT_RATE) -> DataFrame:
    """D6 on event time: session windows merge the consecutive days whose review rate is above
    the cap into runs: ``run_start, run_end, days, rows, review_count, peak_rate``. A day opens a
    session of a day and a half, so the next day joins it and a missing day ends it. Works
    on the daily table of a batch; on a stream of days it needs a watermark on ``day``."""
    over = daily.where(F.col("review_rate") > F.lit(float(review_rate)))
    run = over.withColumn("__at", F.to_timestamp_ltz(F.concat("day", F.lit(" 00:00:00+00:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX")))
    g = run.groupBy(F.session_window("__at", "36 hours")).agg(
        F.min("day").alias("run_start"), F.max("day").alias("run_end"), F.count(F.lit(1)).alias("days"),
        F.sum("rows").alias("rows"), F.sum("review_count").alias("review_count"), F.max("review_rate").alias("peak_rate"))
    return g.drop("session_window")


def band_capture(scored: DataFrame, decision: str = "decision", label: str = "label") -> DataFrame:
    """Rows, fraud and the share of all fraud per decision band."""
    g = scored.groupBy(F.col(decision).alias("band")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("fraud"))
    total = F.sum("fraud").over(Window.partitionBy())       # over the bands, three rows
    return g.select("band", "rows", "fraud", ratio(F.col("fraud"), total).alias("fraud_share"))


def duration_percentiles(df: DataFrame, value: str, by: Sequence[str] = (),
                         qs: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """G16 re-aimed: count, mean, exact P50/P95/P99 and rows per second per key, the values
    being milliseconds. Two scans (``brackets``)."""
    v = F.col(value).cast("double")
    total = F.sum(v)
    extra = {"n": F.count(F.lit(1)), "mean": total / F.count(F.lit(1)),
             "rows_per_sec": F.when(total > 0, F.count(F.lit(1)) * 1000.0 / total)}
    return brackets.summary(df, value, {f"p{int(round(q * 100))}": float(q) for q in qs}, extra, by)
