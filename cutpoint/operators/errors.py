"""Error analysis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutpoint.operators.policy import ratio


def confusion(scored: DataFrame, threshold, by: Sequence[str] = (), score: str = "score",
              label: str = "label") -> DataFrame:
    """G1 + G2: tn/fp/fn/tp at ``score >= threshold`` (labels fixed to 0/1),
    then recall, precision and realised FPR (0.0 on a zero denominator)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score).cast("double") >= t
    y = F.col(label)
    aggs = [F.count_if((y == 0) & ~pred).alias("tn"), F.count_if((y == 0) & pred).alias("fp"),
            F.count_if((y == 1) & ~pred).alias("fn"), F.count_if((y == 1) & pred).alias("tp")]
    g = scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)
    c = F.col
    return g.select(*by, "tn", "fp", "fn", "tp",
                    ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
                    ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
                    ratio(c("fp"), c("fp") + c("tn")).alias("fpr"))


def confusion_from_points(points: DataFrame, threshold, by: Sequence[str] = ()) -> DataFrame:
    """G1 + G2 read off a distinct-score table (score, pos, neg), e.g. the
    one ``curves.score_points`` already built: no second pass over rows."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col("score") >= t
    z = F.lit(0).cast("long")
    aggs = [F.sum(F.when(~pred, F.col("neg")).otherwise(z)).alias("tn"),
            F.sum(F.when(pred, F.col("neg")).otherwise(z)).alias("fp"),
            F.sum(F.when(~pred, F.col("pos")).otherwise(z)).alias("fn"),
            F.sum(F.when(pred, F.col("pos")).otherwise(z)).alias("tp")]
    g = points.groupBy(*by).agg(*aggs) if by else points.agg(*aggs)
    c = F.col
    return g.select(*by, "tn", "fp", "fn", "tp",
                    ratio(c("tp"), c("tp") + c("fn")).alias("recall"),
                    ratio(c("tp"), c("tp") + c("fp")).alias("precision"),
                    ratio(c("fp"), c("fp") + c("tn")).alias("fpr"))


def top_errors(scored: DataFrame, threshold: float, top_n: int, keep: Sequence[str],
               tiebreak: Sequence[str], score: str = "score", label: str = "label") -> DataFrame:
    """O8 + U1: the top_n false positives by score desc and the top_n false
    negatives by score asc at ``score >= threshold``, tagged ``error_type``.
    Each side is an ordered limit (per-partition top-n, one merge); ties
    break on the row key, not on arrival order."""
    s = F.col(score).cast("double")
    pred = (s >= F.lit(float(threshold))).cast("int")
    base = scored.select(*keep, s.alias("score"), F.col(label).alias("label"),
                         pred.alias("predicted_class"))
    tb = [F.col(c).asc() for c in tiebreak]
    fp = (base.filter((F.col("label") == 0) & (F.col("predicted_class") == 1))
          .orderBy(F.col("score").desc(), *tb).limit(int(top_n))
          .withColumn("error_type", F.lit("false_positive")))
    fn = (base.filter((F.col("label") == 1) & (F.col("predicted_class") == 0))
          .orderBy(F.col("score").asc(), *tb).limit(int(top_n))
          .withColumn("error_type", F.lit("false_negative")))
    return fp.unionByName(fn)


def export_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    return df.select(*[c for c in wanted if c in df.columns])
