"""Score calibration.

Each method maps evaluation scores with a model fitted on calibration
scores; results are tagged with a ``method`` column so every method feeds
one sweep (U2) instead of a driver loop over methods.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutpoint.operators import isotonic

METHODS = ("none", "platt", "isotonic")


def require_both_classes(cal: DataFrame, label: str = "label") -> None:
    """G15."""
    classes = sorted(r[0] for r in cal.select(label).distinct().limit(3).collect())
    if len(classes) < 2:
        raise ValueError(f"calibration labels hold one class only: {classes}")


def calibrate_none(ev: DataFrame, score: str = "score") -> DataFrame:
    """M4."""
    return ev.withColumn(score, F.col(score).cast("double"))


def fit_platt(cal: DataFrame, score: str = "score", label: str = "label", max_iter: int = 2000,
              weight: str | None = None):
    """M5: unweighted logistic regression on the score, C = 1.0, so
    regParam = 1 / n with no standardisation. On a (score, label, count)
    histogram (``weight``) the objective is the same sum over rows."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    data = cal.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label),
                      w.alias("__pw"))
    n = data.agg(F.sum("__pw")).first()[0]
    va = VectorAssembler(inputCols=[score], outputCol="__pf")
    lr = LogisticRegression(featuresCol="__pf", labelCol=label, weightCol="__pw", regParam=1.0 / float(n),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-9)
    model = lr.fit(va.transform(data))
    return va, model


def platt(fitted, score: Column) -> Column:
    """The fitted probability as an expression."""
    _, model = fitted
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(float(model.intercept)) + F.lit(float(model.coefficients[0])) * score)))


def apply_platt(fitted, ev: DataFrame, score: str = "score") -> DataFrame:
    return ev.select(*[c for c in ev.columns if c != score], platt(fitted, F.col(score).cast("double")).alias(score))


def fit_isotonic(cal: DataFrame, score: str = "score", label: str = "label", weight: str | None = None) -> DataFrame:
    """M6: increasing isotonic fit as a table of segments (see ``isotonic``)."""
    return isotonic.fit(cal, score, label, weight)


def apply_isotonic(fitted: DataFrame, ev: DataFrame, score: str = "score") -> DataFrame:
    """Linear interpolation between fitted points, clipped outside their range."""
    return isotonic.apply(fitted, ev, score)


def calibrated_union(cal: DataFrame, ev: DataFrame, methods=METHODS, score: str = "score",
                     label: str = "label", weight: str | None = None) -> DataFrame:
    """Evaluation rows (or histogram rows) once per method, scores mapped by that method. One
    read of the rows: every method's score is a column of the row (the isotonic one looked up in
    its segments), and one ``inline`` makes the rows."""
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"no such calibration method: {sorted(unknown)}")
    if any(m != "none" for m in methods):
        require_both_classes(cal, label)
    raw = F.col(score).cast("double")
    rows, found = ev, {"none": raw}
    if "platt" in methods:
        found["platt"] = platt(fit_platt(cal, score, label, weight=weight), raw)
    if "isotonic" in methods:
        rows = apply_isotonic(fit_isotonic(cal, score, label, weight=weight), ev.withColumn("__iso", raw), "__iso")
        found["isotonic"] = F.col("__iso")
    each = [F.struct(found[m].alias(score), F.lit(m).alias("method"), F.lit(i).alias("method_no"))
            for i, m in enumerate(methods, 1)]
    return rows.select(*[c for c in ev.columns if c != score], F.inline(F.array(*each)))
