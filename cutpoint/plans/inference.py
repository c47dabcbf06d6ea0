"""Batch inference with policy profiles.

``run_inference`` is one lazy plan: typed scan -> contract -> score ->
thresholds resolved per row from a profile table (broadcast: one row per
profile) -> bands. It accepts a streaming DataFrame unchanged (the join is a
stream-static join), so the same code serves batch and streams.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutpoint.functions import bands
from cutpoint.operators import model
from cutpoint.sources import contract
from cutpoint.sources.policy_doc import FALLBACK, PRIMARY

ARTIFACT = "artifact"


def profile_table(spark: SparkSession, docs: DataFrame | None = None,
                  bundle_threshold: float | None = None,
                  extra: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(profile, approve_threshold, decline_threshold) from a parsed policy
    document (S5), plus the ``artifact`` profile resolved from the bundle's
    threshold (P14). Without a document the two week-3 defaults are used. A name
    that several documents define is an error when it is read: a row must find
    one pair of thresholds."""
    if docs is not None:
        named = docs.select(F.explode("doc.profiles").alias("profile", "p")).groupBy("profile").agg(
            F.count(F.lit(1)).alias("n"), F.first("p").alias("p"))
        twice = F.raise_error(F.concat(F.lit("several documents define profile "), F.col("profile")))
        prof = named.select(
            "profile", F.when(F.col("n") > 1, twice).otherwise(F.col("p.approve_threshold")).alias("approve_threshold"),
            F.col("p.decline_threshold").alias("decline_threshold"))
    else:
        rows = [("primary",) + PRIMARY, ("fallback",) + FALLBACK] + \
               [(k, float(a), float(b)) for k, (a, b) in (extra or {}).items()]
        # Columns of one row: unlike rows handed over from Python, they have a size that Spark knows.
        prof = spark.range(1).select(F.inline(F.array(*(
            F.struct(F.lit(n).alias("profile"), F.lit(a).alias("approve_threshold"), F.lit(b).alias("decline_threshold"))
            for n, a, b in rows))))
    t1, t2 = bands.artifact_thresholds(bundle_threshold)
    art = spark.range(1).select(F.lit(ARTIFACT).alias("profile"), t1.alias("approve_threshold"),
                                t2.alias("decline_threshold"))
    return prof.unionByName(art)


def resolve_thresholds(scored: DataFrame, profiles: DataFrame, profile: str | Column,
                       approve_override: float | None = None,
                       decline_override: float | None = None) -> DataFrame:
    """J2 + P15: look up each row's profile (a name, or a column for a
    per-row profile), then let explicit overrides win per side. Unknown
    profiles resolve to null thresholds; ``check_resolved`` rejects them."""
    prof_col = profile if isinstance(profile, Column) else F.lit(profile)
    p = profiles.select(F.col("profile").alias("__profile"), F.col("approve_threshold").alias("__t1"),
                        F.col("decline_threshold").alias("__t2"))
    # One row per profile name; Spark broadcasts it if its size allows.
    j = scored.withColumn("profile", prof_col).join(p, F.col("profile") == F.col("__profile"), "left")
    return (j.withColumn("approve_threshold", bands.with_override(F.col("__t1"), approve_override))
             .withColumn("decline_threshold", bands.with_override(F.col("__t2"), decline_override))
             .drop("__profile", "__t1", "__t2"))


def check_resolved(resolved: DataFrame) -> None:
    """P7 on the final pairs: every row must have valid thresholds."""
    bad = resolved.agg(F.count_if(~F.coalesce(bands.thresholds_valid(F.col("approve_threshold"),
                                                                     F.col("decline_threshold")),
                                              F.lit(False))).alias("n")).first()["n"]
    if bad:
        raise bands.ThresholdError(
            f"{bad} rows resolve to thresholds outside 0 <= approve_threshold < decline_threshold <= 1")


def apply_bands(resolved: DataFrame, score: str = "score", validate: bool = True) -> DataFrame:
    """P4 + P5 with per-row thresholds. With ``validate`` a row whose final
    pair breaks 0 <= t1 < t2 <= 1 (or whose profile is unknown), or whose
    score is null or NaN, fails the query in the same pass (``raise_error``),
    with no separate scan."""
    s = F.col(score).cast("double")
    t1, t2 = F.col("approve_threshold"), F.col("decline_threshold")
    d = bands.decision(s, t1, t2)
    if validate:
        ok = F.coalesce(bands.thresholds_valid(t1, t2), F.lit(False))
        good_score = s.isNotNull() & ~F.isnan(s)           # trap 2: never band a null/NaN score
        d = (F.when(~ok, F.raise_error(F.concat(
                F.lit("need 0 <= approve_threshold < decline_threshold <= 1; profile="),
                F.coalesce(F.col("profile"), F.lit("null")))))
             .when(~good_score, F.raise_error(F.lit("null or NaN score")))
             .otherwise(d))
    return (resolved.withColumn("decision", d)
                    .withColumn("predicted_class", bands.predicted_class(s, t2)))


def run_inference(df: DataFrame, score_fn: Callable[[DataFrame], DataFrame], profiles: DataFrame,
                  profile: str | Column = bands.DEFAULT_PROFILE, required: Sequence[str] = (),
                  approve_override: float | None = None, decline_override: float | None = None,
                  validate: bool = True) -> DataFrame:
    """Contract -> score -> thresholds -> bands, as one plan."""
    if required:
        contract.require_columns(df, required)
    scored = score_fn(df)
    resolved = resolve_thresholds(scored, profiles, profile, approve_override, decline_override)
    return apply_bands(resolved, validate=validate)


def infer_with_bundle(spark: SparkSession, df: DataFrame, bundle: model.Bundle, profile: str | Column = bands.DEFAULT_PROFILE,
                      docs: DataFrame | None = None, extra: dict[str, tuple[float, float]] | None = None,
                      required: Sequence[str] = (), approve_override: float | None = None,
                      decline_override: float | None = None) -> DataFrame:
    """P6 / P16 with a loaded bundle: the bundle's feature order (P3) and its threshold for the
    ``artifact`` profile (P14); a bare model takes the frame's feature columns and the
    fallback threshold. One plan from the scan to the decision."""
    features = contract.resolve_feature_columns(df, bundle.feature_columns)
    profiles = profile_table(spark, docs, bundle.decline_threshold, extra)
    return run_inference(df, lambda d: model.score(bundle.model, d), profiles, profile, [*required, *features],
                         approve_override, decline_override)


# ------------------------------------------------------------------ X1

def logistic_expr(coefficients: Sequence[float], intercept: float, features: Sequence[str]) -> Column:
    """A fitted logistic model as a JVM-side expression (stays in codegen)."""
    z = F.lit(float(intercept))
    for w, c in zip(coefficients, features):
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def python_model_scorer(estimator, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Any object with ``predict_proba`` (duck typing, as the reference
    allows) scored on Arrow batches. The model is shipped once per executor
    with the UDF closure; only use it when the model is not expressible
    as a Spark expression or an MLlib stage."""
    if not hasattr(estimator, "predict_proba"):
        raise ValueError("the model has no predict_proba method")
    cols = list(features)

    @F.pandas_udf(T.DoubleType())
    def _score(*series: pd.Series) -> pd.Series:
        x = pd.concat(series, axis=1).to_numpy(dtype="float64")
        return pd.Series(estimator.predict_proba(x)[:, 1]).astype("float64")

    def run(df: DataFrame) -> DataFrame:
        return df.withColumn("score", _score(*[F.col(c).cast("double") for c in cols]))
    return run
