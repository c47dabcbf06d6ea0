"""Report rows (S10): the numbers behind every report as ``report, item, metric, value``.

What describes the scored rows themselves (volumes, scores, errors at the threshold) is not computed by
a scan of its own: ``DataFrame.observe`` collects it in the pass that writes the rows, so a
report costs nothing beyond the export. The other sections read small result tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cutpoint.functions.bands import APPROVE, DECLINE, REVIEW, decision, is_bad, predicted_class
from cutpoint.functions.text import fixed_text, pct_text
from cutpoint.operators import monitor, ranking
from cutpoint.plans import catalog as C
from cutpoint.plans.extras import _scratch
from cutpoint.plans.models import q_model_sweep
from cutpoint.plans.registry import q_policy_drift
from cutpoint.sources.tables import TXN_KEY, read_table, txn

SCHEMA = "report string, item string, metric string, value double"
#: Target of the latency report, in the unit of the values.
TARGET_P95 = 200.0

SIMULATION = ("rank", "approve_threshold", "decline_threshold", "approve_rate", "review_rate", "decline_rate",
              "fraud_capture_decline", "fraud_capture_flagged", "decline_fpr")
COST = ("approve_threshold", "decline_threshold", "review_rate", "flagged_fraud_capture", "decline_fpr", "total_cost",
        "cost_per_row", "meets_guardrails")
EXPERIMENT = ("model_rank", "pr_auc", "roc_auc", "recall_at_target_fpr", "threshold_at_target_fpr")
LATENCY = ("n", "mean", "p50", "p95", "p99", "rows_per_sec")


def long_rows(df: DataFrame, report: str, item, metrics) -> DataFrame:
    """One row per row of ``df`` and metric; numbers and flags as doubles."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(F.lit(report).alias("report"), (F.lit(item) if isinstance(item, str) else item).alias("item"),
                     F.inline(pairs))


def export_scored(scored: DataFrame, t1: float, t2: float, threshold: float, path: str, score: str = "score",
                  label: str = "label") -> DataFrame:
    """Write the scored rows with decision and predicted class to ``path`` (Parquet by decision) and
    return the rows of the ``inference`` and ``error_analysis`` reports, observed on the way.

    Once a session has observed anything, Spark 4.1 can no longer ship an MLlib model that holds its
    training summary (the summary holds the session). The library's own models are applied as
    expressions and are not affected; other fitted models need a save and load first."""
    s, y = F.col(score).cast("double"), F.col(label)
    rows = scored.withColumn("decision", decision(s, t1, t2)).withColumn("predicted_class", predicted_class(s, threshold))
    d, p = F.col("decision"), F.col("predicted_class") == 1
    seen = Observation("export")
    (rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(d == APPROVE).alias("approve_count"),
                  F.count_if(d == REVIEW).alias("review_count"), F.count_if(d == DECLINE).alias("decline_count"),
                  F.avg(s).alias("mean_score"), F.max(s).alias("max_score"), F.count_if(is_bad(s)).alias("bad_scores"),
                  F.count_if((y == 0) & ~p).alias("tn"), F.count_if((y == 0) & p).alias("fp"),
                  F.count_if((y == 1) & ~p).alias("fn"), F.count_if((y == 1) & p).alias("tp"))
     .write.partitionBy("decision").parquet(path))
    got = seen.get
    if got["bad_scores"]:
        raise ValueError(f"{got['bad_scores']} rows have a null or NaN score")
    share = lambda a, b: got[a] / (got[a] + got[b]) if got[a] + got[b] else 0.0
    errors = {m: got[m] for m in ("tn", "fp", "fn", "tp")} | {
        "recall": share("tp", "fn"), "precision": share("tp", "fp"), "realized_fpr": share("fp", "tn"),
        "selected_threshold": threshold, "exported_errors": got["fp"] + got["fn"]}
    volume = {m: got[m] for m in ("rows", "approve_count", "review_count", "decline_count", "mean_score", "max_score")}
    out = [(r, "all", m, None if v is None else float(v)) for r, ms in (("inference", volume), ("error_analysis", errors))
           for m, v in ms.items()]
    return scored.sparkSession.createDataFrame(out, SCHEMA)


def reference_drift(current: DataFrame, reference_path: str | None, score: str = "score", bins: int = 10) -> DataFrame:
    """The drift section of the monitoring report: PSI of the current scores against a scored
    reference table; no rows where the table is absent, or has no such column."""
    spark = current.sparkSession
    empty = spark.createDataFrame([], SCHEMA)
    if reference_path is None:
        return empty
    try:
        reference = spark.read.parquet(reference_path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return empty
    if score not in reference.columns:
        return empty
    found = monitor.psi(reference, current, score, bins)
    levels = F.array_position(F.array(*map(F.lit, ("low", "moderate", "high"))), F.col("drift_level")).alias("drift_level_no")
    return long_rows(found.select("psi", levels), "monitoring", "reference", ("psi", "drift_level_no"))


def q_report_sections(spark: SparkSession, sf: str) -> DataFrame:
    """The sections of all reports but the model experiments, whose fits have a query of their own."""
    path = _scratch(spark, "report")
    threshold = C.cap_threshold(spark, sf)
    out = export_scored(txn(spark, sf).select(*TXN_KEY, "score", "label"), C.T1, C.T2, threshold, path)
    # The exported rows serve as the reference of the next run: the drift of a set against itself.
    out = out.unionByName(reference_drift(txn(spark, sf).where("l_returnflag = 'R'"), path))
    ranked = C.sim_ranked(spark, sf)
    out = out.unionByName(long_rows(ranked, "policy_simulation", F.col("policy_id"), SIMULATION))
    best = ranking.recommend_simulation(ranked, **C.SIM_GUARDRAILS)
    out = out.unionByName(long_rows(best, "policy_simulation", "recommended", (*SIMULATION, "meets_guardrails")))
    cheapest = ranking.recommend_cost(C.cost_ranked(spark, sf), **C.COST_GUARDRAILS)
    out = out.unionByName(long_rows(cheapest, "cost_policy", "recommended", COST))
    drift = q_policy_drift(spark, sf).agg(F.count(F.lit(1)).alias("differences"), (F.count(F.lit(1)) == 0).alias("passed"))
    out = out.unionByName(long_rows(drift, "policy_drift", "registry", ("differences", "passed")))
    timed = monitor.duration_percentiles(read_table(spark, sf, "events"), "value", by=["event_type"])
    timed = timed.withColumn("meets_target", F.col("p95") <= F.lit(TARGET_P95))
    return out.unionByName(long_rows(timed, "latency", F.col("event_type"), (*LATENCY, "meets_target")))


def q_report_experiments(spark: SparkSession, sf: str) -> DataFrame:
    """The model experiments' rows: every candidate with its rank."""
    return long_rows(q_model_sweep(spark, sf), "experiments", F.col("candidate"), EXPERIMENT)


#: Rates of the simulation table as people read them.
SHOWN = ("approve_rate", "review_rate", "decline_rate", "fraud_capture_decline", "fraud_capture_flagged", "decline_fpr")


def q_report_text(spark: SparkSession, sf: str) -> DataFrame:
    """the simulation's table as text: thresholds with four places, rates as percentages.
    Values are rounded to what is shown before they are written, so halves print alike everywhere."""
    t = C.sim_ranked(spark, sf)
    return t.select("rank", "policy_id", fixed_text(F.round("approve_threshold", 4)).alias("t1"),
                    fixed_text(F.round("decline_threshold", 4)).alias("t2"),
                    *[pct_text(F.round(c, 4)).alias(c) for c in SHOWN])


QUERIES = {"report_text": q_report_text, "report_sections": q_report_sections, "report_experiments": q_report_experiments}
