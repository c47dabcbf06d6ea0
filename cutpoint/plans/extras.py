"""Inference, parsing, run-log, report and streaming queries
(P14-P16, J2, F5, F6, S1, S3, S9, S10, D7)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.functions.pairs import parse_pair_specs, parse_tag_specs
from cutpoint.operators import brackets, curves, monitor, sweep_line
from cutpoint.plans import catalog as C
from cutpoint.plans.common import ts_text
from cutpoint.plans.inference import profile_table, run_inference
from cutpoint.session import ensure_checkpoint_dir
from cutpoint.sources import quarantine, runlog
from cutpoint.sources.contract import bad_score_counts
from cutpoint.sources.tables import TXN_KEY, read_table, txn, txn_from_lineitem
from cutpoint.streaming import event_time
from cutpoint.streaming.daily_mix import run_to_table

PUBLISHED_PROFILES = {"phase2_guarded": (0.20, 0.80)}
APPROVE_OVERRIDE = 0.10
#: Above about half of the days of the test tables, so that runs of many lengths occur.
REVIEW_RUN_RATE = 0.30


def _scratch(spark, name: str) -> str:
    """A fresh folder for one call, below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}_{uuid.uuid4().hex}"


def row_profile():
    """Per-row profile by segment: returns use the low-review fallback,
    accepted items the primary policy, open lines the model-artifact
    policy, everything else the optimised one."""
    return (F.when(F.col("l_returnflag") == "R", "fallback")
             .when(F.col("l_returnflag") == "A", "primary")
             .when(F.col("l_linestatus") == "O", "artifact")
             .otherwise("phase2_guarded"))


def q_profile_inference(spark, sf):
    prof = profile_table(spark, extra=PUBLISHED_PROFILES)
    out = run_inference(txn(spark, sf), lambda d: d, prof, row_profile(),
                        required=C.REQUIRED_TXN_COLUMNS)
    return out.select(*TXN_KEY, ts_text(), "profile", "approve_threshold", "decline_threshold", "score",
                      "decision", "predicted_class")


def q_threshold_override(spark, sf):
    """The phase2_guarded profile with an explicit approve threshold."""
    prof = profile_table(spark, extra=PUBLISHED_PROFILES)
    out = run_inference(txn(spark, sf), lambda d: d, prof, "phase2_guarded",
                        approve_override=APPROVE_OVERRIDE)
    mix = monitor.decision_mix(out, by=["approve_threshold", "decline_threshold"])
    return mix


def year_specs(spark, sf) -> DataFrame:
    """Pair specs per ship year, built from that year's score quantiles
    (median:p90 and p90:p99 are valid pairs; p99:median is reversed on
    purpose, and an empty token is skipped)."""
    t = txn(spark, sf).withColumn("year", F.year("ts").cast("long"))
    qv = brackets.quantiles(t, "score", [0.5, 0.9, 0.99], by=["year"])
    w = qv.groupBy("year").pivot("q", [0.5, 0.9, 0.99]).agg(F.first("value"))
    f = lambda c: F.format_string("%.2f", F.round(F.col(f"`{c}`"), 2))
    spec = F.concat_ws(",", F.concat(f(0.5), F.lit(":"), f(0.9)), F.concat(f(0.9), F.lit(":"), f(0.99)),
                       F.lit(" "), F.concat(f(0.99), F.lit(":"), f(0.5)))
    return w.select("year", spec.alias("spec"))


def q_parse_pairs(spark, sf):
    return parse_pair_specs(year_specs(spark, sf), "spec", key_cols=["year"])


def q_spec_sweep(spark, sf):
    """F5 -> G5 / J3: the pairs that each ship year's spec names, evaluated on that year's rows."""
    specs = parse_pair_specs(year_specs(spark, sf), "spec", key_cols=["year"]).where("error IS NULL")
    rows = txn(spark, sf).withColumn("year", F.year("ts").cast("long"))
    return sweep_line.evaluate_pairs(rows, specs.select("year", "pair_no", "t1", "t2"), by=["year"])


def q_parse_tags(spark, sf):
    """F6 over tag strings built from each event (one malformed token when
    the event value exceeds 100)."""
    ev = read_table(spark, sf, "events")
    spec = F.concat_ws(",", F.concat(F.lit("type="), "event_type"),
                       F.concat(F.lit("user="), F.col("user_id").cast("string")),
                       F.concat(F.lit(" k = "), F.get_json_object("props", "$.k")),
                       F.when(F.col("value") > 100, F.lit("oversize")))
    p = parse_tag_specs(ev.select("event_id", spec.alias("spec")), "spec", key_cols=["event_id"])
    return p.select("event_id", F.size("tags").cast("long").alias("n_tags"),
                    F.size("bad_tokens").cast("long").alias("n_bad"),
                    F.col("tags")["type"].alias("type_tag"), F.col("tags")["user"].alias("user_tag"),
                    F.col("tags")["k"].alias("k_tag"))


def q_run_log(spark, sf):
    """Append one run (params, metrics, tags) to the run table in the
    shared folder and read that run back, one row per metric."""
    pts = C.txn_points(spark, sf)
    auc = curves.auc_metrics(pts)
    rec = curves.recall_at_fpr(pts, C.TARGET_FPR)
    metrics = (auc.select(F.explode(F.create_map(F.lit("pr_auc"), "pr_auc", F.lit("roc_auc"), "roc_auc")))
               .unionByName(rec.select(F.explode(F.create_map(F.lit("recall_at_target_fpr"), "recall",
                                                              F.lit("threshold_at_target_fpr"), "threshold")))))
    table = _scratch(spark, "runs")
    run_id = runlog.log_run(spark, table, "train_baseline",
                            params={"test_size": str(C.TEST_SIZE), "target_fpr": str(C.TARGET_FPR)},
                            metrics=metrics, tags_spec="team=risk, stage = dev")
    return runlog.read_run(spark, table, run_id)


def q_report_rows(spark, sf):
    """The monitoring snapshot as long-form (section, metric, value)."""
    scored = C.scored_txn(spark, sf)
    mix = monitor.decision_mix(scored)
    stats = monitor.score_stats(C.txn(spark, sf))
    qual = monitor.label_quality(scored)

    def long(df: DataFrame, section: str, cols) -> DataFrame:
        args = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
        return df.selectExpr(f"'{section}' AS section", f"stack({len(cols)}, {args}) AS (metric, value)")
    return (long(mix, "volume_mix", ["rows", "approve_rate", "review_rate", "decline_rate"])
            .unionByName(long(stats, "score_distribution", ["mean_score", "p95_score", "p99_score"]))
            .unionByName(long(qual, "label_quality", ["fraud_total", "flagged_capture", "decline_capture",
                                                       "decline_fpr", "review_precision", "decline_precision"])))


def q_stream_daily_mix(spark, sf):
    """The lineitem table (a file or a folder of files) read as a stream -> txn ->
    bands -> counts per day, merged over the micro-batches."""
    schema = read_table(spark, sf, "lineitem").schema
    # Written as a pattern, the path may name a single file as well as a folder.
    stream = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/lineitem.parque[t]")
    base = _scratch(spark, "stream_daily_mix")
    return run_to_table(spark, txn_from_lineitem(stream), C.T1, C.T2, base + "/out", base + "/_checkpoint")


#: How long the event-time stream waits for late rows.
STREAM_DELAY = "30 days"


def q_stream_event_time(spark, sf):
    """D7 on event time: the same stream through watermark, one-day windows and the state store;
    days the watermark has passed come from the append-only output, the others from the state."""
    schema = read_table(spark, sf, "lineitem").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/lineitem.parque[t]")
    base = _scratch(spark, "stream_event_time")
    event_time.run_event_time(txn_from_lineitem(stream), C.T1, C.T2, base + "/out", base + "/_checkpoint", STREAM_DELAY)
    return event_time.days(spark, base + "/out", base + "/_checkpoint")


def q_review_runs(spark, sf):
    """D6 on event time: consecutive days whose review rate is over the cap, as one run each."""
    return monitor.review_runs(monitor.daily_mix(C.scored_txn(spark, sf)), REVIEW_RUN_RATE)


def q_score_guard(spark, sf):
    """Trap 2: bad scores per return flag, over txn and a literal group with one null and
    two NaN scores."""
    bad = spark.range(4).select(F.lit("bad rows").alias("l_returnflag"), F.when(F.col("id") == 0, F.lit(0.5))
                                .when(F.col("id") > 1, F.lit(float("nan"))).alias("score"))
    return bad_score_counts(txn(spark, sf).select("l_returnflag", "score").unionByName(bad), by=["l_returnflag"])


#: Every so many orders one row of the raw files is spoilt in one of three ways.
SPOILT_EVERY = 50


def raw_lines(rows: DataFrame) -> DataFrame:
    """CSV lines of txn rows as a careless source writes them: a word for a number, a line that
    breaks off, a label that is no class, a score that is missing."""
    text = F.to_csv(F.struct("l_orderkey", "l_linenumber", "score", "label"))
    k = F.col("l_orderkey") % SPOILT_EVERY
    return rows.select(
        F.when(k == 1, F.concat_ws(",", F.col("l_orderkey"), F.lit("first"), F.col("score"), F.col("label")))
        .when(k == 2, F.concat_ws(",", F.col("l_orderkey"), F.col("l_linenumber")))
        .when(k == 3, F.concat_ws(",", F.col("l_orderkey"), F.col("l_linenumber"), F.col("score"), F.lit("7")))
        .when(k == 4, F.concat_ws(",", F.col("l_orderkey"), F.col("l_linenumber"), F.lit(""), F.col("label")))
        .otherwise(text).alias("value"))


def q_csv_quarantine(spark, sf):
    """S1 + S2: raw files with spoilt lines are loaded with their schema and contract; per reason
    the rows, and per good class the rows and the sum of scores that came through."""
    path = _scratch(spark, "quarantine")
    raw_lines(txn(spark, sf)).write.text(f"{path}/raw")
    rules = {"label": F.col("label").isin(0, 1), "score": F.col("score").between(0.0, 1.0)}
    load = quarantine.load_csv(spark, f"{path}/raw", "l_orderkey long, l_linenumber int, score double, label tinyint",
                               f"{path}/loaded", rules, header=False)
    good = load.good(spark).groupBy(F.concat(F.lit("class "), "label").alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("score").alias("score_sum"))
    return load.counts(spark).withColumn("score_sum", F.lit(None).cast("double")).unionByName(good)


def q_scored_export(spark, sf):
    """S1 + S3: scored rows written as CSV partitioned by decision (no
    coalesce), then read back with an explicit schema; the result is the
    per-decision row count of what was written."""
    from cutpoint.sources.tables import read_csv_typed
    out = C.scored_txn(spark, sf).select(*TXN_KEY, "score", "label", "decision")
    path = _scratch(spark, "scored_csv")
    out.write.mode("overwrite").partitionBy("decision").option("header", True).csv(path)
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, score double, label int"
    back = read_csv_typed(spark, path, schema)
    return back.groupBy("decision").agg(F.count(F.lit(1)).alias("rows"),
                                        F.sum("label").cast("long").alias("positives"))


QUERIES = {
    "profile_inference": q_profile_inference,
    "threshold_override": q_threshold_override,
    "parse_pairs": q_parse_pairs,
    "spec_sweep": q_spec_sweep,
    "parse_tags": q_parse_tags,
    "run_log": q_run_log,
    "report_rows": q_report_rows,
    "stream_daily_mix": q_stream_daily_mix,
    "stream_event_time": q_stream_event_time,
    "review_runs": q_review_runs,
    "score_guard": q_score_guard,
    "csv_quarantine": q_csv_quarantine,
    "scored_export": q_scored_export,
}
