"""Registry queries: policy documents derived from the data.

Documents are produced per segment (``l_returnflag``) by the cost search
with the cost guardrails: "current" documents from the train part of the
time split, "fresh" ones from the test part, so a drift check compares a
deployed policy with one recomputed on newer rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.functions.pairs import GRID_DEFAULTS, threshold_grid
from cutpoint.operators import policy, ranking
from cutpoint.plans import catalog as C
from cutpoint.session import ensure_checkpoint_dir
from cutpoint.sources import policy_doc as pdoc

SEGMENT = "l_returnflag"
FIXED_DATE = "1970-01-01"   # compared outputs never carry the run date


def segment_best(split_df: DataFrame) -> DataFrame:
    """Cost-rule recommendation per (split, segment) from one sweep over a
    (split, segment, score, label, n) histogram of the split rows."""
    grid = threshold_grid(split_df.sparkSession, **GRID_DEFAULTS)
    h = policy.score_label_histogram(split_df, by=["split", SEGMENT])
    ranked = policy.search_best_policy(h, grid, **C.COSTS, by=["split", SEGMENT], weight="n")
    return ranking.recommend_cost(ranked, **C.COST_GUARDRAILS, by=["split", SEGMENT]) \
        .withColumn("method", F.lit("none"))


def segment_documents(best: DataFrame) -> DataFrame:
    return pdoc.build_documents(best, [SEGMENT], ["none"], C.COST_GUARDRAILS,
                                GRID_DEFAULTS["step"], generated_at=F.lit(FIXED_DATE))


def current_and_fresh(spark, sf):
    from cutpoint.operators import split
    s = split.temporal_split(C.txn_tie(spark, sf), "ts", C.TIE_ORDER, C.TEST_SIZE)
    best = segment_best(s)
    return (segment_documents(best.filter(F.col("split") == "train")),
            segment_documents(best.filter(F.col("split") == "test")))


def q_policy_profiles(spark, sf):
    cur, _ = current_and_fresh(spark, sf)
    return pdoc.explode_profiles(pdoc.parse_documents(pdoc.to_json_text(cur)))


def q_policy_registry_check(spark, sf):
    cur, fr = current_and_fresh(spark, sf)
    texts = (pdoc.to_json_text(cur).withColumn("doc_id", F.concat(F.lit("current/"), "doc_id"))
             .unionByName(pdoc.to_json_text(fr).withColumn("doc_id", F.concat(F.lit("fresh/"), "doc_id"))))
    # The same documents spoilt: another version, a lost profile, guardrails out of range, cut text.
    plain = pdoc.to_json_text(cur)
    spoilt = {
        "version/": F.regexp_replace("json", r'"schema_version":\d+', '"schema_version":99'),
        "profile/": F.regexp_replace("json", '"fallback":', '"spare":'),
        "range/": F.regexp_replace("json", r'"max_(review_rate|decline_fpr)":[0-9.]+', r'"max_$1":1.5'),
        "broken/": F.expr("left(json, 40)")}
    for name, text in spoilt.items():
        texts = texts.unionByName(plain.select(F.concat(F.lit(name), "doc_id").alias("doc_id"), text.alias("json")))
    return pdoc.registry_status(texts)


def q_policy_status(spark, sf):
    cur, _ = current_and_fresh(spark, sf)
    return pdoc.policy_status(pdoc.parse_documents(pdoc.to_json_text(cur))).drop("generated_at")


def q_policy_drift(spark, sf):
    cur, fr = current_and_fresh(spark, sf)
    return pdoc.compare_documents(cur, fr)


def q_policy_roundtrip(spark, sf):
    """S6 then S4: write the registry as JSON lines into the shared folder,
    read it back, and compare each document with the one written."""
    cur, _ = current_and_fresh(spark, sf)
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/policy_registry_{uuid.uuid4().hex}"
    pdoc.write_documents(cur, path)
    back = pdoc.parse_documents(pdoc.read_documents(spark, path))
    orig = pdoc.parse_documents(pdoc.to_json_text(cur))
    j = orig.alias("a").join(back.alias("b"), "doc_id", "full_outer")
    return j.select("doc_id", (F.to_json("a.doc") == F.to_json("b.doc")).alias("same"))


QUERIES = {
    "policy_profiles": q_policy_profiles,
    "policy_registry_check": q_policy_registry_check,
    "policy_status": q_policy_status,
    "policy_drift": q_policy_drift,
    "policy_roundtrip": q_policy_roundtrip,
}
