"""Versioned policy documents as data.

A policy document is a JSON object. Here a *registry* is a DataFrame of
documents, one row per (doc_id, JSON text): many segments or versions are
validated, exploded and compared in one job instead of one file at a time.
Documents are parsed with ``try_parse_json`` (VARIANT), so type checks see
the JSON types the reference checks (integer version, boolean flag, numeric
guardrails) rather than values coerced by a fixed read schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutpoint.functions.bands import DEFAULT_PROFILE, thresholds_valid

# Fixed values that must equal the reference's.
SUPPORTED_SCHEMA_VERSION = 1
REQUIRED_PROFILES = ("primary", "fallback", "phase2_guarded")
GUARDRAIL_KEYS = ("max_review_rate", "min_flagged_fraud_capture", "max_decline_fpr")
PRIMARY = (0.11, 0.45)
FALLBACK = (0.19, 0.80)
PROFILE_METADATA_KEYS = ("source", "calibration_method", "meets_guardrails", "review_rate",
                         "decline_fpr", "flagged_fraud_capture", "total_cost", "cost_per_row")
OPTIMIZER_NAME = "cutpoint.plans.models"

PROFILE_TYPE = T.StructType([
    T.StructField("approve_threshold", T.DoubleType()),
    T.StructField("decline_threshold", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("calibration_method", T.StringType()),
    T.StructField("meets_guardrails", T.BooleanType()),
    T.StructField("review_rate", T.DoubleType()),
    T.StructField("decline_fpr", T.DoubleType()),
    T.StructField("flagged_fraud_capture", T.DoubleType()),
    T.StructField("total_cost", T.DoubleType()),
    T.StructField("cost_per_row", T.DoubleType()),
])

POLICY_SCHEMA = T.StructType([
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("generated_at", T.StringType()),
    T.StructField("source", T.StructType([
        T.StructField("optimizer", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("methods_evaluated", T.ArrayType(T.StringType())),
        T.StructField("grid_step", T.DoubleType())])),
    T.StructField("guardrails", T.StructType([T.StructField(k, T.DoubleType()) for k in GUARDRAIL_KEYS])),
    T.StructField("profiles", T.MapType(T.StringType(), PROFILE_TYPE)),
])


def _week3_profile(t1: float, t2: float) -> Column:
    return F.struct(F.lit(t1).alias("approve_threshold"), F.lit(t2).alias("decline_threshold"),
                    F.lit("week3").alias("source"),
                    *[F.lit(None).cast(f.dataType).alias(f.name) for f in PROFILE_TYPE.fields[3:]])


def build_documents(best: DataFrame, key_cols: Sequence[str], methods: Sequence[str],
                    guardrails: dict, grid_step: float, model_path: str = "",
                    generated_at: Column | None = None) -> DataFrame:
    """S6 payload: one document per row of ``best`` (a chosen cost-rule row
    with ``method`` and ``meets_guardrails``), keyed by ``doc_id``."""
    g = guardrails
    guarded = F.struct(
        F.col("approve_threshold").cast("double").alias("approve_threshold"),
        F.col("decline_threshold").cast("double").alias("decline_threshold"),
        F.lit("phase2_optimization").alias("source"),
        F.col("method").alias("calibration_method"),
        F.col("meets_guardrails").alias("meets_guardrails"),
        F.col("review_rate").alias("review_rate"), F.col("decline_fpr").alias("decline_fpr"),
        F.col("flagged_fraud_capture").alias("flagged_fraud_capture"),
        F.col("total_cost").alias("total_cost"), F.col("cost_per_row").alias("cost_per_row"))
    doc = F.struct(
        F.lit(SUPPORTED_SCHEMA_VERSION).alias("schema_version"),
        (generated_at if generated_at is not None
         else F.date_format(F.current_date(), "yyyy-MM-dd")).alias("generated_at"),
        F.struct(F.lit(OPTIMIZER_NAME).alias("optimizer"), F.lit(model_path).alias("model_path"),
                 F.array(*[F.lit(m) for m in methods]).alias("methods_evaluated"),
                 F.lit(float(grid_step)).alias("grid_step")).alias("source"),
        F.struct(F.lit(float(g["max_review_rate"])).alias("max_review_rate"),
                 F.lit(float(g["min_capture"])).alias("min_flagged_fraud_capture"),
                 F.lit(float(g["max_decline_fpr"])).alias("max_decline_fpr")).alias("guardrails"),
        F.create_map(F.lit("primary"), _week3_profile(*PRIMARY),
                     F.lit("fallback"), _week3_profile(*FALLBACK),
                     F.lit("phase2_guarded"), guarded).alias("profiles"))
    doc_id = F.concat_ws("/", *[F.col(c).cast("string") for c in key_cols]) if key_cols else F.lit("policy")
    return best.select(doc_id.alias("doc_id"), doc.alias("doc"))


def to_json_text(docs: DataFrame) -> DataFrame:
    """Document struct -> JSON text (nulls dropped like absent keys)."""
    return docs.select("doc_id", F.to_json("doc").alias("json"))


def write_documents(docs: DataFrame, path: str) -> None:
    """S6 sink: JSON lines, one document per line, written by the executors."""
    to_json_text(docs).write.mode("overwrite").json(path)


def read_documents(spark, path: str) -> DataFrame:
    """S4 source for a written registry: (doc_id, json)."""
    return spark.read.schema("doc_id string, json string").json(path)


def parse_documents(texts: DataFrame) -> DataFrame:
    """Typed view of (doc_id, json); malformed parts become null."""
    return texts.select("doc_id", F.from_json("json", POLICY_SCHEMA).alias("doc"))


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def validate_documents(texts: DataFrame, require_guardrails: bool = True,
                       required_profiles: Sequence[str] = REQUIRED_PROFILES) -> DataFrame:
    """G18 over a registry of (doc_id, json): one row per violation
    (doc_id, rule, detail). Empty output means every document is valid."""
    v = F.try_parse_json("json")
    base = texts.select("doc_id", v.alias("v"))
    root_obj = F.coalesce(_vtype(F.col("v")).startswith("OBJECT"), F.lit(False))
    sv = F.variant_get(F.col("v"), "$.schema_version", "variant")
    sv_type = _vtype(sv)
    prof_v = F.variant_get(F.col("v"), "$.profiles", "variant")
    prof_ok = F.coalesce(_vtype(prof_v).startswith("OBJECT"), F.lit(False))
    doc_rules = []

    def rule(cond: Column, name: str, detail: Column) -> Column:
        return F.when(cond, F.struct(F.lit(name).alias("rule"), detail.alias("detail")))

    doc_rules.append(rule(~root_obj, "root_not_object", F.lit("the document is not a JSON object")))
    doc_rules.append(rule(root_obj & (sv.isNull() | ~F.coalesce(sv_type.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(False))),
                          "schema_version_type", F.lit("schema_version is absent or no whole number")))
    doc_rules.append(rule(root_obj & F.coalesce(sv_type.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(False))
                          & (F.try_variant_get(F.col("v"), "$.schema_version", "bigint") != SUPPORTED_SCHEMA_VERSION),
                          "schema_version_unsupported",
                          F.concat(F.lit("cannot read schema_version "),
                                   F.try_variant_get(F.col("v"), "$.schema_version", "string"))))
    doc_rules.append(rule(root_obj & ~prof_ok, "profiles_not_object", F.lit("profiles is absent or no JSON object")))
    pmap = F.try_variant_get(F.col("v"), "$.profiles", "map<string,variant>")
    for p in required_profiles:
        doc_rules.append(rule(root_obj & prof_ok & ~F.coalesce(F.map_contains_key(pmap, F.lit(p)), F.lit(False)),
                              "missing_profile", F.lit(f"no profile named {p}")))
    if require_guardrails:
        gv = F.variant_get(F.col("v"), "$.guardrails", "variant")
        g_ok = F.coalesce(_vtype(gv).startswith("OBJECT"), F.lit(False))
        doc_rules.append(rule(root_obj & ~g_ok, "guardrails_not_object",
                              F.lit("guardrails is absent or no JSON object")))
        for k in GUARDRAIL_KEYS:
            kv = F.variant_get(F.col("v"), f"$.guardrails.{k}", "variant")
            kt = _vtype(kv)
            numeric = F.coalesce(kt.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "BOOLEAN")
                                 | kt.startswith("DECIMAL"), F.lit(False))
            val = F.try_variant_get(F.col("v"), f"$.guardrails.{k}", "double")
            doc_rules.append(rule(g_ok & kv.isNull(), "missing_guardrail", F.lit(f"guardrail {k} is absent")))
            doc_rules.append(rule(g_ok & kv.isNotNull() & ~numeric, "guardrail_type",
                                  F.lit(f"guardrail {k} is no number")))
            doc_rules.append(rule(g_ok & numeric & ~((val >= 0.0) & (val <= 1.0)), "guardrail_range",
                                  F.lit(f"guardrail {k} is outside 0 to 1")))
    per_doc = base.select("doc_id", F.explode(F.filter(F.array(*doc_rules), lambda x: x.isNotNull())).alias("r"))
    per_doc = per_doc.select("doc_id", F.col("r.rule").alias("rule"), F.col("r.detail").alias("detail"))

    profs = base.filter(root_obj & prof_ok).select("doc_id", F.explode(pmap).alias("profile", "p"))
    pt = _vtype(F.col("p"))
    a = F.try_variant_get(F.col("p"), "$.approve_threshold", "double")
    dd = F.try_variant_get(F.col("p"), "$.decline_threshold", "double")
    has_a = F.variant_get(F.col("p"), "$.approve_threshold", "variant").isNotNull()
    has_d = F.variant_get(F.col("p"), "$.decline_threshold", "variant").isNotNull()
    mg = F.variant_get(F.col("p"), "$.meets_guardrails", "variant")
    is_obj = F.coalesce(pt.startswith("OBJECT"), F.lit(False))
    prof_rules = F.array(
        rule(~is_obj, "profile_not_object", F.concat(F.col("profile"), F.lit(": no JSON object"))),
        rule(is_obj & ~(has_a & has_d), "profile_missing_thresholds",
             F.concat(F.col("profile"), F.lit(": a threshold is absent"))),
        rule(is_obj & has_a & has_d & ~F.coalesce(thresholds_valid(a, dd), F.lit(False)), "invalid_thresholds",
             F.concat(F.col("profile"), F.lit(": thresholds out of order or outside 0 to 1"))),
        rule(is_obj & mg.isNotNull() & F.coalesce(_vtype(mg) != "BOOLEAN", F.lit(False))
             & ~F.coalesce(F.is_variant_null(mg), F.lit(False)),
             "meets_guardrails_type",
             F.concat(F.col("profile"), F.lit(": meets_guardrails is neither true nor false"))))
    per_prof = profs.select("doc_id", F.explode(F.filter(prof_rules, lambda x: x.isNotNull())).alias("r")) \
        .select("doc_id", F.col("r.rule").alias("rule"), F.col("r.detail").alias("detail"))
    return per_doc.unionByName(per_prof)


def registry_status(texts: DataFrame, **kw) -> DataFrame:
    """One row per document: valid flag and violation count."""
    viol = validate_documents(texts, **kw).groupBy("doc_id").agg(F.count(F.lit(1)).alias("violations"))
    return (texts.select("doc_id").join(viol, "doc_id", "left")
            .select("doc_id", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
            .withColumn("valid", F.col("violations") == 0))


def explode_profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, profile, approve_threshold, decline_threshold, source, valid)."""
    e = docs.select("doc_id", F.explode("doc.profiles").alias("profile", "p"))
    return e.select("doc_id", "profile", F.col("p.approve_threshold").alias("approve_threshold"),
                    F.col("p.decline_threshold").alias("decline_threshold"),
                    F.col("p.source").alias("source"),
                    thresholds_valid(F.col("p.approve_threshold"), F.col("p.decline_threshold")).alias("valid"))


def policy_status(docs: DataFrame, profile: str = DEFAULT_PROFILE) -> DataFrame:
    """Per document, version, profiles, guardrails, the selected
    profile's thresholds and its optional metadata."""
    p = F.col("doc.profiles")[F.lit(profile)]
    return docs.select(
        "doc_id", F.col("doc.schema_version").cast("long").alias("schema_version"),
        F.col("doc.generated_at").alias("generated_at"),
        F.lit(DEFAULT_PROFILE).alias("default_policy_profile"),
        F.lit(profile).alias("selected_policy_profile"),
        F.array_join(F.array_sort(F.map_keys("doc.profiles")), ",").alias("available_profiles"),
        *[F.col(f"doc.guardrails.{k}").alias(k) for k in GUARDRAIL_KEYS],
        p["approve_threshold"].alias("approve_threshold"), p["decline_threshold"].alias("decline_threshold"),
        *[p[k].alias(k) for k in PROFILE_METADATA_KEYS])


def compare_documents(current: DataFrame, fresh: DataFrame,
                      required_profiles: Sequence[str] = REQUIRED_PROFILES,
                      max_delta: float = 1e-6) -> DataFrame:
    """Documents matched by doc_id; the three guardrails and the
    thresholds of each required profile are compared, a missing side counts
    as 0.0, and differences above ``max_delta`` are returned."""
    def flat(docs: DataFrame, side: str) -> DataFrame:
        items = [F.struct(F.lit("guardrail").alias("scope"), F.lit(k).alias("key"),
                          F.col(f"doc.guardrails.{k}").alias("value")) for k in GUARDRAIL_KEYS]
        for p in required_profiles:
            for k in ("approve_threshold", "decline_threshold"):
                items.append(F.struct(F.lit(f"profile {p}").alias("scope"), F.lit(k).alias("key"),
                                      F.col("doc.profiles")[F.lit(p)][k].alias("value")))
        return docs.select("doc_id", F.explode(F.array(*items)).alias("i")).select(
            "doc_id", F.col("i.scope").alias("scope"), F.col("i.key").alias("key"),
            F.col("i.value").alias(side))

    cur, fr = flat(current, "current"), flat(fresh, "fresh")
    j = cur.join(fr, ["doc_id", "scope", "key"], "full_outer")
    c = F.coalesce(F.col("current"), F.lit(0.0))
    f = F.coalesce(F.col("fresh"), F.lit(0.0))
    return j.select("doc_id", "scope", "key", c.alias("current"), f.alias("fresh")) \
            .filter(F.abs(F.col("current") - F.col("fresh")) > F.lit(float(max_delta)))
