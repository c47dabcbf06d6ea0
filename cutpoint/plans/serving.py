"""Fitted model to scored, banded, written output in one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.operators import curves, model, scorecard
from cutpoint.operators.prefix import reuse
from cutpoint.plans import catalog as C
from cutpoint.plans.common import ts_text
from cutpoint.plans.extras import PUBLISHED_PROFILES, _scratch, row_profile
from cutpoint.plans.inference import infer_with_bundle
from cutpoint.plans.models import three_way
from cutpoint.sources.tables import TXN_FEATURES, TXN_KEY, read_csv_typed

#: What a served row holds, in the order of the written files; ``decision`` is their partition.
SERVED = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, ts string, label int, profile string, "
          "approve_threshold double, decline_threshold double, score double, predicted_class int")


def train_scorecard(spark: SparkSession, parts: DataFrame, path: str) -> scorecard.Scorecard:
    """Fit on the train part, round to a scorecard, set its threshold on the calibration part at
    the target false-positive rate, and save the bundle below ``path``."""
    train = reuse(parts.where(F.col("split") == "train").select(*TXN_FEATURES, "label"))
    summary = model.train_summary(train, TXN_FEATURES)
    fitted = model.fit_logistic(train, TXN_FEATURES, c_value=1.0, max_iter=2000, scaled=True, summary=summary)
    card = scorecard.from_model(fitted, TXN_FEATURES, summary)
    cal = parts.where(F.col("split") == "calibration").select("label", card.column().alias("score"))
    threshold = curves.recall_at_fpr(curves.score_points(cal), C.TARGET_FPR).first()["threshold"]
    model.save_bundle(card.model(), TXN_FEATURES, C.TARGET_FPR, threshold, path)
    return card


def q_model_inference(spark: SparkSession, sf: str) -> DataFrame:
    """P16 end to end: train, save, load, score the evaluation part with each row's own profile,
    write the decisions as CSV by decision and read them back with their schema."""
    parts = three_way(spark, sf)
    path = _scratch(spark, "serving")
    train_scorecard(spark, parts, f"{path}/bundle")
    bundle = model.load_bundle(spark, f"{path}/bundle")
    # The given score must not be read: the bundle's model makes its own.
    rows = parts.where(F.col("split") == "evaluation").drop("score", "split")
    out = infer_with_bundle(spark, rows, bundle, row_profile(), extra=PUBLISHED_PROFILES, required=("ts", *TXN_KEY))
    names = [x.split()[0] for x in SERVED.split(", ")]
    (out.withColumn("ts", ts_text()).select(*names, "decision").write.partitionBy("decision")
     .option("header", True).csv(f"{path}/decisions"))
    return read_csv_typed(spark, f"{path}/decisions", SERVED)


QUERIES = {"model_inference": q_model_inference}
