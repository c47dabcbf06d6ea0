import math

import pytest
from pyspark.sql import functions as F

from cutpoint.functions import bands
from cutpoint.sources import contract

REQ = ["Time", "Amount", *[f"V{i}" for i in range(1, 29)], "Class"]


def frame(spark, drop=()):
    cols = [c for c in REQ if c not in drop]
    return spark.createDataFrame([tuple(0.0 for _ in cols)] * 2, ", ".join(f"`{c}` double" for c in cols))


def test_contract_accepts_and_rejects(spark):
    contract.require_columns(frame(spark), REQ)
    with pytest.raises(contract.ContractError, match="V7"):
        contract.require_columns(frame(spark, drop=("V7",)), REQ)


def test_feature_columns_sorted_without_label():
    assert contract.feature_columns(["V2", "Class", "Amount", "Time", "V1"], leakage=["Class"]) == \
        ["Amount", "Time", "V1", "V2"]


def test_resolve_feature_columns_bundle_order_wins(spark):
    df = frame(spark)
    assert contract.resolve_feature_columns(df, ["V2", "V1"]) == ["V2", "V1"]
    with pytest.raises(contract.ContractError):
        contract.resolve_feature_columns(df, ["V1", "missing"])


def test_column_profile_counts_nulls_nans_and_missing(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (3.0, 4.0)], "a double, b double")
    rows = {r["column_name"]: r for r in contract.column_profile(df, ["a", "b", "c"]).collect()}
    assert rows["a"]["nan_count"] == 1 and rows["a"]["null_count"] == 0
    assert rows["b"]["null_count"] == 1
    assert rows["c"]["present"] is False


def test_bad_scores_rejected(spark):
    df = spark.createDataFrame([(0.1,), (float("nan"),)], "score double")
    with pytest.raises(contract.ContractError):
        contract.assert_no_bad_scores(df)


def test_bands_fixture(spark):
    df = spark.createDataFrame([(0.01,), (0.08,), (0.2,), (0.4,)], "score double")
    out = df.select(bands.decision(F.col("score"), 0.08, 0.30).alias("d"),
                    bands.predicted_class(F.col("score"), 0.30).alias("c")).collect()
    assert [r["d"] for r in out] == ["approve", "review", "review", "decline"]
    assert [r["c"] for r in out] == [0, 0, 0, 1]


def test_score_exactly_at_thresholds(spark):
    df = spark.createDataFrame([(0.2,), (0.8,)], "score double")
    assert [r[0] for r in df.select(bands.decision(F.col("score"), 0.2, 0.8)).collect()] == ["review", "decline"]


def test_threshold_order_errors():
    with pytest.raises(bands.ThresholdError):
        bands.check_thresholds(0.7, 0.6)
    with pytest.raises(bands.ThresholdError):
        bands.check_thresholds(0.1, 1.1)
    bands.check_thresholds(0.0, 1.0)


def test_artifact_profile(spark):
    t1, t2 = bands.artifact_thresholds(0.4)
    r = spark.range(1).select(t1.alias("a"), t2.alias("b")).first()
    assert math.isclose(r["a"], 0.11) and math.isclose(r["b"], 0.4)
    t1, t2 = bands.artifact_thresholds(None)
    r = spark.range(1).select(t1.alias("a"), t2.alias("b")).first()
    assert math.isclose(r["a"], 0.11) and math.isclose(r["b"], 0.45)
    t1, t2 = bands.artifact_thresholds(0.1)
    assert math.isclose(spark.range(1).select(t1).first()[0], 0.05)


def test_text_helpers(spark):
    from cutpoint.functions.text import fixed_text, pct_text, today_iso
    r = spark.range(1).select(pct_text(F.lit(0.1234)).alias("p"), fixed_text(F.lit(0.2)).alias("f"),
                              today_iso().alias("d")).first()
    assert r["p"] == "12.34%" and r["f"] == "0.2000" and len(r["d"]) == 10
