"""Trap 2 at every entry point: null and NaN scores fail in the pass, with their count."""
import random

import pytest
from pyspark.sql import functions as F

from cutpoint.functions.pairs import threshold_grid
from cutpoint.operators import curves, monitor, policy
from cutpoint.operators.prefix import exact_quantiles
from cutpoint.plans.inference import profile_table, resolve_thresholds
from cutpoint.sources import contract

NAN = float("nan")
SCHEMA = "score double, label int, g string"
PATHS = {
    "policy": lambda df, pairs: policy.evaluate_policy(df, 0.2, 0.8),
    "policy by": lambda df, pairs: policy.evaluate_policy(df, 0.2, 0.8, by=["g"]),
    "cost": lambda df, pairs: policy.evaluate_policy_cost(df, 0.2, 0.8, 1, 1, 1),
    "sweep": lambda df, pairs: policy.evaluate_threshold_pairs(df, pairs),
    "sweep by": lambda df, pairs: policy.evaluate_threshold_pairs(df, pairs, by=["g"]),
    "cost sweep": lambda df, pairs: policy.search_best_policy(df, pairs, 1, 1, 1),
    "points": lambda df, pairs: curves.score_points(df),
    "auc": lambda df, pairs: curves.auc_metrics(curves.score_points(df)),
    "quantiles": lambda df, pairs: exact_quantiles(df, "score", [0.5]),
    "stats": lambda df, pairs: monitor.score_stats(df),
}


@pytest.mark.parametrize("name", PATHS)
@pytest.mark.parametrize("bad", [[None], [NAN, NAN], [None, NAN]])
def test_bad_scores_fail(spark, name, bad):
    pairs = threshold_grid(spark, 0.1, 0.2, 0.3, 0.4, 0.1)
    good = [(0.1, 0, "a"), (0.5, 1, "a"), (0.9, 1, "b")]
    assert PATHS[name](spark.createDataFrame(good, SCHEMA), pairs).count() > 0
    df = spark.createDataFrame(good + [(b, 1, "a") for b in bad], SCHEMA)
    with pytest.raises(Exception, match="rows have a null or NaN score"):
        PATHS[name](df, pairs).collect()


def test_bad_score_report(spark):
    df = spark.createDataFrame([(0.1, 0, "a"), (None, 0, "a"), (NAN, 0, "b")], SCHEMA)
    assert sorted(map(tuple, contract.bad_score_counts(df, by=["g"]).collect())) == [("a", 2, 1, 0), ("b", 1, 0, 1)]
    with pytest.raises(contract.ContractError):
        contract.assert_no_bad_scores(df)


def test_grid_without_a_valid_pair_is_an_error(spark):
    with pytest.raises(ValueError):
        threshold_grid(spark, 0.5, 0.6, 0.1, 0.2, 0.1)
    none = spark.createDataFrame([], "pair_no int, t1 double, t2 double")
    with pytest.raises(ValueError):
        policy.sweep_counts(spark.createDataFrame([(0.1, 0, "a")], SCHEMA), none)


def test_sweep_with_very_many_cuts(spark):
    rng = random.Random(1)
    rows = [(round(rng.random(), 6), rng.randrange(2), "a") for _ in range(300)]
    n = 50_000
    pairs = spark.range(n).select((F.col("id") + 1).alias("pair_no"), (F.col("id") / (2 * n)).alias("t1"),
                                  (0.5 + F.col("id") / (2 * n)).alias("t2"))
    got = policy.sweep_counts(spark.createDataFrame(rows, SCHEMA), pairs).where("pair_no % 9973 = 1").collect()
    assert len(got) == 6
    for r in got:
        t1, t2 = r["approve_threshold"], r["decline_threshold"]
        assert r["total"] == 300 and r["approve_count"] == sum(s < t1 for s, *_ in rows)
        assert r["fraud_decline"] == sum(s >= t2 and y == 1 for s, y, _ in rows)
        assert r["nonfraud_decline"] == sum(s >= t2 and y == 0 for s, y, _ in rows)


def test_profile_of_two_documents_is_an_error(spark):
    one = spark.sql("select named_struct('profiles', map('p', named_struct('approve_threshold', 0.1D, 'decline_threshold', 0.5D))) as doc")
    rows = spark.createDataFrame([(0.2,)] * 5, "score double")
    assert resolve_thresholds(rows, profile_table(spark, one), "p").count() == 5
    with pytest.raises(Exception, match="several documents define profile p"):
        resolve_thresholds(rows, profile_table(spark, one.union(one)), "p").collect()
