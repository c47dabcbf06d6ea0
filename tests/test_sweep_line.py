import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cutpoint.operators import policy, sweep_line


def table(spark, rows):
    return spark.createDataFrame(rows, "g string, score double, label int").repartition(4)


def case():
    rng = random.Random(12)
    rows = [(rng.choice("ab"), rng.randrange(101) / 100, int(rng.random() < 0.2)) for _ in range(800)] + [("c", 0.5, 1)]
    pairs = []
    for g in "abcd":
        for k in range(40):
            a, b = sorted(rng.sample(range(101), 2))
            pairs.append((g, k, a / 100, b / 100))
    return rows, pairs


def brute(rows, pairs):
    out = []
    for g, k, a, b in pairs:
        x = [(s, y) for h, s, y in rows if h == g]
        if x:
            part = [[y for s, y in x if s < a], [y for s, y in x if a <= s < b], [y for s, y in x if s >= b]]
            out.append((g, k, len(x), *map(len, part), sum(part[0]), sum(part[1]), sum(part[2]), part[2].count(0)))
    return sorted(out)


COLS = ("g", "pair_no", "total", "approve_count", "review_count", "decline_count", "fraud_approve", "fraud_review", "fraud_decline",
        "nonfraud_decline")


@pytest.mark.parametrize("buckets", [1, 9])
def test_each_group_sweeps_its_own_pairs(spark, buckets):
    rows, pairs = case()
    got = sweep_line.sweep_counts(table(spark, rows), spark.createDataFrame(pairs, "g string, pair_no int, t1 double, t2 double"),
                                  ["g"], buckets=buckets)
    assert sorted(map(tuple, got.select(*COLS).collect())) == brute(rows, pairs)


def test_equals_the_grid_sweep_without_groups(spark):
    rows, pairs = case()
    df = table(spark, rows)
    pairs = spark.createDataFrame([(i, a, b) for i, (_, _, a, b) in enumerate(pairs)], "pair_no int, t1 double, t2 double")
    want = policy.sweep_counts(df, pairs)
    assert sorted(map(tuple, sweep_line.sweep_counts(df, pairs).select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_million_cuts(spark):
    n = 500_000
    df = spark.range(20_000).selectExpr("double(id * 7919 % 20000) / 20000 AS score", "int(id % 5 = 0) AS label")
    pairs = spark.range(n).selectExpr("id AS pair_no", f"double(id) / {2 * n} AS t1", f"0.5 + double(id) / {2 * n} + 1e-9 AS t2")
    got = sweep_line.sweep_counts(df, pairs).agg(F.count(F.lit(1)).alias("k"), F.sum("approve_count").alias("a"),
                                                 F.sum("review_count").alias("r"), F.sum("fraud_decline").alias("d")).first()
    ids = np.arange(20_000)
    s, y = (ids * 7919 % 20_000) / 20_000, ids % 5 == 0
    k = np.arange(n)
    t1, t2 = k / (2 * n), 0.5 + k / (2 * n) + 1e-9
    below = [np.searchsorted(np.sort(s), t, side="left").sum() for t in (t1, t2)]
    fraud = (y.sum() - np.searchsorted(np.sort(s[y]), t2, side="left")).sum()
    assert tuple(got) == (n, below[0], below[1] - below[0], fraud)


def test_bad_pairs_and_bad_scores_fail(spark):
    df = table(spark, [("a", 0.5, 1)])
    with pytest.raises(Exception, match="breaks 0 <= t1 < t2 <= 1"):
        sweep_line.sweep_counts(df, spark.createDataFrame([(1, 0.5, 0.2)], "pair_no int, t1 double, t2 double")).collect()
    with pytest.raises(Exception, match="1 rows have a null or NaN score"):
        sweep_line.sweep_counts(table(spark, [("a", float("nan"), 1), ("a", 0.1, 0)]),
                                spark.createDataFrame([(1, 0.1, 0.2)], "pair_no int, t1 double, t2 double")).collect()
