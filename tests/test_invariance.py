"""Same answers whatever the shuffle width (and so the number of ranges)."""
import pytest

import __spark_entry__ as E

NAMES = ["policy_sweep", "recall_at_fpr", "temporal_split", "psi", "score_stats", "stratified_split",
         "policy_drift"]


def run_all(spark, sf, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return {n: sorted(map(tuple, E.queries()[n](spark, sf).collect())) for n in NAMES}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_results_do_not_depend_on_partitioning(spark, sf001):
    a = run_all(spark, sf001, 1)
    b = run_all(spark, sf001, 97)
    for n in NAMES:
        assert a[n] == b[n], n
