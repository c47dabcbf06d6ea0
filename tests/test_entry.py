import pytest

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    r = rows[0]
    assert len(rows) == 1
    assert r["approve_count"] + r["review_count"] + r["decline_count"] > 0
    assert abs(r["approve_rate"] + r["review_rate"] + r["decline_rate"] - 1.0) < 1e-5
    assert "decline_precision" in df.columns


def test_oracle_keys_are_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 55


@pytest.mark.parametrize("name", ["policy_eval", "decision_mix", "band_capture", "score_band"])
def test_small_queries_run(spark, sf001, name):
    assert E.queries()[name](spark, sf001).count() > 0
