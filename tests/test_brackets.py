"""Bracketed quantiles, PSI bins and the KS maximum against numpy and brute force."""
import random

import numpy as np
import pytest

from cutpoint.operators import brackets as B
from cutpoint.operators import monitor


def columns():
    rng = random.Random(6)
    yield "one", [0.25]
    yield "ties", [rng.randrange(5) / 4 for _ in range(500)]
    yield "hot", [0.5] * 3000 + [rng.random() for _ in range(1500)]
    yield "wide", [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 4) for _ in range(4000)]
    yield "same", [7.0] * 90


@pytest.mark.parametrize("name,values", list(columns()))
@pytest.mark.parametrize("accuracy", [B.ACCURACY, 1000])
def test_quantiles_match_numpy(spark, name, values, accuracy, monkeypatch):
    monkeypatch.setattr(B, "ACCURACY", accuracy)
    monkeypatch.setattr(B, "LADDER", tuple(2.0 * 10 ** k / accuracy for k in range(3)))
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(3)
    qs = [0.0, 0.05, 0.5, 0.95, 0.99, 1.0]
    got = {r["q"]: r["value"] for r in B.quantiles(df, "x", qs).collect()}
    assert [got[q] for q in qs] == pytest.approx(np.quantile(values, qs).tolist(), abs=1e-12)


def test_brackets_are_narrow_on_many_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "ACCURACY", 1000)
    monkeypatch.setattr(B, "LADDER", (0.002, 0.02, 0.2))
    df = spark.range(20_000).selectExpr("double(id * 7919 % 20000) AS x")
    known = B._sketch(df, df["x"], [0.5, 0.9], ())
    cells = B._cells(df, df["x"], known, 4, ())
    assert cells.count() < 400 and cells.agg({"__c": "sum"}).first()[0] == 20_000
    got = {r["q"]: r["value"] for r in B.quantiles(df, "x", [0.5, 0.9]).collect()}
    assert got == pytest.approx({0.5: 9999.5, 0.9: 17999.1})


def test_quantiles_by_group_with_a_null_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.random()) for _ in range(700)] + [("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["q"]): r["value"] for r in B.quantiles(df, "x", [0.1, 0.5], by=["g"]).collect() if r["g"]}
    for g in "abc":
        x = [v for k, v in rows if k == g]
        assert [got[g, q] for q in (0.1, 0.5)] == pytest.approx(np.quantile(x, [0.1, 0.5]).tolist())


def test_bad_values_fail(spark):
    df = spark.createDataFrame([(0.5, "ref"), (float("nan"), "cur"), (None, "cur")], "score double, pop string")
    with pytest.raises(Exception, match="2 rows have a null or NaN score"):
        B.quantiles(df, "score", [0.5]).collect()
    for f in (lambda: B.psi_bins(df, "pop", [0.0, 0.5, 1.0]), lambda: B.ks(df, "pop")):
        with pytest.raises(Exception, match="2 rows have a null or NaN score"):
            f().collect()


def pairs():
    rng = random.Random(8)
    yield "shifted", [rng.gauss(0, 1) for _ in range(900)], [rng.gauss(0.3, 1.2) for _ in range(700)]
    yield "same", [rng.randrange(9) / 8 for _ in range(400)], [rng.randrange(9) / 8 for _ in range(300)]
    yield "apart", [0.1, 0.2, 0.2], [0.8, 0.9]
    yield "hot", [0.5] * 500 + [rng.random() for _ in range(200)], [0.5] * 100 + [rng.random() for _ in range(500)]


def both(spark, ref, cur):
    return spark.createDataFrame([(x, "ref") for x in ref] + [(x, "cur") for x in cur], "score double, pop string").repartition(4)


@pytest.mark.parametrize("name,ref,cur", list(pairs()))
def test_psi_bins_match_numpy(spark, name, ref, cur):
    qs = monitor.psi_quantiles(10)
    edges = np.quantile(ref, qs)[1:-1]
    want = [[int((np.searchsorted(edges, x, side="right") == k).sum()) for x in (ref, cur)] for k in range(10)]
    got = sorted(map(tuple, B.psi_bins(both(spark, ref, cur), "pop", qs).collect()))
    assert [[r, c] for _, r, c in got] == want


@pytest.mark.parametrize("name,ref,cur", list(pairs()))
@pytest.mark.parametrize("ranges,values", [(B.KS_RANGES, B.KS_VALUES), (4, 3), (2, 1)])
def test_ks_matches_brute_force(spark, name, ref, cur, ranges, values):
    at = np.array(sorted({*ref, *cur}))
    f, g = (np.searchsorted(np.sort(x), at, side="right") / len(x) for x in (ref, cur))
    r = B.ks(both(spark, ref, cur), "pop", ranges=ranges, values=values).first()
    assert r["ks_stat"] == pytest.approx(np.abs(f - g).max(), abs=1e-12)
    assert (r["reference_rows"], r["current_rows"]) == (len(ref), len(cur))


def test_ks_takes_ranges_by_lookup_however_many_are_left(spark):
    """Equal populations leave all 512 ranges to look at: the plan must not grow with them."""
    ref, cur = [k / 4000 for k in range(0, 4000, 2)], [k / 4000 for k in range(1, 4000, 2)]
    df = both(spark, ref, cur)
    aggregates = []
    frame = type(df)
    plain = frame.agg

    def agg(self, *exprs):
        aggregates.append(len(self._jdf.queryExecution().analyzed().toString()))
        return plain(self, *exprs)

    frame.agg = agg
    try:
        r = B.ks(df, "pop").first()
    finally:
        frame.agg = plain
    assert r["ks_stat"] == pytest.approx(1 / 2000, abs=1e-12)
    assert max(aggregates) < 20_000


def test_ks_counts_rows_at_minus_infinity_in_every_round(spark):
    ref = [float("-inf")] * 3 + [k / 50 for k in range(50)]
    cur = [float("-inf")] + [k / 50 + 0.001 for k in range(50)]
    at = np.array(sorted({*ref, *cur}))
    f, g = (np.searchsorted(np.sort(x), at, side="right") / len(x) for x in (ref, cur))
    r = B.ks(both(spark, ref, cur), "pop", ranges=3, values=4).first()
    assert r["ks_stat"] == pytest.approx(np.abs(f - g).max(), abs=1e-12)
