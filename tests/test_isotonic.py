"""Distributed isotonic fit against pool-adjacent-violators, and the as-of join against bisection."""
import bisect
import random

import numpy as np
import pytest

from cutpoint.operators import isotonic, prefix


def pava(points):
    """Increasing fit of (x, total, weight) in order: one value per point."""
    stack = []
    for x, t, w in points:
        stack.append([t, w, [x]])
        while len(stack) > 1 and stack[-2][0] / stack[-2][1] >= stack[-1][0] / stack[-1][1]:
            t2, w2, x2 = stack.pop()
            stack[-1] = [stack[-1][0] + t2, stack[-1][1] + w2, stack[-1][2] + x2]
    return {x: t / w for t, w, xs in stack for x in xs}


def cases():
    rng = random.Random(9)
    yield "noisy", [(rng.random(), int(rng.random() < 0.3), rng.randrange(1, 5)) for _ in range(600)]
    yield "falling", [(i / 300, int(i < 150), 1) for i in range(300)]
    yield "saw", [((k * 200 + i) / 1000, int(rng.random() < i / 200), 1) for k in range(4) for i in range(200)]
    yield "rising", [(i / 200, int(i > 100), 2) for i in range(200)]
    yield "ties", [(rng.randrange(8) / 8, int(rng.random() < 0.5), 1) for _ in range(500)]
    yield "one", [(0.5, 1, 3)]


def points_of(rows):
    sums = {}
    for x, y, w in rows:
        t, v = sums.get(x, (0, 0))
        sums[x] = (t + y * w, v + w)
    return [(x, *sums[x]) for x in sorted(sums)]


@pytest.mark.parametrize("name,rows", list(cases()))
@pytest.mark.parametrize("buckets,fan", [(1, 16), (13, 2), (40, 5)])
def test_fit_equals_pava(spark, name, rows, buckets, fan):
    cal = spark.createDataFrame(rows, "score double, label int, n int").repartition(3)
    want = pava(points_of(rows))
    xs = sorted(want)
    segments = isotonic.fit(cal, weight="n", buckets=buckets, fan=fan)
    asked = sorted({*xs, -1.0, 2.0, *[(a + b) / 2 for a, b in zip(xs, xs[1:])]})
    ev = spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "id int, score double")
    got = {r.id: r.score for r in isotonic.apply(segments, ev, buckets=buckets).collect()}
    ref = np.interp(asked, xs, [want[x] for x in xs])
    assert np.allclose([got[i] for i in range(len(asked))], ref, rtol=0, atol=1e-12)
    starts = sorted((r.x_from, r.x_to) for r in segments.collect())
    assert starts[0][0] == -np.inf and starts[-1][1] == np.inf
    assert all(a[1] == b[0] for a, b in zip(starts, starts[1:]))


def test_blocks_rise_strictly_and_keep_the_weight(spark):
    rows = dict(cases())["noisy"]
    points = spark.createDataFrame(points_of(rows), "x double, total long, weight long")
    got = sorted(map(tuple, isotonic.blocks(points.selectExpr("x", "double(total) total", "double(weight) weight"), 11, 3)
                     .select("x_first", "total", "weight").collect()))
    means = [t / w for _, t, w in got]
    assert all(a < b for a, b in zip(means, means[1:]))
    assert sum(w for *_, w in got) == sum(w for *_, w in rows)


def test_no_rows_no_segments(spark):
    cal = spark.createDataFrame([], "score double, label int")
    segments = isotonic.fit(cal)
    assert segments.count() == 0
    ev = spark.createDataFrame([(1, 0.5)], "id int, score double")
    assert isotonic.apply(segments, ev).collect()[0].score is None


def test_pool_merges_equal_means():
    first = isotonic.pool(np.array([0.0, 0, 1, 2, 1, 3]), np.array([1.0, 1, 2, 4, 1, 3]))
    assert first.tolist() == [0, 2, 4]


@pytest.mark.parametrize("buckets", [1, 5, 30])
def test_as_of_equals_bisection(spark, buckets):
    rng = random.Random(3)
    keys = sorted({rng.randrange(1000) / 7 for _ in range(60)})
    asked = sorted({rng.randrange(-50, 1200) / 7 for _ in range(300)} | set(keys[:5]))
    table = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "at double, v string")
    df = spark.createDataFrame([(k, i) for i, k in enumerate(asked)], "k double, i int")
    got = prefix.as_of(df, "k", table, "at", buckets)
    assert got.columns == ["k", "i", "at", "v"]
    for r in got.collect():
        j = bisect.bisect_right(keys, r.k) - 1
        assert (r.at, r.v) == ((keys[j], f"v{j}") if j >= 0 else (None, None))
    assert got.count() == len(asked)
