import random

import numpy as np
import pytest
from pyspark.sql import types as T

from cutpoint.llm import permutation_index as index

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("ids", T.StringType()), ("block", T.LongType()),
    ("label", T.IntegerType()))])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)


def usable(rows):
    kept = {(i, tuple(np.float32(x) + 0.0 for x in v)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)}
    return sorted(kept)


def brute(rows, every=100, top=10):
    kept = usable(rows)
    if not kept:
        return {}
    ids, x = np.array([i for i, _ in kept]), np.array([v for _, v in kept], np.float64)
    out = {}
    for k in np.flatnonzero(ids % every == 0):
        distance = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, distance)) if ids[j] != ids[k]][:top]
        out[int(ids[k])] = [(int(ids[j]), float(distance[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def odd_rows():
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(150)] + [(2000 + i, [float(i % 3), 1.0] + [0.0] * 6) for i in range(60)]
    rows += [(500, None), (501, []), (600, [0.0, -0.0] * 4), (700, [float("nan")] * 8), (800, [float("inf")] + [1.0] * 7),
             (900, [None] + [1.0] * 7), (None, [1.0] * 8)] + [rows[100]] * 3
    return rows


def test_search_equals_brute_force_when_all_candidates_are_reranked(spark):
    rows = odd_rows()
    want = brute(rows)
    assert 1000 in want and 500 not in want
    for kind in ({}, {"block_rows": 50, "query_rows": 3}):
        got = index.search(frame(spark, rows).repartition(4), share=1.0, **kind)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        found = answers(got)
        assert found.keys() == want.keys()
        for q, near in want.items():
            assert [i for i, _ in found[q]] == [i for i, _ in near]
            assert np.allclose([s for _, s in found[q]], [s for _, s in near], rtol=1e-14, atol=0)


@pytest.mark.parametrize("block_rows", [index.BLOCK_ROWS, 700])
def test_recall_on_the_given_vectors(spark, block_rows):
    for sf in ("sf0.01", "sf0.1"):
        table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        want = brute([(r.vec_id, list(r.embedding)) for r in table.collect()])
        found = answers(index.search(table, block_rows=block_rows))
        hit = [len({i for i, _ in found[q]} & {i for i, _ in near}) / len(near) for q, near in want.items()]
        assert found.keys() == want.keys() and np.mean(hit) >= 0.95


def test_footrule_of_places():
    order = index.orders(np.array([[0.0], [2.1]]), np.array([[0.0], [1.0], [2.0], [9.0]]), 2)
    assert order.tolist() == [[0, 1], [2, 1]]
    seen = index.places(order, 4).astype(int)
    assert seen.tolist() == [[0, 1, 2, 2], [2, 1, 0, 2]]
    assert abs(seen[0] - seen[1]).sum() == 4


def test_pivots_are_distinct_vectors_and_bounded(spark):
    found = index.classes(index.valid(frame(spark, odd_rows())))
    chosen = index.choose_pivots(found, 32)
    assert chosen.shape == (32, 8) and len(np.unique(chosen, axis=0)) == 32


def test_few_rows_and_mixed_lengths(spark):
    assert index.search(frame(spark, [])).count() == 0
    assert index.search(frame(spark, [(100, [1.0, 2.0])])).count() == 0
    assert answers(index.search(frame(spark, [(100, [1.0, 2.0]), (7, [1.0, 0.0])]))) == {100: [(7, 2.0)]}
    with pytest.raises(ValueError):
        index.search(frame(spark, [(100, [1.0, 2.0]), (7, [1.0])]))
