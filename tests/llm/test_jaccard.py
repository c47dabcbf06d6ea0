import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from cutpoint.llm import components, jaccard, shingles

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("node", T.StringType()), ("label", T.LongType()))])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "n", 1) for i, t in rows], SCHEMA)


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def shingle_set(t):
    w = words(t)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return sorted(((i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common = rng.choices(vocab, k=40)
    rows = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.choice([1, 3, 5, 6, 9, 30, 80, 200])) + (common if rng.random() < .5 else [])
        for _ in range(rng.choice([1, 2, 8, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < .2:
                w = w[:rng.randrange(1, len(w) + 1)]
            rows.append(" ".join(x.upper() if rng.random() < .1 else x for x in w))
    rows += [None, "", " \t\n", rows[0], rows[0], "x" * 300_000, "Ä b c d e f", "ä b c d e f"]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows)) + [(None, rows[1]), (ids[2], rows[2])]


@pytest.mark.parametrize("seed,few", [(1, 2), (2, 0), (3, 2)])
def test_components_equal_brute_force(spark, monkeypatch, seed, few):
    monkeypatch.setattr(jaccard, "FEW_PAIRS", few)
    rows = corpus(seed)
    got = jaccard.near_duplicates(frame(spark, rows)).drop("text_hash")
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_dedup_keeps_the_smallest_of_each_component(spark):
    rows = [(i, t) for i, t in corpus(4) if i is not None]
    got = jaccard.dedup(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "node", "label"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, n, c in brute(rows) if i == c)
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0


def test_prefix_lengths_suffice():
    for n in range(1, 60):
        for m in range(n, 60):
            need = -(-4 * (n + m) // 9)
            if m * 4 <= n * 5:
                assert n - need + 1 <= n - -(-8 * n // 9) + 1 and m - need + 1 <= jaccard.probe_length(m)


def test_shingles_across_blocks(monkeypatch):
    rng = random.Random(0)
    texts = [" ".join("".join(rng.choices("abAB", k=rng.randrange(1, 40))) for _ in range(rng.randrange(0, 60))).encode() for _ in range(50)]
    whole = shingles.shingle_sets(texts)
    monkeypatch.setattr(shingles, "BLOCK_BYTES", 64)
    cut = shingles.shingle_sets(texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))
    assert [len(s) for s in whole] == [len(shingle_set(t.decode())) for t in texts]


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
