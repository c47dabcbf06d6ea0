import math
import random
import re
from collections import Counter

from pyspark.sql import types as T

from cutpoint.llm import lexical

DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("bag", T.StringType()), ("m", T.LongType()), ("h", T.LongType()))])
ITEMS = T.StructType([T.StructField(n, t) for n, t in (
    ("item_id", T.LongType()), ("text", T.StringType()), ("item", T.LongType()), ("term", T.StringType()))])


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "b", 5, 6) for i, t in rows], DOCS)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "t") for i, t in rows], ITEMS)


def terms(text):
    found = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), w) for w in found]


def brute(docs, items, top=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in wanted.items():
        scores = []
        for doc, c, n in held:
            m = 10 + (90 * n * n_docs) // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if s > 0:
                scores.append((-s, doc is None, doc))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, doc, -s) for r, (s, _, doc) in enumerate(scores[:top])]
    return sorted(out, key=str)


def case():
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "délta", "Éps", "漢字", "x1", "7", "the", "of", "zeta", "eta", "theta"]
    docs = [(i, rng.choice([" ", "-", "\n", "_"]).join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(150)]
    docs += [(200 + i, "alpha beta, gamma") for i in range(60)] + [(7, docs[7][1])] * 3
    docs += [(500, None), (501, ""), (502, "--- \x7f"), (None, "alpha beta, gamma"), (503, "ALPHA " * 30_000)]
    items = [(0, "alpha BETA beta"), (1, "délta Éps éps 漢字"), (2, "nowhere"), (3, None), (4, ""), (5, "x1 of the"),
             (5, "7 zeta"), (None, "theta"), (6, " ".join(words))]
    return docs, items


def test_search_equals_brute_force(spark):
    docs, items = case()
    want = brute(docs, items)
    assert len(want) >= 50
    for block in (lexical.BLOCK_TERMS, 4):
        got = lexical.search(docs_frame(spark, docs).repartition(5), items_frame(spark, items), block_terms=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_one_class_per_bag_with_its_smallest_ids(spark):
    docs = docs_frame(spark, [(i, "alpha other") for i in range(90, 0, -1)] + [(100, "alpha alpha"), (101, "none here")])
    stored = lexical.bags(docs, {b"alpha": 0})
    rows = lexical.classes(stored, 92, 184, 3).collect()
    assert sorted((r.m, bytes(r.bag).hex(), r.members) for r in rows) == [
        (100, "0000000001000000", [1, 2, 3]), (100, "0000000002000000", [100])]


def test_empty_tables(spark):
    docs, items = case()
    assert lexical.search(docs_frame(spark, []), items_frame(spark, items)).count() == 0
    assert lexical.search(docs_frame(spark, docs), items_frame(spark, [])).count() == 0
    assert lexical.search(docs_frame(spark, [(1, None)]), items_frame(spark, items)).count() == 0
