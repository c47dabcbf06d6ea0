import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from cutpoint.llm import outliers

SCHEMA = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType())
                       for n in ("doc_id", "text", "lang", "source", "x", "key")])


def frame(spark, texts, lang="en", source="s"):
    return spark.createDataFrame([(i, t, lang, source, "x", None) for i, t in enumerate(texts)], SCHEMA)


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again),
            len(w) < 10 or 100 * len(again) > 20 * len(w)]


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(2)
    bits = ["a", "A", "é", "🙂", "#", "|", "<b>", "\n", "\n", " ", " ", "\t", "\r", "word", "x y z"]
    texts = [None, "", " \n\t", "a b c d e a b c d e", "a a a a a a a a a a a a", "line\nline\n\n\n line\nline ", "x" * 200_000]
    texts += ["".join(rng.choices(bits, k=rng.randrange(1, 80))) for _ in range(400)]
    got = {r.doc_id: r for r in outliers.judge(frame(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == brute(t), repr(t)
        assert not (r.kept and r.base_failed)
    assert outliers.judge(frame(spark, [])).count() == 0


def test_mcd_ignores_outliers():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, outliers.P))
    x[:120] += 25
    mean, cov = outliers.fast_mcd(x)
    assert np.abs(mean).max() < 0.3
    d = outliers.distances(x, mean, cov)
    assert d[:120].min() > d[120:].max()


def test_distributed_estimate_finds_the_bulk(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, outliers.P)) * 2
    x[:300] += 30
    rows = spark.createDataFrame([("k", r.tolist(), i) for i, r in enumerate(x)], "key string, x array<double>, deal long")
    sizes = spark.createDataFrame([("k", 1500)], "key string, n long")
    start = outliers.chunk_starts(rows, sizes)
    e = outliers.concentrate(rows, sizes, start).first()
    inverse = np.zeros((outliers.P, outliers.P))
    inverse[outliers.UPPER] = e.inverse
    inverse = inverse + np.triu(inverse, 1).T
    assert np.abs(np.array(e.mean)).max() < 0.6
    d = np.einsum("ni,ij,nj->n", x - e.mean, inverse, x - e.mean)
    assert d[:300].min() > d[300:].max()
    # The same step by hand: the nearest share of the rows, up to a bin's edge.
    s = start.first()
    first = np.zeros((outliers.P, outliers.P))
    first[outliers.UPPER] = s.inverse
    first = first + np.triu(first, 1).T
    bins = np.floor(outliers.BINS * np.log2(np.einsum("ni,ij,nj->n", x - s.mean, first, x - s.mean) + 1e-9))
    near = x[bins <= np.sort(bins)[int(np.ceil(outliers.SHARE * 1500)) - 1]]
    assert np.allclose(near.mean(axis=0), e.mean) and np.allclose(np.linalg.inv(outliers.covariance(near)), inverse)


def test_verdict_against_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = outliers.judge(docs).join(labels.groupBy("doc_id").min("quality"), "doc_id").withColumnRenamed("min(quality)", "y").collect()
    fine = [r.kept for r in rows if r.y == 1 and not r.base_failed]
    junk = [r.kept for r in rows if r.y == 0]
    assert np.mean(fine) > 0.995 and np.mean(junk) < 0.05


def by_hand(x, steps=outliers.STEPS):
    """(rows, mean, covariance over the scale) of one group that fits a chunk."""
    mean, cov = outliers.fast_mcd(x[np.lexsort(x.T)])
    bins = lambda: np.floor(outliers.BINS * np.log2(outliers.distances(x, mean, cov) + 1e-9))
    upto = lambda b, share: np.sort(b)[int(np.ceil(share * len(x))) - 1]
    for _ in range(steps):
        b = bins()
        near = x[b <= upto(b, outliers.SHARE)]
        mean, cov = near.mean(axis=0), outliers.covariance(near)
    return len(x), mean, cov * 2.0 ** (upto(bins(), 0.5) / outliers.BINS) / outliers.chi_square_median()


def test_distances_equal_brute_force(spark):
    """Groups of 1 to 500 rows: each leans on its language, and that on the table."""
    rng = random.Random(7)
    groups = {("en", "a"): 500, ("en", "b"): 40, ("de", "a"): 150, ("fr", None): 1, (None, "z"): 12}
    rows = []
    for (lang, source), n in groups.items():
        for _ in range(n):
            text = " ".join("".join(rng.choices("abcdeF7#", k=rng.randrange(1, 9))) for _ in range(rng.randrange(10, 120)))
            rows.append((len(rows), text, lang, source, "x", None))
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = outliers.vectors(outliers.counts([r[1].encode() for r in rows]))
    ok = np.array([not got[r[0]].base_failed for r in rows])
    assert ok.sum() > 600

    def of(test):
        at = np.array([test(r) for r in rows]) & ok
        return by_hand(x[at]) if at.any() else None

    table = of(lambda r: True)[1:]
    for lang, source in groups:
        up = outliers.blend(of(lambda r: r[2] == lang), table)
        mean, cov = outliers.blend(of(lambda r: (r[2], r[3]) == (lang, source)), up)
        for r, v, passed in zip(rows, x, ok):
            if (r[2], r[3]) == (lang, source) and passed:
                d = outliers.distances(v[None], mean, cov)[0]
                assert abs(got[r[0]].distance - d) <= 1e-6 * max(1.0, d)
                assert got[r[0]].kept == (d <= outliers.CUT)
