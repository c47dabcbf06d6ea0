import hashlib
import re

from pyspark.sql import types as T

from cutpoint.llm import exact_dedup

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("digest", T.StringType()), ("keep_id", T.LongType()))])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", 9) for i, t in rows], SCHEMA)


def normal(t):
    return re.sub("[ \t-\r]+", " ", t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[normal(t)] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[normal(t)]), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(i, f"copy  of\none") for i in range(100, 400)] + [(i, f"text {i % 90}") for i in range(400, 700)]
        + [(1, None), (2, ""), (3, " "), (4, "\t\r"), (5, "a b"), (6, "a b"), (6, "a  b"), (None, "a b"), (None, "only"),
           (7, "x" * 200_000), (8, "x" * 200_000)])


def test_annotate_equals_brute_force(spark):
    for support in (0.001, 0.2):
        got = exact_dedup.annotate(frame(spark, ROWS), support)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)
    assert exact_dedup.annotate(frame(spark, [])).count() == 0


def test_dedup_keeps_the_winners_rows(spark):
    for support in (0.001, 0.2):
        got = exact_dedup.dedup(frame(spark, ROWS), support)
        assert got.columns == ["doc_id", "text", "digest", "keep_id"]
        # One row of each text, also where an id is repeated (the contract's "the row ... stays").
        want = sorted({str(x[0]) for x in brute(ROWS) if x[3]})
        rows = got.collect()
        assert sorted(str(r.doc_id) for r in rows) == want
        assert [r.text for r in rows if r.doc_id == 6] == ["a  b"]


def test_winners_are_the_frequent_digests(spark):
    df = frame(spark, ROWS).select("doc_id", exact_dedup.digest().alias("digest"))
    rows = exact_dedup.heavy_winners(df, 0.2).collect()
    assert [(r.keep_id, r.group_size) for r in rows] == [(100, 300)]


def test_no_python_in_the_plan(spark, sf001):
    plan = exact_dedup.annotate(spark.read.parquet(f"{sf001}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
