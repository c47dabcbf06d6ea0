"""Pipeline stages over tables whose other columns bear the operators' own names."""
import pytest

import corpus_pipeline as P
from cutpoint.llm import exact_dedup

SF = "/root/testdata/sf0.001"
OWN = ("_text", "_some", "_clean", "_digest", "_heavy", "_keep", "_lost", "_lost_id", "_hash", "digest", "heavy", "keep",
       "lost", "lost_id", "id", "hash", "lost_hash", "row", "keep_id", "text_hash", "score", "label", "node", "chunks", "spans")


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    return plain.selectExpr("*", *[f"concat('keep me ', doc_id) AS `{c}`" for c in OWN])


@pytest.mark.parametrize("stage", [f for n, f in P.STAGES[:4]], ids=[n for n, f in P.STAGES[:4]])
def test_stage_passes_columns_of_its_own_names_through(spark, docs, stage):
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns
    want = sorted(map(tuple, stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SF).collect()), key=str)
    rows = got.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == want
    assert all(r[c] == f"keep me {r.doc_id}" for r in rows for c in OWN)


def test_last_stage_ignores_them(spark, docs):
    assert P.pack(spark, docs, SF).count() >= docs.count()


def test_one_of_repeated_rows_stays(spark):
    rows = [(i, f"t{i % 5}") for i in range(20)] + [(3, "t3")] * 4 + [(None, "alone")] * 3 + [(1, "t0")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for support in (0.001, 0.2):
        kept = sorted(map(tuple, exact_dedup.dedup(df, support).collect()), key=str)
        assert kept == [(0, "t0"), (1, "t1"), (2, "t2"), (3, "t3"), (4, "t4"), (None, "alone")]
