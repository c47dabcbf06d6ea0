"""The corpus pipeline: quality, exact copies, near copies, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each
stage's rows as Parquet to the shared folder and reads them back as the next one's input.
All stages but the last return the columns of ``documents``.

1. ``quality``: documents that the byte-level network rejects go.
2. ``exact_dedup``: of equal texts the smallest ``doc_id`` stays.
3. ``near_dedup``: of each group linked by a five-word-shingle Jaccard of 0.8 or more the
   smallest ``doc_id`` stays.
4. ``pii``: found spans are replaced by their kind.
5. ``packing``: one row per piece in a sequence of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cutpoint.llm import convnet, exact_dedup, jaccard, packing, pii
from cutpoint.llm.common import read_table, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return convnet.keep(docs, convnet.fit(docs, read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", personal_data), ("packing", pack)]

#: A trained network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
