"""Registered corpus queries: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cutpoint.llm import (alignment, bpe, convnet, exact_dedup, jaccard, lexical, licenses, outliers, packing,
                          permutation_index, pii, pseudo_likelihood, token_files)
from cutpoint.llm.common import read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(read_table(spark, sf_dir, "documents"))


def op2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(read_table(spark, sf_dir, "documents"))


def op3_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    net = convnet.fit(docs, read_table(spark, sf_dir, "labels"))
    return convnet.score(docs, net).drop("text_hash")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.fit(docs))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(read_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(read_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_summarize(read_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))


def op12_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read_table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_outliers, op3_convnet, op4_bpe, op5_jaccard_join, op6_packing, op7_licenses, op8_pseudo_likelihood, op9_exact_dedup, op10_token_files,
                               op11_alignment, op12_permutation_index, op13_lexical_search)}

ORACLE: dict[str, str] = {"op5_jaccard_join": jaccard.ORACLE, "op9_exact_dedup": exact_dedup.ORACLE,
                          "op13_lexical_search": lexical.ORACLE}
