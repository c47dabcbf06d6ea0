"""Operator 10: token ids as Parquet list columns.

Documents are range-partitioned and sorted by ``doc_id``, encoded, and written as
one Parquet file per range: ids as ``array<int>`` with dictionary pages, the
metadata columns (``doc_id``, ``n_tokens``, ``start_in_part``) delta-encoded by the
version-2 writer, row groups and pages of set sizes, column and offset indexes on.
A reader of metadata never touches the ids, and a filter on ``doc_id`` skips pages
and row groups by their indexes.

Defined results: null text counts as empty (only the end id); an empty table gives
an empty table; equal ``doc_id`` are ordered by their text's hash and then the text,
null ``doc_id`` come first. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutpoint.llm.common import map_slices, raw_texts, shared_path, slices, text_or_empty
from cutpoint.llm.tokens import vocabulary_path, word_ids

END_ID = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000

FILE_SCHEMA = "part int, doc_id long, n_tokens long, start_in_part long, ids array<int>"


def id_lists(chunks: list[bytes]) -> pa.ListArray:
    """int32 lists over the joined little-endian ids."""
    ends = np.cumsum([0] + [len(c) // 4 for c in chunks])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(chunks), "<i4"), pa.int32()))


def encode_sorted(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Rows of the file format, in ascending order within and across partitions."""
    tie = F.xxhash64(text_or_empty())
    ordered = (docs.select("doc_id", "text")
               .repartitionByRange(F.col("doc_id"), tie)
               .sortWithinPartitions("doc_id", tie, "text"))

    def run(batches):
        encode, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            for s in slices(b):
                chunks = [encode(t) + end for t in raw_texts(s)]
                n = np.array([len(c) // 4 for c in chunks], np.int64)
                at = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), s.column(0), pa.array(n), pa.array(at), id_lists(chunks)],
                    names=["part", "doc_id", "n_tokens", "start_in_part", "ids"])

    return ordered.mapInArrow(run, FILE_SCHEMA)


def write(docs: DataFrame, out: str, tokenizer: str | None = None, end_id: int = END_ID,
          row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write the ids of all documents below ``out``."""
    (encode_sorted(docs, tokenizer or vocabulary_path(), end_id).write
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.size", str(page_bytes))
     .option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .parquet(out))


def read(spark: SparkSession, out: str) -> DataFrame:
    """The files' rows: ``FILE_SCHEMA``; select only the columns wanted."""
    return spark.read.schema(FILE_SCHEMA).parquet(out)


def part_offsets(files: DataFrame) -> DataFrame:
    """Ids before each file: one row per file, from the metadata columns alone."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def summarize(files: DataFrame) -> DataFrame:
    """Per document from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    def crc(s: pa.RecordBatch) -> pa.RecordBatch:
        lists = s.column(4)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        ids = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), "<i4").data.cast("B")
        sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [s.column(0), s.column(1), s.column(3), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = map_slices(files, crc, "part int, doc_id long, at long, n_tokens long, ids_crc32 long", column="ids")
    return (rows.join(part_offsets(files), "part")
            .select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def write_and_summarize(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    out = shared_path(spark, "token-files")
    write(docs, out, tokenizer)
    return summarize(read(spark, out))
