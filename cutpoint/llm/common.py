"""Helpers shared by the corpus operators: tables in the shared folder and Arrow maps."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.session import ensure_checkpoint_dir

#: One run of the white space that separates words (Java and DuckDB syntax alike).
SPACE_RUN = r"[\x20\x09-\x0D]+"

#: Python rows per Arrow slice handled at once, and text bytes per slice: they
#: bound a worker's memory, never what is processed.
SLICE_ROWS = 1024
SLICE_BYTES = 8 << 20


#: What Spark hands to a Python worker at once (and buffers on both sides of the pipe).
BATCH_ROWS = 2048
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
              "spark.sql.execution.arrow.maxBytesPerBatch": SLICE_BYTES}


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to the library's, where they are higher or unset."""
    for key, most in BATCH_CONF.items():
        now = re.match(r"-?\d+", spark.conf.get(key))
        if not now or int(now[0]) <= 0 or int(now[0]) > most:
            spark.conf.set(key, str(most))


def whole(docs: DataFrame, *columns) -> DataFrame:
    """The row as one struct ``row`` beside the given columns: names of the input cannot clash
    with an operator's own. ``select("row.*")`` gives the input's columns back."""
    return docs.select(F.struct("*").alias("row"), *columns)


def first_by_hash(df: DataFrame, hashed, rows: int, *ties) -> DataFrame:
    """The ``rows`` rows with the smallest 64-bit hash: a bounded sample. An ordered limit alone
    would send ``rows`` rows of every task to one; a cut on the hash, widened where it leaves
    too few, lets only about four times ``rows`` through in all."""
    count, widen = df.count(), 4.0
    while True:
        share = widen * rows / max(1, count)
        some = df if share >= 1 else df.where(hashed <= F.lit(int(-2 ** 63 + share * 2 ** 64)).cast("long"))
        if share >= 1 or some.count() >= rows:
            return some.orderBy(hashed, *ties).limit(rows)
        widen *= 4


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage,
    so a lost executor costs a re-read and not a recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into parts of bounded rows and text bytes (one long text may
    exceed the bytes: texts are never cut)."""
    n = batch.num_rows
    i = batch.schema.get_field_index(column)
    while n:
        rows = min(n, SLICE_ROWS)
        while rows > 1 and batch.column(i).slice(0, rows).nbytes > SLICE_BYTES:
            rows //= 2
        yield batch.slice(0, rows)
        batch = batch.slice(rows)
        n -= rows


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
               column: str = "text") -> DataFrame:
    """``mapInArrow`` over bounded slices; ``fn`` turns one slice into one batch."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices(b, column):
                yield fn(s)
    return df.mapInArrow(run, schema)


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    col = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [x or b"" for x in col.cast(kind).to_pylist()]


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
