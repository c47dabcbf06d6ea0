"""Operator 12: approximate nearest neighbours by a permutation index.

Every vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots in order. Two vectors
that lie close see the pivots in nearly the same order, so the footrule distance between
their orders (how far the pivots' places are apart, an absent pivot at place ``PREFIX``) ranks
candidates; the best of them are reranked by their exact distance.

1. Equal vectors form one class with its ``top + 1`` smallest ids, limited per task before the
   shuffle: a vector carried by a third of all rows is indexed and searched once.
2. The pivots are the vectors with the smallest hashes: a bounded sample of ``PIVOTS`` classes,
   the only thing fitted and the only thing broadcast.
3. The index, one row per class with its order, is stored in blocks of about ``BLOCK_ROWS``.
4. Each block posts its rows in pivot inverted files: for each pivot the places it takes in the
   rows' orders, one byte a row. A query walks the files of all pivots, adding up the
   footrule, keeps the best ``SHARE`` of the block (``LEAST`` at least) and reranks these in
   double precision. Blocks of queries meet blocks of rows as groups of bounded size; a
   block returns ``top + 1`` rows a query.
5. A window merges the blocks of each query vector, and rows asking for it drop themselves.

Every row is indexed and each candidate of every block is ranked: nothing is passed over but what
the footrule ranks low. Recall at 10 against brute force: see the tests (0.9 is the floor).

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take
no part, nor do rows with a null ``vec_id``; vectors of different lengths are an error; a row
repeated with its ``vec_id`` and vector counts once; rows that share the query's ``vec_id`` are
never its neighbours; equal distances go by the smaller ``vec_id``; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.llm.common import bound_batches, first_by_hash, store

TOP = 10
#: A query's own rows are those whose id is divisible by this.
QUERY_EVERY = 100
#: Pivots (a byte each in a row's order) and the length of the orders.
PIVOTS = 256
PREFIX = 128
#: Share of each block that is reranked, and the least number of rows.
SHARE = 0.1
LEAST = 256
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096

RESULT_SCHEMA = "vec binary, vec_id long, score double"


def valid(rows: DataFrame) -> DataFrame:
    """``vec_id, vec``: usable rows, the components packed as little-endian doubles."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    kept = rows.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8") + 0.0        # -0.0 becomes 0.0
            ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * 8
            packed = pa.BinaryArray.from_buffers(
                pa.binary(), b.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0), packed], names=["vec_id", "vec"])

    return kept.mapInArrow(pack, "vec_id long, vec binary")


def classes(vectors: DataFrame, top: int = TOP) -> DataFrame:
    """``vec, ids``: one row per distinct vector with its ``top + 1`` smallest ids in order."""
    one = vectors.groupBy("vec", "vec_id").agg(F.count(F.lit(1)).alias("copies"))
    at = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = one.withColumn("at", at).where(F.col("at") <= top + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def matrix(vec: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = vec.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.zeros((0, 1))


def choose_pivots(found: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """The vectors with the smallest hashes."""
    lengths = found.agg(F.min(F.length("vec")).alias("least"), F.max(F.length("vec")).alias("most")).first()
    if lengths.least != lengths.most:
        raise ValueError(f"vectors of {lengths.least // 8} and {lengths.most // 8} components in one table")
    rows = first_by_hash(found, F.xxhash64("vec", F.lit(12)), pivots, "vec").collect()
    return np.frombuffer(b"".join(bytes(r.vec) for r in rows), "<f8").reshape(len(rows), -1)


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int = PREFIX) -> np.ndarray:
    """The numbers of the nearest pivots of each row, nearest first; equal ones by number."""
    far = (pivots ** 2).sum(1)[None] - 2.0 * (x @ pivots.T)
    return np.argsort(far, axis=1, kind="stable")[:, :prefix].astype(np.uint8)


def places(order: np.ndarray, pivots: int) -> np.ndarray:
    """Rows times pivots: the place of each pivot in the row's order, its length if absent."""
    out = np.full((len(order), pivots), order.shape[1], np.uint8)
    np.put_along_axis(out, order.astype(np.int64), np.arange(order.shape[1], dtype=np.uint8)[None], 1)
    return out


def index(found: DataFrame, pivots: np.ndarray, blocks: int, prefix: int = PREFIX) -> DataFrame:
    """``block, vec, ids, perm``: every class with its order of pivots."""
    spread = found.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = orders(matrix(b.column(1)), spread.value, prefix)
            yield b.append_column("perm", pa.array([o.tobytes() for o in order], pa.binary()))

    block = F.pmod(F.xxhash64("vec", F.lit(7)), F.lit(blocks)).cast("int").alias("block")
    return found.select(block, "vec", "ids").mapInArrow(run, "block int, vec binary, ids array<long>, perm binary")


def search_block(rows: tuple[np.ndarray, np.ndarray, list], queries: tuple[np.ndarray, np.ndarray], pivots: int,
                 top: int, share: float, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, distances) of each query's ``top + 1`` nearest rows in the block."""
    x, order, ids = rows
    q, asked = queries
    files = np.ascontiguousarray(places(order, pivots).T)               # one inverted file per pivot
    own = places(asked, pivots)
    wanted = min(len(x), max(least, int(np.ceil(share * len(x)))))
    high, low, apart = (np.empty(len(x), np.uint8) for _ in range(3))
    for i in range(len(q)):
        footrule = np.zeros(len(x), np.uint16)
        for file, place in zip(files, own[i]):
            np.maximum(file, place, out=high)
            np.minimum(file, place, out=low)
            np.subtract(high, low, out=apart)
            np.add(footrule, apart, out=footrule)
        if wanted < len(x):
            # Ties with the last kept footrule stay, so nothing depends on the rows' order.
            best = np.flatnonzero(footrule <= np.partition(footrule, wanted - 1)[wanted - 1])
        else:
            best = np.arange(len(x))
        apart2 = x[best] - q[i]
        distance = np.sqrt((apart2 * apart2).sum(axis=1))
        if len(best) > top + 1:
            near = np.flatnonzero(distance <= np.partition(distance, top)[top])
            best, distance = best[near], distance[near]
        n = np.array([len(ids[k]) for k in best], np.int64)
        member = np.concatenate([np.asarray(ids[k], np.int64) for k in best])
        distance = np.repeat(distance, n)
        first = np.lexsort((member, distance))[:top + 1]
        yield i, member[first], distance[first]


def nearest(indexed: DataFrame, asked: DataFrame, blocks: int, query_blocks: int, pivots: int, top: int = TOP,
            share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``vec, vec_id, score``: of each distinct query vector its ``top + 1`` nearest rows."""
    dealt = F.pmod(F.xxhash64("vec", F.lit(9)), F.lit(query_blocks)).cast("int")
    rows = indexed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = asked.select("vec", "perm", dealt.alias("q_part"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("q_block"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, ids, score = [], [], []
        if left.num_rows and right.num_rows:
            # Rows come in any order; equal distances are settled by ids, so it does not matter.
            perm = [np.frombuffer(b"".join(t.column("perm").to_pylist()), np.uint8).reshape(t.num_rows, -1) for t in (left, right)]
            found = search_block((matrix(left.column("vec")), perm[0], left.column("ids").to_pylist()),
                                 (matrix(right.column("vec")), perm[1]), pivots, top, share, least)
            for i, member, distance in found:
                out += [i] * len(member)
                ids.append(member)
                score.append(distance)
        empty = [np.zeros(0)]
        return pa.Table.from_arrays(
            [right.column("vec").take(pa.array(out, pa.int64())).combine_chunks(), pa.array(np.concatenate(ids or empty).astype(np.int64)),
             pa.array(np.concatenate(score or empty))], names=["vec", "vec_id", "score"])

    hits = rows.groupBy("block", "part").cogroup(queries.groupBy("q_block", "q_part")).applyInArrow(run, RESULT_SCHEMA)
    at = F.row_number().over(Window.partitionBy("vec").orderBy("score", "vec_id"))
    return hits.withColumn("at", at).where(F.col("at") <= top + 1)


def search(table: DataFrame, query_every: int = QUERY_EVERY, top: int = TOP, pivots: int = PIVOTS, prefix: int = PREFIX,
           share: float = SHARE, least: int = LEAST, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose ``vec_id`` is divisible by ``query_every``."""
    spark = table.sparkSession
    bound_batches(spark)
    vectors = store(valid(table), "vectors")
    found = store(classes(vectors, top), "vector-classes")
    count = found.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = -(-count // block_rows)
    chosen = choose_pivots(found, pivots)
    indexed = store(index(found, chosen, blocks, prefix), "permutations")
    # Rows that ask, once each: the class of a hot vector is searched once and answers them all.
    asking = vectors.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), "vec").distinct()
    asked = store(asking.select("vec").distinct().join(indexed.select("vec", "perm"), "vec"), "queries")
    query_blocks = max(1, -(-asked.count() // query_rows))
    hits = nearest(indexed, asked, blocks, query_blocks, len(chosen), top, share, least)
    lists = hits.groupBy("vec").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda h: h["vec_id"] != F.col("query_id")), 1, top)
    return (asking.join(lists, "vec").select("query_id", F.posexplode(others).alias("place", "hit"))
            .select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score"))
