"""Operator 13: ranked lexical search with bag deduplication.

Every document is restricted to the vocabulary of the items: what remains of it is its
bag, the sorted item terms with their counts, and its length part ``m``. Documents with
the same bag and ``m`` score alike against every item, so they form one class, found by
a 64-bit hash and verified by comparing the bags themselves. Each class is scored once
through the term-to-item lists, and its members are expanded by ascending ``doc_id``.

1. One pass over the texts stores ``doc_id, n, bag``. Texts are split on bytes: every
   separator is ASCII, and all bytes of other characters are term bytes.
2. One pass over the bags gives N, L and the document frequency of each item term.
3. Classes: a hash of (m, bag), a shuffle on it, the ``top`` smallest ids of each class
   (limited per task before the shuffle, so that a bag carried by a third of all rows
   sends ``top`` rows a task).
4. Every task scores its classes and returns its ``top`` best documents of each item;
   a last window merges these.

Items are worked through in blocks of about ``BLOCK_TERMS`` (item, term) pairs, so what is
broadcast (the block's vocabulary and its item lists) has a bound however many items
there are; N and L cover all documents in each block.

Defined results: null and empty texts have no terms, count in neither N nor L and are never
returned; items without terms, or whose terms occur in no document, return nothing; an
empty table of documents or items gives no rows; of equal scores the smaller ``doc_id``
comes first, a null ``doc_id`` last; repeated rows are documents of their own and each may
be returned; repeated items with one ``item_id`` join their terms into one item, and a null
``item_id`` is an item too. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.llm.common import map_slices, raw_texts, slices, store, text_or_empty

TOP = 10
#: (item, term) pairs per block of items; a single longer item is a block of its own.
BLOCK_TERMS = 1_000_000
#: Scores of one batch of classes: classes times items.
SCORE_CELLS = 4_000_000
#: BM25-like constants of the length part.
LENGTH_SHARE = 90

#: Bytes to the byte that stands for them: A-Z in lower case, separators as a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
             for b in range(256))

BAG_SCHEMA = "doc_id long, n long, bag binary"
HIT_SCHEMA = "item int, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, term``."""
    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        row, found = [], []
        for i, t in enumerate(raw_texts(s)):
            own = sorted(set(terms(t)))
            row.extend([i] * len(own))
            found.extend(own)
        return pa.RecordBatch.from_arrays([s.column(0).take(pa.array(row, pa.int64())), pa.array(found, pa.binary())],
                                          names=["item_id", "term"])
    return map_slices(items.select("item_id", "text"), run, "item_id long, term binary").distinct()


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag``: all terms counted in ``n``; ``bag`` holds the item terms as
    little-endian 32-bit pairs (term number, count) in rising term number."""
    spread = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        number, size, out = spread.value.get, [], []
        for t in raw_texts(s):
            words = terms(t)
            size.append(len(words))
            counts = Counter(map(number, words))
            counts.pop(None, None)
            flat = np.array(sorted(counts.items()), "<u4")
            out.append(flat.tobytes())
        return pa.RecordBatch.from_arrays([s.column(0), pa.array(size, pa.int64()), pa.array(out, pa.binary())],
                                          names=["doc_id", "n", "bag"])
    return map_slices(docs.select("doc_id", text_or_empty().alias("text")), run, BAG_SCHEMA)


def statistics(stored: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """(N, L, df per term): one pass over the bags, one row per task and term at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(width, np.int64), 0, 0
        for b in batches:
            n = b.column(0).to_numpy()
            docs += int((n > 0).sum())
            length += int(n.sum())
            flat = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, 2)
            df += np.bincount(flat[:, 0], minlength=width)
        held = np.flatnonzero(df)
        keys = np.concatenate([[-2, -1], held])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([[docs, length], df[held]]))],
                                         names=["term", "k"])

    sums = (stored.select("n", "bag").mapInArrow(run, "term long, k long").groupBy("term").agg(F.sum("k").alias("k")))
    found = {r.term: r.k for r in sums.collect()}
    df = np.zeros(width, np.int64)
    for t, k in found.items():
        if t >= 0:
            df[t] = k
    return found.get(-2, 0), found.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def classes(stored: DataFrame, n_docs: int, length: int, top: int = TOP) -> DataFrame:
    """``m, bag, members``: one row per distinct (m, bag) that holds an item term, with
    the ``top`` smallest ids of its documents in order."""
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {length}L")
    rows = stored.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    rows = rows.withColumn("h", F.xxhash64("m", "bag"))
    # Equal hashes only bring rows together: m and the bag itself decide who is alike.
    same = Window.partitionBy("h", "m", "bag")
    first = rows.withColumn("at", F.row_number().over(same.orderBy(F.col("doc_id").asc_nulls_last())))
    return (first.where(F.col("at") <= top).groupBy("h", "m", "bag")
            .agg(F.sort_array(F.collect_list(F.struct("at", "doc_id"))).getField("doc_id").alias("members"))
            .select("m", "bag", "members"))


class Scorer:
    """Scores classes against all items of a block through term-to-item lists."""

    def __init__(self, weight: np.ndarray, first: np.ndarray, items: np.ndarray, n_items: int, top: int):
        #: Items of term t: ``items[first[t]:first[t + 1]]``.
        self.weight, self.first, self.items, self.n_items, self.top = weight, first, items, n_items, top
        #: Per item its best documents so far, as a heap of (score, order) with the worst in front.
        self.best: list[list[tuple]] = [[] for _ in range(n_items)]
        self.floor = np.ones(n_items, np.int64)

    def scores(self, m: np.ndarray, bag: list[bytes]) -> np.ndarray:
        """Classes times items; integers throughout."""
        sizes = np.array([len(x) // 8 for x in bag], np.int64)
        flat = np.frombuffer(b"".join(bag), "<u4").reshape(-1, 2).astype(np.int64)
        term, tf = flat[:, 0], flat[:, 1]
        own = np.repeat(np.arange(len(bag)), sizes)
        impact = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[own]))
        fan = self.first[term + 1] - self.first[term]
        at = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
        cell = np.repeat(own * self.n_items, fan) + self.items[np.repeat(self.first[term], fan) + at]
        total = np.zeros(len(bag) * self.n_items, np.int64)
        np.add.at(total, cell, np.repeat(impact, fan))
        return total.reshape(len(bag), self.n_items)

    def add(self, m: np.ndarray, bag: list[bytes], members: list[list]) -> None:
        total = self.scores(m, bag)
        for c, i in zip(*np.nonzero(total >= self.floor)):
            heap, score = self.best[i], int(total[c, i])
            for doc in members[c]:
                entry = (score, -math.inf if doc is None else -doc)
                if len(heap) < self.top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    break
            if len(heap) == self.top:
                self.floor[i] = max(1, heap[0][0])

    def rows(self) -> pa.RecordBatch:
        found = [(i, None if d == -math.inf else -d, s) for i, heap in enumerate(self.best) for s, d in heap]
        item, doc, score = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                                          names=["item", "doc_id", "score"])


def best(found: DataFrame, weight: np.ndarray, first: np.ndarray, lists: np.ndarray, n_items: int, top: int) -> DataFrame:
    """``item, doc_id, score, rank`` of the ``top`` documents of each item number."""
    spread = found.sparkSession.sparkContext.broadcast((weight, first, lists))
    rows = max(1, SCORE_CELLS // max(1, n_items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*spread.value, n_items, top)
        for b in batches:
            for s in slices(b, "bag"):
                for a in range(0, s.num_rows, rows):
                    part = s.slice(a, rows)
                    scorer.add(part.column(0).to_numpy(), part.column(1).to_pylist(), part.column(2).to_pylist())
        yield scorer.rows()

    hits = found.select("m", "bag", "members").mapInArrow(run, HIT_SCHEMA)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, pairs: list, top: int) -> DataFrame | None:
    """One block of items, given as (item_id, term) pairs."""
    names = sorted({t for _, t in pairs})
    number = {t: i for i, t in enumerate(names)}
    ids = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i))
    place = {i: k for k, i in enumerate(ids)}
    stored = store(bags(docs, number), "bags")
    n_docs, length, df = statistics(stored, len(names))
    if not n_docs:
        return None
    flat = np.array(sorted((number[t], place[i]) for i, t in pairs), np.int64)
    first = np.searchsorted(flat[:, 0], np.arange(len(names) + 1))
    hits = best(classes(stored, n_docs, length, top), weights(n_docs, df), first, flat[:, 1], len(ids), top)
    spark = docs.sparkSession
    shown = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")    # at most BLOCK_TERMS rows
    return hits.join(F.broadcast(shown), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item."""
    spark = docs.sparkSession
    pairs = store(item_terms(items), "item-terms")
    blocks = max(1, -(-pairs.count() // block_terms))
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = None
    for k in range(blocks):
        block = [(r.item_id, bytes(r.term)) for r in dealt.where(F.col("block") == k).collect()]
        found = search_block(docs, block, top) if block else None
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


#: The separators of terms as a class for DuckDB's expressions.
SEPARATORS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_transform(regexp_extract_all(coalesce(text, ''), '{SEPARATORS}'),
                        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS words
  FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(words))::BIGINT AS total FROM d WHERE len(words) > 0),
i AS (SELECT DISTINCT item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '{SEPARATORS}'),
        lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
      FROM benchmark),
v AS (SELECT DISTINCT term FROM i),
o AS (SELECT r, unnest(words) AS term FROM d),
t AS (SELECT o.r, o.term, count(*) AS tf FROM o JOIN v USING (term) GROUP BY o.r, o.term),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, c),
p AS (
  SELECT t.r, t.term,
         w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * len(d.words) * c.n_docs) // c.total))) AS part
  FROM t JOIN w USING (term) JOIN d USING (r), c),
s AS (SELECT i.item_id, d.doc_id, p.r, sum(p.part)::BIGINT AS score
      FROM i JOIN p USING (term) JOIN d USING (r) GROUP BY i.item_id, d.doc_id, p.r),
k AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
