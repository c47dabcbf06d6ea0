"""Operator 6: first-fit-decreasing packing with a tournament tree of bin capacities.

Every document is encoded whole, ended by one id, and cut into full pieces of the
sequence length and one remainder. Pieces are dealt by a hash of document, place and
content into groups of about ``GROUP_PIECES``; each group is packed on its own: pieces
in falling length, each into the leftmost bin that still holds it, found by walking
down a tree whose nodes hold the largest free capacity below them. Only piece
descriptions are shuffled, never ids or texts.

Defined results: null text counts as empty (only the end id, one piece); an empty
table gives no pieces; repeated rows each get their own piece; other columns are
ignored. Ties in length go by ``doc_id`` (null first), then ``start``, then checksum.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import map_slices, raw_texts
from cutpoint.llm.tokens import vocabulary_path, word_ids

CAPACITY = 4096
END_ID = 2
GROUP_PIECES = 4096

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"


def cut(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece, in the columns of ``PIECE_SCHEMA``."""
    path = tokenizer or vocabulary_path()

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        encode, end = word_ids(path), np.array([end_id], "<u4").tobytes()
        row, start, length, crc, total = [], [], [], [], []
        for i, text in enumerate(raw_texts(s)):
            ids = encode(text) + end
            n = len(ids) // 4
            for a in range(0, n, capacity):
                b = min(n, a + capacity)
                row.append(i)
                start.append(a)
                length.append(b - a)
                crc.append(zlib.crc32(ids[4 * a:4 * b]))
                total.append(n)
        return pa.RecordBatch.from_arrays(
            [s.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return map_slices(docs.select("doc_id", "text"), run, PIECE_SCHEMA)


class Tournament:
    """Free capacity of bins; each inner node holds the larger of its two children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """The leftmost bin with room for ``size``."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < size:
                node += 1
        return node - self.leaves

    def take(self, bin_no: int, size: int) -> int:
        """Fill ``size`` of the bin; returns the free capacity before."""
        free, node = self.free, bin_no + self.leaves
        before = free[node]
        free[node] -= size
        while node > 1:
            node //= 2
            best = max(free[2 * node], free[2 * node + 1])
            if free[node] == best:
                break
            free[node] = best
        return before


def first_fit_decreasing(lengths: np.ndarray, order: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; ``order`` lists the pieces in falling length."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree = Tournament(len(lengths), capacity)
    for i in order.tolist():
        size = int(lengths[i])
        bins[i] = b = tree.first_fit(size)
        offsets[i] = capacity - tree.take(b, size)
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         total: int | None = None) -> DataFrame:
    """Pack pieces (``PIECE_SCHEMA``) into sequences: adds ``sequence_id, offset``.

    ``total`` is the number of pieces, or an estimate; it only sets the number of groups."""
    groups = max(1, -(-(total if total is not None else pieces.count()) // group_pieces))

    def run(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_numpy() for c in ("start", "length", "ids_crc32", "grp")}
        ids = table.column("doc_id")
        known = np.asarray(ids.is_valid())
        doc = ids.fill_null(0).to_numpy()
        order = np.lexsort((cols["ids_crc32"], cols["start"], doc, known, -cols["length"]))
        bins, offsets = first_fit_decreasing(cols["length"], order, capacity)
        return (table.drop_columns(["grp"])
                .append_column("sequence_id", pa.array((cols["grp"].astype(np.int64) << 32) + bins))
                .append_column("offset", pa.array(offsets)))

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(run, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Whole documents to packed pieces; groups are sized by the number of documents."""
    return pack(cut(docs, tokenizer), total=docs.count())
