"""Operator 11: alignment of two tokenizers over inverted pair bitmaps.

Every text is encoded by tokenizer A (byte level) and tokenizer B (pieces), both over
the bytes of a space and the text. Offsets where tokens of both end cut the tokens into
groups; an A and a B token whose byte ranges overlap are linked.

* **Encoding.** A cut in front of a run of spaces or line ends, or between a word and a mark, is
  certain in both tokenizers: A's own split rule never spans it, and no piece of B holds the two
  characters side by side (looked up in the vocabulary when the file is loaded). So a text is
  cut into fragments there, and the tokens, groups and links of a fragment are computed once
  and kept in a cache of bounded size. Nothing else is assumed: a fragment whose token bytes
  differ from its own sends the whole text through both libraries.
* **Inverted pair bitmaps.** Documents get places in chunks of bounded size. Within a
  chunk each (A id, B id) pair has a compressed bitmap of the places that hold it, the
  union (OR) of the bitmaps of its documents: sorted 16-bit places, or plain bits where
  these are shorter. Multiplicity planes hold how often a place has the link: plane j is the
  j-th bit of (links - 1), one bit per set place.
* **Counts.** Chunks share no documents, so the popcount of a pair's bitmap over the corpus
  is the sum of its chunks' popcounts, added up on the map side first.
* **Scores.** The counts join the postings' keys on the pair and return to their chunks, where they
  meet the bitmaps and planes, which give each place its sums. A's highest counts are one row per A id,
  bounded by the vocabulary, and are the only thing broadcast.

What is shuffled is one row per pair and chunk, not one per link or per document and pair.

Defined results: texts that are null or empty, or whose joined A or B bytes differ from space
and text (the mark of B's space inside a text, for one), have no tokens: zeros and an empty
``groups_sha256``, and they count for no pair; an empty table gives no rows; repeated rows are
documents of their own; texts of any length are encoded whole; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import bound_batches, raw_texts, slices, store
from cutpoint.llm.tokens import Generations, byte_letters, load, merger, vocabulary_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: A chunk ends at so many documents (16-bit places) or links, whichever comes first; a longer
#: document ends its chunk.
CHUNK_DOCS = 1 << 14
CHUNK_LINKS = 4_000_000
#: Fragments kept per cache generation, and the longest one kept.
KEPT_FRAGMENTS = 150_000
KEPT_LENGTH = 64

#: White space other than space and line end, by any of the libraries' readings: what follows
#: it stays in its fragment.
OTHER_SPACE = "\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Letters that every library takes for letters.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
FRAGMENTS = f"[ \n]*+(?:[^ \n{OTHER_SPACE}]++|[{OTHER_SPACE}][ \n]*+)++|[ \n]++"
SPACE_MARK = "\u2581"

ROW_SCHEMA = ("chunk long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, a int, b int, n_docs int, bits binary, planes binary, chunk_docs int")
DOC_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
POSTING_COLUMNS = ["chunk", "a", "b", "n_docs", "bits", "planes", "chunk_docs"]
RESULT_SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")


class Refused(Exception):
    """Token bytes differ from the text's."""


class Aligner:
    """Both tokenizers of a pair of files, and the cache of aligned fragments."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = load(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        value = {c: b for b, c in enumerate(byte_letters())}
        names = sorted(self.a.get_vocab().items(), key=lambda x: x[1])
        self.a_bytes = {i: bytes(value.get(c, 0) for c in t) for t, i in names}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.width = len(pieces)
        # What B's pieces allow: bytes stand alone, so only the others can span a cut.
        shown = [p.replace(SPACE_MARK, " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.cuts = not any(re.search("[^ \n][ \n]", p) for p in shown)
        joined = {m for p in shown for m in re.findall(f"(?<=[{LETTER}])[^{LETTER}]", p)}
        #: Marks that no piece joins to a letter in front of them, nor does A's split rule.
        marks = "".join(re.escape(c) for c in string.punctuation if c != "'" and c not in joined)
        self.split = re.compile(f"[ \n]*+[{LETTER}]++(?=[{marks}])|{FRAGMENTS}" if marks else FRAGMENTS).findall
        #: One space and a word, which A's split rule leaves whole.
        self.plain = re.compile(f" [{LETTER}]+").fullmatch
        self.letters, self.merge = byte_letters(), merger(a_path, word_end=False)
        #: A piece of its own that no piece joins with a line end: B's prefix in front of a fragment.
        self.anchor = self.b.encode("x")
        self.kept = Generations(self._fragment, KEPT_FRAGMENTS)

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """A and B ids of a fragment, or of a space and a whole text."""
        if self.plain(text):
            letters = self.letters
            a = [t.id for t in self.merge.tokenize("".join([letters[c] for c in text.encode()]))]
        else:
            a = self.a.encode(text, add_special_tokens=False).ids
        if text[0] == " ":
            return a, self.b.encode(text[1:])
        b = self.b.encode("x" + text)
        if b[:len(self.anchor)] != self.anchor:
            raise Refused
        return a, b[len(self.anchor):]

    def align(self, text: str) -> tuple[int, bytes, bytes]:
        """(A tokens, groups as text, link pairs as 32-bit integers a * width + b)."""
        a, b = self.tokens(text)
        whole = text.encode()
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            raise Refused
        groups, pairs = [], array("I")
        i = j = i0 = j0 = 0
        a_end, b_end, width = len(a_parts[0]), len(b_parts[0]), self.width
        while True:
            pairs.append(a[i] * width + b[j])           # both ranges go on here: they overlap
            if a_end == b_end:
                groups.append(",".join(map(str, a[i0:i + 1])) + "|" + ",".join(map(str, b[j0:j + 1])))
                i, j = i + 1, j + 1
                i0, j0 = i, j
                if i == len(a):
                    break
                a_end += len(a_parts[i])
                b_end += len(b_parts[j])
            elif a_end < b_end:
                i += 1
                a_end += len(a_parts[i])
            else:
                j += 1
                b_end += len(b_parts[j])
        return len(a), ";".join(groups).encode(), pairs.tobytes()

    def _fragment(self, text: str) -> tuple[int, bytes, bytes] | None:
        try:
            return self.align(text)
        except Refused:
            return None

    def __call__(self, text: bytes) -> tuple[int, bytes, bytes] | None:
        """The same of a space and a whole text; None where it has no tokens."""
        if not text:
            return None
        whole = " " + text.decode()
        if self.cuts:
            kept = self.kept
            parts = [kept[f] if len(f) <= KEPT_LENGTH else self._fragment(f) for f in self.split(whole)]
            if None not in parts:
                n, groups, pairs = zip(*parts)
                return sum(n), b";".join(groups), b"".join(pairs)
        return self._fragment(whole)


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One pair of encoders, and so one cache, per worker process."""
    return Aligner(a_path, b_path)


def runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def plane_width(n: np.ndarray) -> np.ndarray:
    """Bytes of one plane over n set places."""
    return (n + 7) // 8


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])


def is_dense(n_docs: np.ndarray, chunk_docs: np.ndarray | int) -> np.ndarray:
    """Whether plain bits over the chunk are shorter than 16-bit places."""
    return 16 * n_docs.astype(np.int64) > chunk_docs


def postings(pairs: np.ndarray, places: np.ndarray, chunk_docs: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(pair, places set, bitmap, planes) of each distinct pair of one chunk's links."""
    entry, count = np.unique((pairs.astype(np.uint64) << np.uint64(16)) | places.astype(np.uint64), return_counts=True)
    pair, place, extra = (entry >> np.uint64(16)).astype(np.int64), (entry & np.uint64(0xFFFF)).astype(np.int64), count - 1
    own, first, n = np.unique(pair, return_index=True, return_counts=True)
    owner, rank = np.repeat(np.arange(len(own)), n), runs(n)

    dense = is_dense(n, chunk_docs)
    size = np.where(dense, plane_width(np.array(chunk_docs)), 2 * n)
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    thin = ~dense[owner]
    spot = at[owner[thin]] + 2 * rank[thin]
    data[spot], data[spot + 1] = place[thin] & 255, place[thin] >> 8
    full = dense[owner]
    np.bitwise_or.at(data, at[owner[full]] + place[full] // 8, (1 << (place[full] % 8)).astype(np.uint8))
    bits = binaries(data, size)

    top = np.maximum.reduceat(extra, first) if len(own) else extra
    depth = np.ceil(np.log2(top + 1)).astype(np.int64)          # planes that hold the largest value
    wide = plane_width(n)
    size = depth * wide
    at = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for j in range(int(depth.max(initial=0))):
        on = (extra >> j) & 1 == 1
        o, r = owner[on], rank[on]
        np.bitwise_or.at(data, at[o] + j * wide[o] + r // 8, (1 << (r % 8)).astype(np.uint8))
    return own, n, bits, binaries(data, size)


def read_postings(n_docs: np.ndarray, bits: list[bytes], planes: list[bytes], chunk_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posting, place, links) of every set bit of one chunk's postings."""
    n = n_docs.astype(np.int64)
    dense = is_dense(n, chunk_docs)
    thin = np.flatnonzero(~dense)
    full = np.flatnonzero(dense)
    owner, place = [np.repeat(thin, n[thin])], [np.frombuffer(b"".join([bits[i] for i in thin]), "<u2").astype(np.int64)]
    for i in full:
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bits[i], np.uint8), bitorder="little")[:chunk_docs])
        owner.append(np.full(len(found), i))
        place.append(found)
    order = np.concatenate([thin, full])
    wide, size = plane_width(n[order]), np.array([len(planes[i]) for i in order], np.int64)
    data = np.frombuffer(b"".join([planes[i] for i in order]), np.uint8)
    at, rank, spot = np.cumsum(size) - size, runs(n[order]), np.repeat(np.arange(len(order)), n[order])
    links = np.ones(int(n.sum()), np.int64)
    depth = size // np.maximum(1, wide)
    for j in range(int(depth.max(initial=0))):
        on = np.flatnonzero(depth[spot] > j)
        o, r = spot[on], rank[on]
        links[on] += ((data[at[o] + j * wide[o] + r // 8].astype(np.int64) >> (r % 8)) & 1) << j
    return np.concatenate(owner), np.concatenate(place), links


class Chunk:
    """Documents and links gathered until the chunk is full."""

    def __init__(self):
        self.rows, self.pairs, self.sizes, self.links = [], [], [], 0

    def add(self, doc_id, found) -> None:
        n_a, groups, pairs = found if found is not None else (0, b"", b"")
        n_groups, links = groups.count(b"|"), len(pairs) // 4
        # Ids are parted by commas within each side of a group.
        n_b = groups.count(b",") + 2 * n_groups - n_a
        self.rows.append((doc_id, n_a, n_b, n_groups, links, hashlib.sha256(groups).hexdigest() if found is not None else ""))
        self.pairs.append(pairs)
        self.sizes.append(links)
        self.links += links

    def full(self, chunk_docs: int) -> bool:
        return len(self.rows) >= chunk_docs or self.links >= CHUNK_LINKS

    def batches(self, chunk: int, width: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n = len(self.rows)
        doc = dict(zip(DOC_COLUMNS, map(list, zip(*self.rows)))) | {"chunk": [chunk] * n, "place": list(range(n))}
        yield fitted(doc, n, schema)
        if self.links:
            places = np.repeat(np.arange(n), self.sizes)
            pair, set_places, bits, planes = postings(np.frombuffer(b"".join(self.pairs), "<u4"), places, n)
            k = len(pair)
            table = {"chunk": np.full(k, chunk), "a": pair // width, "b": pair % width, "n_docs": set_places, "bits": bits,
                     "planes": planes, "chunk_docs": np.full(k, n)}
            whole = fitted(table, k, schema)
            for a in range(0, k, 8192):
                yield whole.slice(a, 8192)


def fitted(columns: dict, n: int, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of ``schema``; columns that are not given are null."""
    return pa.RecordBatch.from_arrays(
        [(columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)) if f.name in columns
         else pa.nulls(n, f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def index(docs: DataFrame, a_path: str, b_path: str, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Rows of ``ROW_SCHEMA``: one per document (``a`` null), and one per pair and chunk."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, schema = aligner(a_path, b_path), arrow_schema(ROW_SCHEMA)
        part, made, chunk = TaskContext.get().partitionId(), 0, Chunk()
        for b in batches:
            for s in slices(b):
                for doc_id, text in zip(s.column(0).to_pylist(), raw_texts(s), strict=True):
                    chunk.add(doc_id, own(text))
                    if chunk.full(chunk_docs):
                        yield from chunk.batches((part << 32) + made, own.width, schema)
                        made, chunk = made + 1, Chunk()
        if chunk.rows:
            yield from chunk.batches((part << 32) + made, own.width, schema)

    return docs.select("doc_id", "text").mapInArrow(run, ROW_SCHEMA)


def pair_counts(posted: DataFrame) -> DataFrame:
    """``a, b, n``: the documents of the corpus that hold each linked pair."""
    return posted.groupBy("a", "b").agg(F.sum(F.col("n_docs").cast("long")).alias("n"))


def scores(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """Per document the result columns. ``judged`` has ``n`` and ``best`` of each (a, b). Only the
    keys of the postings meet it; bitmaps and planes go to their chunk once."""
    schema = arrow_schema(RESULT_SCHEMA)

    def run(held: pa.Table, counts: pa.Table) -> pa.Table:
        is_doc = pc.is_null(held.column("a"))
        docs, post = held.filter(is_doc).combine_chunks(), held.filter(pc.invert(is_doc)).combine_chunks()
        place, size = docs.column("place").to_numpy(), docs.num_rows
        best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if post.num_rows:
            key, asked = (t.column(a).to_numpy().astype(np.int64) << 32 | t.column(b).to_numpy()
                          for t, a, b in ((post, "a", "b"), (counts, "of_a", "of_b")))
            order = np.argsort(asked)
            spot = order[np.searchsorted(asked, key, sorter=order)]
            owner, at, links = read_postings(post.column("n_docs").to_numpy(), post.column("bits").to_pylist(),
                                             post.column("planes").to_pylist(), size)
            spot = spot[owner]
            n, top = counts.column("n").to_numpy()[spot], counts.column("best").to_numpy(zero_copy_only=False)[spot]
            np.add.at(total, at, links * n)
            np.add.at(best, at[top], links[top])
        columns = {c: docs.column(c) for c in docs.column_names}
        columns |= {"n_best": pa.array(best[place]), "count_sum": pa.array(total[place])}
        return pa.Table.from_arrays([columns[f.name] for f in schema], schema=schema)

    keys = rows.where(F.col("a").isNotNull()).select("chunk", "a", "b")
    # New names: both sides stem from one table.
    counts = keys.join(judged, ["a", "b"]).select(F.col("chunk").alias("own"), F.col("a").alias("of_a"),
                                                  F.col("b").alias("of_b"), "n", "best")
    return rows.groupBy("chunk").cogroup(counts.groupBy("own")).applyInArrow(run, RESULT_SCHEMA)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    rows = store(index(docs, a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE), chunk_docs), "pair-index")
    posted = rows.where(F.col("a").isNotNull()).select(*POSTING_COLUMNS)
    counts = store(pair_counts(posted), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))                 # one row per A id at most
    judged = (counts.join(F.broadcast(highest), "a")
              .select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best")))
    return scores(rows, judged)


def links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """The alignment table itself: ``a, b, n`` (documents) and ``links`` (occurrences, from the planes)."""
    rows = store(index(docs, a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE)), "pair-index")
    posted = rows.where(F.col("a").isNotNull()).select(*POSTING_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in batches:
            n, sizes = s.column(3).to_numpy(), s.column(6).to_numpy()
            total = np.zeros(s.num_rows, np.int64)
            for chunk_docs in np.unique(sizes):
                own = np.flatnonzero(sizes == chunk_docs)
                part = s.take(pa.array(own))
                owner, _, links = read_postings(n[own], part.column(4).to_pylist(), part.column(5).to_pylist(), int(chunk_docs))
                np.add.at(total, own[owner], links)
            yield pa.RecordBatch.from_arrays([s.column(1), s.column(2), pa.array(n.astype(np.int64)), pa.array(total)],
                                             names=["a", "b", "n", "links"])

    return (posted.mapInArrow(run, "a int, b int, n long, links long").groupBy("a", "b")
            .agg(F.sum("n").alias("n"), F.sum("links").alias("links")))
