"""Operator 4: BPE encoding and decoding with forced-boundary splitting.

A merge can only join two neighbours whose touching bytes stand side by side inside
some vocabulary token. Byte pairs that occur inside no token are certain cuts: no
merge ever crosses them, so the fragments between cuts are encoded on their own and
their ids put one after the other. Only the fragment that ends a word carries the
word-end mark. Fragments repeat far more often than texts do and are kept in a cache
of bounded size.

Defined results: null text counts as empty (no ids, empty decoded text); an empty
table gives an empty table; texts of any length are encoded whole; other columns are
ignored; repeated rows are encoded alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import map_slices, raw_texts
from cutpoint.llm.token_files import id_lists
from cutpoint.llm.tokens import (KEPT_PIECES, KEPT_WORDS, PIECES, PLAIN, Generations, byte_letters, load, merger,
                                 packed, spec, vocabulary_path)


def inner_pairs(tokens: Iterable[str], suffix: str) -> set[str]:
    """The letter pairs that stand side by side inside some token."""
    pairs: set[str] = set()
    for t in tokens:
        t = t.removesuffix(suffix)
        pairs.update(map("".join, zip(t, t[1:], strict=False)))
    return pairs


def forced_fragments(word: str, pairs: set[str]) -> list[str]:
    """Cut ``word`` wherever two neighbours occur inside no token."""
    out, a = [], 0
    for b in range(1, len(word)):
        if word[b - 1:b + 1] not in pairs:
            out.append(word[a:b])
            a = b
    out.append(word[a:])
    return out


class Codec:
    """Encoder and decoder of one vocabulary file with word-end marks."""

    def __init__(self, path: str):
        model = spec(path)["model"]
        suffix = model["end_of_word_suffix"]
        self.tokenizer = load(path)
        self.letters = byte_letters()
        self.pairs = inner_pairs(model["vocab"], suffix)
        #: At a word's end, and inside a word: the same merges without the mark.
        self.last = merger(path)
        self.inner = merger(path, word_end=False)
        names = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec(path)["added_tokens"]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.fragments = Generations(self._fragment, KEPT_PIECES)
        self.words = Generations(self._word, KEPT_WORDS)

    def _fragment(self, key: tuple[str, bool] | str) -> bytes:
        model, fragment = (self.inner, key[0]) if isinstance(key, tuple) else (self.last, key)
        return packed([t.id for t in model.tokenize(fragment)])

    def _piece(self, piece: str) -> bytes:
        *inner, last = forced_fragments("".join([self.letters[b] for b in piece.encode()]), self.pairs)
        return b"".join([self.fragments[f, False] for f in inner]) + self.fragments[last]

    def _word(self, word: bytes) -> bytes:
        s = word.decode()
        if "<|" in s or not PLAIN.fullmatch(s):
            if any(t in s for t in ("<|startoftext|>", "<|endoftext|>")):
                return packed(self.tokenizer.encode(s, add_special_tokens=False).ids)
            s = self.tokenizer.normalizer.normalize_str(s)
        else:
            s = s.lower()
        return b"".join([self._piece(p) for p in PIECES.findall(s)])

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian 32-bit integers; ``text`` is UTF-8."""
        return b"".join(map(self.words.__getitem__, text.split()))

    def decode(self, ids: Iterable[int]) -> str:
        """Token names joined by spaces: the file states no decoder of its own."""
        return " ".join(map(self.names.__getitem__, ids))


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text."""
    path = tokenizer or vocabulary_path()

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(path)
        return pa.RecordBatch.from_arrays([s.column(0), id_lists([own.encode(t) for t in raw_texts(s)])],
                                          names=["doc_id", "ids"])

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` for a frame with ``doc_id`` and ``ids``."""
    path = tokenizer or vocabulary_path()

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        own, ids = codec(path), s.column(1)
        return pa.RecordBatch.from_arrays(
            [s.column(0), ids, pa.array([own.decode(x or ()) for x in ids.to_pylist()], pa.string())],
            names=["doc_id", "ids", "decoded"])

    return map_slices(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded string", column="ids")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: encode, then decode those ids."""
    return decode(encode(docs, tokenizer), tokenizer)


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` from the round trip's ids and texts."""
    return round_trip(docs, tokenizer).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
