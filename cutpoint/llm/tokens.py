"""Word-wise use of a public tokenizer: exact ids of whole texts from cached words.

The vocabulary drops white space before it merges, so the ids of a text are the
ids of its words one after the other, and words repeat. Words are looked up in a
two-generation cache of bounded size; a miss is encoded by the tokenizers library.
"""

from __future__ import annotations

import functools
import json
from array import array

import regex

#: Words and pieces kept per cache generation (two generations each).
KEPT_WORDS = 300_000
KEPT_PIECES = 200_000

#: Letters whose lower case and normal form do not depend on their neighbours.
PLAIN = regex.compile("[!-~¡-įı-ſ]+")
#: Marks that may follow a word and make one piece of their own.
MARKS = ".,;:!?#*$%&|"
MARK_BYTES = MARKS.encode()
#: The file's own split rule.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def load(path: str):
    """The library's tokenizer without truncation and padding."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def packed(ids) -> bytes:
    """Ids as 32-bit integers in the machine's order, little-endian here as in the contract."""
    return array("I", ids).tobytes()


@functools.cache
def spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def merger(path: str, word_end: bool = True):
    """The library's merge model of the file, with or without the word-end mark. Its own
    cache is off: the words and pieces kept here make it useless and its upkeep costs."""
    from tokenizers import models
    model = spec(path)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    end = {"end_of_word_suffix": model["end_of_word_suffix"]} if word_end else {}
    return models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **end)


@functools.cache
def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte:
    printable Latin-1 characters stand for themselves, the others follow from 256."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Generations(dict):
    """A dict that computes missing values and keeps at most two generations."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Ids of whole texts, as little-endian 32-bit integers in bytes."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.model = merger(path)
        self.letters = byte_letters()
        self.pieces = Generations(self._piece, KEPT_PIECES)
        self.words = Generations(self._word, KEPT_WORDS)

    def _piece(self, piece: str) -> bytes:
        # Printable ASCII stands for itself.
        shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return packed([t.id for t in self.model.tokenize(shown)])

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(MARK_BYTES)
        if core.isalpha():                      # of bytes: ASCII letters only
            ids = self.pieces[core.lower().decode()]
            return ids + self.pieces[word[len(core):].decode()] if len(core) < len(word) else ids
        s = word.decode()
        core = s.rstrip(MARKS)
        if core.isalpha() and max(core) <= "\u017f" and "\u0130" not in core:
            ids = self.pieces[core.lower()]
            return ids + self.pieces[s[len(core):]] if len(core) < len(s) else ids
        if "<|" not in s and PLAIN.fullmatch(s):
            return b"".join([self.pieces[p] for p in PIECES.findall(s.lower())])
        return packed(self.tokenizer.encode(s, add_special_tokens=False).ids)

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))


@functools.cache
def word_ids(path: str) -> WordIds:
    """One encoder, and so one cache, per worker process."""
    return WordIds(path)
