"""Word and shingle hashes of whole texts, vectorised over the bytes of many texts.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased; its hash is
a polynomial over random 64-bit letters, so all words of a block follow from one running
sum. A shingle's hash combines ``size`` word hashes. Blocks are cut at white space, so
memory does not follow the longest text.
"""

from __future__ import annotations

import functools

import numpy as np

BLOCK_BYTES = 256 << 10
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * step + mix(np.full(n, seed, np.uint64) * step))


@functools.cache
def letters(seed: int, fold: bool = True) -> np.ndarray:
    """The 64-bit letter of each byte; ``fold`` gives both cases of A-Z the same one."""
    t = keys(seed, 256)
    if fold:
        t[65:91] = t[97:123]
    return t


@functools.cache
def _powers(seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(keys(seed + 1, 1)[0]) | 1
    up = np.full(1 << bits, base, np.uint64)
    down = np.full(1 << bits, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _block(a: np.ndarray, seed: int, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    space = SPACES[a]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(seed, max(18, int(len(a)).bit_length()))
    run = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(letters(seed, fold)[a] * up[:len(a)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts]), starts


def word_hashes(texts: list[bytes], seed: int = 0, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, bounds): text ``i`` has words ``bounds[i]:bounds[i + 1]``."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    hashes, at, a = [], [], 0
    while a < len(joined):
        b = min(len(joined), a + BLOCK_BYTES)
        while b < len(joined) and not SPACES[joined[b - 1]]:
            step = np.flatnonzero(SPACES[joined[b:b + BLOCK_BYTES]])
            b = min(len(joined), b + (int(step[0]) + 1 if len(step) else BLOCK_BYTES))
        h, s = _block(joined[a:b], seed, fold)
        hashes.append(h)
        at.append(s + a)
        a = b
    return np.concatenate(hashes), np.searchsorted(np.concatenate(at), first)


def shingle_sets(texts: list[bytes], size: int = 5, seed: int = 0) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; of fewer words,
    the whole sequence as one; of none, an empty set."""
    words, bounds = word_hashes(texts, seed)
    times = keys(seed + 2, size) | np.uint64(1)
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k:k + n] * times[k]
    rows = mix(total)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rows[a:b - size + 1]))
        elif b > a:
            short = (words[a:b] * times[:b - a]).sum(dtype=np.uint64) ^ keys(seed + 3, size)[b - a]
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
