"""Operator 3: quality classifier, a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover the whole text. Every byte is
embedded, learned filters run over each chunk, their responses are max-pooled per chunk,
and a small hidden layer turns the pooled responses into the chunk's log-odds. A document's
probability is the logistic of its chunks' mean log-odds.

Only the training sample is bounded (``SAMPLE_ROWS`` labelled documents, ``SAMPLE_CHUNKS``
chunks of each, spread over the whole text); scoring reads every byte of every document.

Defined results: null and empty texts are one empty chunk and get that chunk's score; an
empty table gives an empty table; without labelled rows of both classes every document gets
the same score, the share of label 1 (a half without any); labels that are null are not
used, of repeated labels of a document the smallest counts; a null ``doc_id`` is scored and
not held out; other columns are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import first_by_hash, map_slices, raw_texts

CHUNK = 256
STEP = 224
WIDTH = 8
STRIDE = 2
EMBED = 8
FILTERS = 32
HIDDEN = 16

SAMPLE_ROWS = 4000
SAMPLE_CHUNKS = 6
STEPS = 2000
BATCH = 64
RATE = 0.004
SEED = 20

FOLDS = 5
CUT = 0.3


class Net(NamedTuple):
    embed: np.ndarray    # (257, EMBED), row 0 is padding and stays 0
    filters: np.ndarray  # (WIDTH * EMBED, FILTERS)
    shift: np.ndarray
    hidden: np.ndarray   # (FILTERS + 1, HIDDEN), the last input is the filled share
    hidden_shift: np.ndarray
    out: np.ndarray
    out_shift: np.ndarray


def start(seed: int = SEED) -> Net:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    embed = normal(257, EMBED, scale=0.5)
    embed[0] = 0
    return Net(embed, normal(WIDTH * EMBED, FILTERS, scale=0.25), np.zeros(FILTERS, np.float32),
               normal(FILTERS + 1, HIDDEN, scale=0.2), np.zeros(HIDDEN, np.float32),
               normal(HIDDEN, scale=0.3), np.zeros(1, np.float32))


def chunk_starts(size: int) -> range:
    """Starts of the chunks that cover ``size`` bytes, one at least."""
    return range(0, max(1, size - (CHUNK - STEP)), STEP)


def chunk_matrix(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(byte ids from 1 with 0 as padding, lengths)."""
    lengths = np.array([len(c) for c in chunks], np.int64)
    ids = np.zeros((len(chunks), CHUNK), np.int64)
    flat = np.frombuffer(b"".join(chunks), np.uint8)
    ids[np.arange(CHUNK) < lengths[:, None]] = flat.astype(np.int64) + 1
    return ids, lengths


def _responses(net: Net, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, filter responses) at every stride; windows that begin past the end are 0."""
    x = net.embed[ids]
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)[:, ::STRIDE]
    windows = view.transpose(0, 1, 3, 2).reshape(len(ids), -1, WIDTH * EMBED)
    y = np.maximum(windows.reshape(-1, WIDTH * EMBED) @ net.filters + net.shift, 0).reshape(len(ids), -1, FILTERS)
    y[np.arange(y.shape[1]) * STRIDE >= lengths[:, None]] = 0
    return windows, y


def _head(net: Net, pooled: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inputs = np.concatenate([pooled, (lengths / CHUNK).astype(np.float32)[:, None]], axis=1)
    h = np.tanh(inputs @ net.hidden + net.hidden_shift)
    return inputs, h, h @ net.out + net.out_shift[0]


def chunk_logits(net: Net, chunks: list[bytes]) -> np.ndarray:
    parts = []
    for a in range(0, len(chunks), 256):
        ids, lengths = chunk_matrix(chunks[a:a + 256])
        _, y = _responses(net, ids, lengths)
        parts.append(_head(net, y.max(axis=1), lengths)[2])
    return np.concatenate(parts)


def gradients(net: Net, ids: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> Net:
    """Of the mean log loss over the chunks."""
    windows, y = _responses(net, ids, lengths)
    best = y.argmax(axis=1)
    pooled = np.take_along_axis(y, best[:, None], axis=1)[:, 0]
    inputs, h, logit = _head(net, pooled, lengths)
    d = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
    dh = d[:, None] * net.out * (1 - h * h)
    dp = (dh @ net.hidden.T)[:, :FILTERS] * (pooled > 0)
    row = np.arange(len(ids))[:, None]
    picked = windows[row, best]                                    # (batch, FILTERS, WIDTH * EMBED)
    dw = np.einsum("bf,bfk->kf", dp, picked, optimize=True)
    dx = (dp[:, :, None] * net.filters.T).reshape(len(ids), FILTERS, WIDTH, EMBED)
    at = ids[row[:, :, None], (best * STRIDE)[:, :, None] + np.arange(WIDTH)]
    de = np.zeros_like(net.embed)
    np.add.at(de, at.reshape(-1), dx.reshape(-1, EMBED))
    de[0] = 0
    return Net(de, dw, dp.sum(0), inputs.T @ dh, dh.sum(0), h.T @ d, d.sum(keepdims=True))


def train(chunks: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Net:
    """Adam over shuffled batches, with a falling rate; deterministic."""
    net, rng = start(seed), np.random.default_rng(seed + 1)
    ids, lengths = chunk_matrix(chunks)
    ids, labels = ids.astype(np.int16), labels.astype(np.float32)
    m, v = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net]
    order = np.empty(0, np.int64)
    for t in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(chunks))
        rows, order = order[:BATCH], order[BATCH:]
        for k, g in enumerate(gradients(net, ids[rows].astype(np.int64), lengths[rows], labels[rows])):
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.001 * (g * g - v[k])
            net[k][...] -= RATE * (1 - (t - 1) / steps) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-7)
    return net


def remainder(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(chunks, labels, document numbers) of at most ``rows`` labelled documents outside the
    held-out fold, chosen by a hash of their id."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(remainder() != 0)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    chosen = first_by_hash(known, F.xxhash64("doc_id"), rows, "doc_id")
    chosen = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)

    def cut(s: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in raw_texts(s):
            starts = chunk_starts(len(text))
            at = sorted({int(x) for x in np.linspace(0, len(starts) - 1, SAMPLE_CHUNKS)})
            out.append([text[starts[k]:starts[k] + CHUNK] for k in at])
        return pa.RecordBatch.from_arrays([s.column(0), s.column(2), s.column(3), pa.array(out, pa.list_(pa.binary()))],
                                          names=["doc_id", "quality", "text_hash", "chunks"])

    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    cuts = map_slices(found.select("doc_id", "text", F.col("quality").cast("int"), F.xxhash64("text").alias("text_hash")), cut,
                      "doc_id long, quality int, text_hash long, chunks array<binary>")
    # A repeated id is one document: one row of it is chosen before anything goes to the driver.
    one = cuts.groupBy("doc_id").agg(F.min(F.struct("text_hash", "quality", "chunks")).alias("r")).select("doc_id", "r.*")
    got = sorted((r.doc_id, bytes(c), r.quality) for r in one.collect() for c in r.chunks)
    return ([c for _, c, _ in got], np.array([q for *_, q in got], np.int64), np.array([i for i, *_ in got], np.int64))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Net | float:
    """A trained network, or a constant probability where the sample has one class only."""
    chunks, y, _ = sample(docs, labels, rows)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    return train(chunks, (y > 0).astype(np.float32))


def document_scores(net: Net | float, texts: list[bytes]) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    chunks, counts = [], []
    for t in texts:
        starts = chunk_starts(len(t))
        chunks += [t[a:a + CHUNK] for a in starts]
        counts.append(len(starts))
    logits = chunk_logits(net, chunks).astype(np.float64)
    first = np.cumsum([0, *counts[:-1]])
    return np.round(1 / (1 + np.exp(-np.add.reduceat(logits, first) / counts)), 6)


def score(docs: DataFrame, net: Net | float, cut: float = CUT) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``, and ``text_hash``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [s.column(0), pa.array(document_scores(shared.value, raw_texts(s))), s.column(2)],
            names=["doc_id", "score", "text_hash"])

    scored = map_slices(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run,
                        "doc_id long, score double, text_hash long")
    return scored.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"), "text_hash")


def keep(docs: DataFrame, net: Net | float, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the network accepts, all columns unchanged; one pass, no shuffle."""
    names, types = docs.columns, docs.schema
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        return s.filter(pa.array(document_scores(shared.value, raw_texts(s)) >= cut))

    return map_slices(docs.select(*names), run, types)
