"""Operator 8: masked pseudo-likelihood with a bidirectional window network in numpy.

Every word of a document is predicted from the two words on either side; the sum of the
logarithms of those conditional probabilities scores the document.

* Vocabulary: words of all documents are counted; the ``KNOWN`` most frequent ones get ids of
  their own, every other word falls into one of ``OTHERS`` buckets by its hash. Words are
  runs of bytes other than white space, A-Z in lower case, known by 64-bit hashes.
* Network: embeddings of the four neighbours, one hidden layer, and a two-step output (the
  word's class, then the word within its class), so a token costs two short rows.
* Words in buckets: the whole table of word counts belongs to the model, so it grows with the
  corpus. Such a word's probability is its bucket's times ``(n + SMOOTH) / (bucket's n + SMOOTH *
  (bucket's words + 1))``; the one more is the outcome "a word never counted". Counts of up to
  ``FREQUENT`` words are known to every task; all others reach the documents by a join on the word,
  of one row per document and distinct word.
* Texts are read twice: for the counts, and to be stored as numbers (two bytes a word), which all
  rounds and the scores read.
* Training: every place of every document is learned once. The places are dealt by hash over
  ``EVERY`` rounds; in a round every task runs stochastic descent over the round's places of all
  its documents, the tasks' networks are averaged by the places they saw, and the average starts
  the next round. Steps are whole batches; what is left over waits for the next step, and a
  task's last, short batch moves the network in proportion to its places. What is gathered grows
  with the number of tasks and so with the corpus; the network itself has a fixed size.

Defined results: null and blank texts have no tokens, log-likelihood 0 and null means; an empty
table gives an empty table; a single word is predicted from padding alone; repeated rows score
alike up to the order of float sums; a null ``doc_id`` stays null; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm import shingles
from cutpoint.llm.common import map_slices, raw_texts, shared_path, slices, store
from cutpoint.llm.tables import gather

CLASSES = 64
IN_CLASS = 64
OTHERS = 256
KNOWN = CLASSES * IN_CLASS - OTHERS
PAD = CLASSES * IN_CLASS
SIDE = 2
EMBED = 16
HIDDEN = 32

ROUNDS = 2
#: The rounds take turns in the places: each learns one in EVERY of them.
EVERY = ROUNDS
BATCH = 512
RATE = 1.0
SEED = 8
#: Added to every word's count within its bucket.
SMOOTH = 0.5
#: Words, at most, whose counts every task holds: the most frequent ones.
FREQUENT = 1 << 17
#: Distinct words a task holds before it sends its counts on.
HELD_WORDS = 1 << 20
#: Tokens predicted at once.
BLOCK = 1 << 14
#: Rows of outputs handled while they are in the processor's cache.
PART = 1 << 10
#: Exponents beyond which a row of outputs is shifted before it is raised.
SAFE = 60.0
#: Places of a class up to which a step computes it together with other classes.
FEW = 4


class Net(NamedTuple):
    embed: np.ndarray        # (PAD + 1, EMBED)
    hidden: np.ndarray       # (2 * SIDE * EMBED, HIDDEN)
    hidden_shift: np.ndarray
    classes: np.ndarray      # (HIDDEN, CLASSES)
    class_shift: np.ndarray
    words: np.ndarray        # (CLASSES, HIDDEN, IN_CLASS)
    word_shift: np.ndarray   # (CLASSES, IN_CLASS)


SHAPES = ((PAD + 1, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,),
          (CLASSES, HIDDEN, IN_CLASS), (CLASSES, IN_CLASS))


def start(counts: np.ndarray, seed: int = SEED) -> Net:
    """A network that knows the corpus's word counts (one for each id) and nothing else."""
    rng = np.random.default_rng(seed)
    scales = (0.1, 0.1, 0, 0.05, 0, 0.05, 0)
    net = Net(*((rng.standard_normal(s) * k).astype(np.float32) for s, k in zip(SHAPES, scales, strict=True)))
    share = (counts + 0.5).reshape(CLASSES, IN_CLASS)
    net.class_shift[...] = np.log(share.sum(axis=1) / share.sum())
    net.word_shift[...] = np.log(share / share.sum(axis=1, keepdims=True))
    return net


def flat(net: Net) -> np.ndarray:
    return np.concatenate([w.ravel() for w in net])


def shaped(values: np.ndarray) -> Net:
    ends = np.cumsum([int(np.prod(s)) for s in SHAPES])
    return Net(*(v.reshape(s).astype(np.float32) for v, s in zip(np.split(values[:ends[-1]], ends[:-1]), SHAPES, strict=True)))


WORDS = "word long, n long"


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word (by its hash) occurs in all documents."""
    def run(batches):
        held, size = [], 0

        def sums():
            words = np.concatenate([w for w, _ in held])
            values, where = np.unique(words, return_inverse=True)
            return values, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)

        for b in batches:
            for s in slices(b):
                words, _ = shingles.word_hashes(raw_texts(s))
                held.append(np.unique(words, return_counts=True))
                size += len(held[-1][0])
                if size > HELD_WORDS:
                    held = [sums()]
                    size = len(held[0][0])
                    if 2 * size > HELD_WORDS:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "n"])
                        held, size = [], 0
        if held:
            words, n = sums()
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    return (docs.select("doc_id", "text").mapInArrow(run, WORDS)
            .groupBy("word").agg(F.sum("n").alias("n")))


class Places:
    """Where words lie in a sorted list of hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sorted, self.known = np.append(hashes, np.uint64(2**64 - 1)), len(hashes)
        # Where the hashes that begin with each 16 bits or more lie, and how many at most begin alike.
        bits = max(16, self.known.bit_length())
        self.rest = np.uint64(64 - bits)
        edges = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.rest)
        self.first = edges.astype(np.int32)
        self.alike = int(np.diff(edges, append=self.known).max())

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place, and whether it is in the list at all."""
        at = self.first.take(hashes >> self.rest)
        for _ in range(self.alike):
            at += self.sorted.take(at) < hashes
        return at, (self.sorted[at] == hashes) & (at < self.known)


class Vocabulary:
    """Ids of word hashes: rank by frequency for known words, a bucket for the others;
    ``counts`` has the corpus's count of each id, ``distinct`` the number of words of each bucket
    and ``table`` the path of all words' counts (without it, buckets are scored as wholes).
    ``frequent``: words, in ascending order, and their counts, which need not be looked up there."""

    def __init__(self, ranked: np.ndarray, counts: np.ndarray, distinct: np.ndarray | None = None, table: str | None = None,
                 frequent: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.int64))):
        self.counts, self.distinct, self.table = counts, distinct, table
        order = np.argsort(ranked)
        self.places = Places(ranked[order])
        self.ids = np.append(order, 0).astype(np.int32)
        self.frequent = Places(frequent[0])
        self.logs = np.append(np.log(frequent[1] + SMOOTH), 0.0)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at, hit = self.places(hashes)
        return np.where(hit, self.ids[at], KNOWN + (hashes & np.uint64(OTHERS - 1)).astype(np.int32))

    def log_counts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logarithm of each frequent word's smoothed count, 0 for others; which are frequent."""
        at, hit = self.frequent(hashes)
        return np.where(hit, self.logs.take(at), 0.0), hit


def most_frequent(words: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` words of a table of counts, in ascending order, and their counts: all words
    from a count on, found by a short list of how many words have which size of count."""
    level = F.floor(4 * F.log2("n"))
    sizes = sorted(words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), reverse=True)
    total = np.cumsum([r.words for r in sizes])
    taken = [r.level for r, n in zip(sizes, total, strict=True) if n <= most]
    if not taken:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found = words.where(level >= taken[-1]).toArrow()
    word, n = found.column("word").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(word)
    return word[order], n[order]


def vocabulary(docs: DataFrame, known: int = KNOWN, frequent: int = FREQUENT) -> Vocabulary:
    spark, table = docs.sparkSession, shared_path(docs.sparkSession, "words")
    word_counts(docs).write.parquet(table)
    words = spark.read.schema(WORDS).parquet(table)
    top = words.orderBy(F.desc("n"), "word").limit(known).collect()
    ranked = np.array([r.word for r in top], np.int64).view(np.uint64)
    counts = np.zeros(PAD)
    counts[:len(top)] = [r.n for r in top]
    buckets = words.groupBy(F.col("word").bitwiseAND(OTHERS - 1).alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    distinct = np.zeros(OTHERS)
    for r in buckets:
        counts[KNOWN + r.bucket], distinct[r.bucket] = r.n, r.words
    own = (ranked & np.uint64(OTHERS - 1)).astype(np.int64)
    np.subtract.at(counts, KNOWN + own, counts[:len(top)])
    np.subtract.at(distinct, own, 1)
    return Vocabulary(ranked, counts, distinct, table, most_frequent(words, frequent))


def neighbours(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ids of the SIDE places before and after each token, PAD outside its document."""
    n = len(ids)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.full((n, 2 * SIDE), PAD, np.int16)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        a, b = max(0, -step), n - max(0, step)
        if a < b:
            same = doc[a:b] == doc[a + step:b + step]
            out[a:b, k] = np.where(same, ids[a + step:b + step], PAD)
    return out


def _bounded(z: np.ndarray) -> np.ndarray:
    """``z``, its rows shifted in place where exp(z) could overflow or vanish: in a row only
    differences matter."""
    if not (z.max(initial=0) < SAFE and z.min(initial=0) > -SAFE):
        z -= z.max(axis=1, keepdims=True)
    return z


def _log_shares(z: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The logarithm of each row's share of its column ``own`` among exp(z); overwrites ``z``."""
    total = _bounded(z).take(np.arange(len(z)) * z.shape[1] + own)
    np.exp(z, out=z)
    return total - np.log(z @ np.ones(z.shape[1], z.dtype))


def log_probabilities(net: Net, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    """The logarithm of each token's probability given its neighbours."""
    out = np.empty(len(ids))
    for a in range(0, len(ids), BLOCK):
        # In the order of classes, so that each class's words are one run.
        kind, word = np.divmod(ids[a:a + BLOCK].astype(np.int16), np.int16(IN_CLASS))
        order = np.argsort(kind, kind="stable")
        kind, word, near = kind[order], word[order], around[a:a + BLOCK][order]
        p = np.empty(len(kind))
        ends = np.searchsorted(kind, np.arange(CLASSES + 1))
        h = np.empty((len(kind), HIDDEN), net.hidden.dtype)
        for i in range(0, len(kind), PART):
            j = i + PART
            x = net.embed.take(near[i:j], axis=0).reshape(-1, 2 * SIDE * EMBED) @ net.hidden
            x += net.hidden_shift
            np.tanh(x, out=h[i:j])
            z = h[i:j] @ net.classes
            z += net.class_shift
            p[i:j] = _log_shares(z, kind[i:j])
        for c in range(CLASSES):
            for i in range(ends[c], ends[c + 1], PART):
                j = min(i + PART, ends[c + 1])
                z = h[i:j] @ net.words[c]
                z += net.word_shift[c]
                p[i:j] += _log_shares(z, word[i:j])
        out[a + order] = p
    return out


def _slots(x: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The first rows of ``x`` at their slots, FEW a class; zero elsewhere."""
    out = np.zeros((CLASSES * FEW, x.shape[1]), x.dtype)
    out[slot] = x[:len(slot)]
    return out.reshape(CLASSES, FEW, -1)


def learn(net: Net, ids: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One step of plain descent on a batch's mean loss, in place."""
    n = len(ids)
    # Places in the order of their classes: first those of classes with up to FEW places, which are
    # computed together, FEW slots a class; then the others, one run a class.
    kind = (ids // IN_CLASS).astype(np.int16)
    counts = np.bincount(kind, minlength=CLASSES)
    many = counts > FEW
    ranked = np.argsort(many, kind="stable")
    begin = np.empty(CLASSES, np.int64)
    begin[ranked] = np.cumsum(counts[ranked]) - counts[ranked]
    order = np.argsort(kind + many.take(kind) * np.int16(CLASSES), kind="stable")
    kind, word, around = kind.take(order), ids.take(order) % IN_CLASS, around.take(order, axis=0)
    large = np.flatnonzero(many)
    few = int(n - counts[large].sum())
    runs = list(zip(large.tolist(), begin[large].tolist(), (begin + counts)[large].tolist(), strict=True))
    rows = np.arange(n)
    slot = (np.arange(CLASSES) * FEW - begin).take(kind[:few]) + rows[:few]

    x = net.embed.take(around, axis=0).reshape(n, -1)
    h = x @ net.hidden
    h += net.hidden_shift
    np.tanh(h, out=h)
    words, held = net.words, _slots(h, slot)
    both = np.empty((2 * n, IN_CLASS), h.dtype)
    kinds, z = both[:n], both[n:]
    np.dot(h, net.classes, out=kinds)
    kinds += net.class_shift
    z[:few] = (held @ words).reshape(-1, IN_CLASS).take(slot, axis=0)
    for c, a, b in runs:
        np.dot(h[a:b], words[c], out=z[a:b])
    z += net.word_shift.take(kind, axis=0)

    # From here on everything is a step: a gradient times the rate.
    np.exp(_bounded(both), out=both)
    both *= (rate / n / (both @ np.ones(IN_CLASS, h.dtype)))[:, None]
    both.reshape(-1)[np.concatenate([rows * CLASSES + kind, (n + rows) * IN_CLASS + word])] -= rate / n
    back, step, ones = kinds @ net.classes.T, _slots(z, slot), np.ones(n, h.dtype)
    back[:few] += (step @ words.transpose(0, 2, 1)).reshape(-1, HIDDEN).take(slot, axis=0)
    words_step, shift_step = held.transpose(0, 2, 1) @ step, step.sum(axis=1)
    for c, a, b in runs:
        back[a:b] += z[a:b] @ words[c].T
        np.dot(h[a:b].T, z[a:b], out=words_step[c])
        np.dot(ones[a:b], z[a:b], out=shift_step[c])
    words -= words_step
    net.word_shift[...] -= shift_step
    net.classes[...] -= h.T @ kinds
    net.class_shift[...] -= ones @ kinds
    h *= h
    back *= 1 - h
    dx = (back @ net.hidden.T).reshape(-1, EMBED)
    net.hidden[...] -= x.T @ back
    net.hidden_shift[...] -= ones @ back
    # Rare words meet few batches: their embeddings move by the summed, not the mean, step.
    near = around.astype(np.int16).ravel()
    order = np.argsort(near, kind="stable")
    near, dx = near.take(order), dx.take(order, axis=0)
    first = np.ones(len(near), bool)
    np.not_equal(near[1:], near[:-1], out=first[1:])
    first = np.flatnonzero(first)
    # Columns are summed in pairs, as complex numbers: half as many sums.
    moved = np.add.reduceat(dx.view(np.result_type(dx, np.complex64)), first, axis=0).view(dx.dtype)
    moved *= 4
    net.embed[near.take(first)] -= moved


def in_documents(hashes: np.ndarray, bounds: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words among ``others`` (a mask) of each document: words, times, bounds."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[others]
    order = np.lexsort((hashes[others], doc))
    doc, word = doc[order], hashes[others][order]
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1]))[:len(doc)])
    return word[first], np.diff(np.append(first, len(doc))), np.searchsorted(doc[first], np.arange(len(bounds)))


def code_type(every: int) -> str:
    return "<u2" if PAD * every <= 1 << 16 else "<u8"


def encode(docs: DataFrame, vocab: Vocabulary, every: int = EVERY) -> DataFrame:
    """The texts as numbers, stored once for all rounds and the scores: ``row`` (a number of its
    own), ``doc_id``, ``code`` (of each place, its word's id times ``every`` plus the place's turn)
    and, where the vocabulary has a table, of the words in buckets: ``log_counts`` (the sum over
    the frequent ones) and the other distinct ``word``s with their ``times``."""
    words = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        hashes, bounds = shingles.word_hashes(raw_texts(s))
        ids = words.value(hashes)
        place = (np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
        turn = shingles.mix(hashes ^ place) % np.uint64(every)
        code = (ids.astype(np.uint64) * np.uint64(every) + turn).astype(code_type(every))
        columns = {}
        if words.value.table:
            others = ids >= KNOWN
            logs, frequent = words.value.log_counts(hashes[others])
            doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[others]
            others[others] = ~frequent
            word, times, ends = in_documents(hashes, bounds, others)
            ends = pa.array(ends.astype(np.int32))
            columns = {"log_counts": pa.array(np.bincount(doc, logs, len(bounds) - 1).astype(np.float64)),
                       "word": pa.ListArray.from_arrays(ends, pa.array(word.view(np.int64))),
                       "times": pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))}
        ends = (bounds * code.itemsize).astype(np.int32)
        data = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(code)])
        return pa.RecordBatch.from_pydict({"doc_id": s.column(0), "code": data, **columns})

    schema = "doc_id long, code binary" + (", log_counts double, word array<long>, times array<int>" if vocab.table else "")
    coded = map_slices(docs.select("doc_id", "text"), run, schema)
    return store(coded.withColumn("row", F.monotonically_increasing_id()), "coded")


def decode(batch: pa.RecordBatch, every: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, turns and bounds of a batch's places."""
    texts = batch.column(batch.schema.get_field_index("code")).to_pylist()
    code = np.frombuffer(b"".join(texts), code_type(every))
    ids = code // code.dtype.type(every)
    bounds = np.cumsum([0] + [len(x) // code.itemsize for x in texts])
    return ids.astype(np.int32), code - ids * code.dtype.type(every), bounds


def train(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, every: int = EVERY, coded: DataFrame | None = None) -> Net:
    """Rounds of descent in every task, averaged by the number of places seen; with fewer rounds
    than ``every`` there are ``every`` of them, so that each place has its turn. ``coded``: the
    texts as ``encode`` stored them, with the same ``every``."""
    context, net = docs.sparkSession.sparkContext, start(vocab.counts)
    places = (encode(docs, vocab, every) if coded is None else coded).select("code")
    for turn in range(max(rounds, every)):
        before = context.broadcast(flat(net))

        def fill(batches, before=before, turn=turn):
            own, seen, held, size = shaped(before.value.copy()), 0, [], 0
            rate = RATE / (1 + turn)
            for b in batches:
                for s in slices(b, "code"):
                    ids, turns, bounds = decode(s, every)
                    picked = np.flatnonzero(turns == turn % every)
                    held.append((ids.take(picked), neighbours(ids, bounds).take(picked, axis=0)))
                    size += len(held[-1][0])
                    if size >= 16 * BATCH:
                        ids, around = (np.concatenate(x) for x in zip(*held, strict=True))
                        whole = size // BATCH * BATCH
                        for a in range(0, whole, BATCH):
                            learn(own, ids[a:a + BATCH], around[a:a + BATCH], rate)
                        seen += whole
                        held, size = [(ids[whole:], around[whole:])], size - whole
            if size:
                ids, around = (np.concatenate(x) for x in zip(*held, strict=True))
                for a in range(0, size, BATCH):
                    n = min(BATCH, size - a)
                    learn(own, ids[a:a + n], around[a:a + n], rate * n / BATCH)
                seen += size
            return np.append(flat(own).astype(np.float64) * seen, float(seen))

        total = gather(places, fill, "<f4")
        if total[-1]:
            net = shaped(total[:-1] / total[-1])
    return net


def score(docs: DataFrame, vocab: Vocabulary, net: Net, coded: DataFrame | None = None, every: int = EVERY) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, log_likelihood, mean_log_probability, perplexity``.
    ``coded``: the texts as ``encode`` stored them, with the same ``every``."""
    coded = encode(docs, vocab, every) if coded is None else coded
    bucket = np.log(vocab.counts[KNOWN:] + SMOOTH * (vocab.distinct + 1)) if vocab.table else None
    shared = docs.sparkSession.sparkContext.broadcast((net, bucket))

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        own, bucket = shared.value
        ids, _, bounds = decode(s, every)
        each = log_probabilities(own, ids, neighbours(ids, bounds))
        if bucket is not None:
            others = np.flatnonzero(ids >= KNOWN)
            each[others] -= bucket[ids[others] - KNOWN]
        each = np.concatenate([[0.0], np.cumsum(each)])
        total = each[bounds[1:]] - each[bounds[:-1]]
        if bucket is not None:
            total += s.column(3).to_numpy()
        return pa.RecordBatch.from_pydict({
            "row": s.column(0), "doc_id": s.column(1), "n_tokens": pa.array(np.diff(bounds).astype(np.int64)),
            "log_likelihood": pa.array(total)})

    columns = ["row", "doc_id", "code", *(["log_counts"] if vocab.table else [])]
    scored = map_slices(coded.select(*columns), run, "row long, doc_id long, n_tokens long, log_likelihood double", "code")
    scored = (with_word_counts(scored, coded, vocab.table) if vocab.table else scored).drop("row")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("mean_log_probability", mean).withColumn("perplexity", F.exp(-mean))


def with_word_counts(scored: DataFrame, coded: DataFrame, table: str) -> DataFrame:
    """Adds the logarithm of each listed word's smoothed count, as often as it occurs, to its row."""
    counts = scored.sparkSession.read.schema(WORDS).parquet(table)
    listed = coded.select("row", F.inline(F.arrays_zip("word", "times")))
    parts = listed.join(counts, "word", "left").select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"),
        (F.col("times") * F.log(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("log_likelihood"))
    return (scored.unionByName(parts).groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("log_likelihood").alias("log_likelihood")))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Vocabulary, training and scores, all from ``docs``."""
    vocab = vocabulary(docs)
    coded = encode(docs, vocab)
    return score(docs, vocab, train(docs, vocab, coded=coded), coded)
