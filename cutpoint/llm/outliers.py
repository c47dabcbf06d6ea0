"""Operator 2: quality rules and robust multivariate outliers.

Base rules count words, symbols, repeated lines and repeated five-word windows of every
whole text. Rows that pass them are described by a vector of transformed statistics, and
minimum-covariance-determinant (MCD) estimates of each language and source say how far a row
lies from the bulk; a large Mahalanobis distance rejects it.

The MCD follows the nested plan for large samples: a group is dealt by hash into chunks of
about ``CHUNK_ROWS``, each chunk is solved on its own (random starts, concentration steps),
the solution of least determinant starts concentration steps over the whole group. Those are
aggregates: a histogram of distances finds the nearest ``SHARE`` of the rows, and their sums
give the next mean and covariance. No group is gathered in one task.

Estimates exist for each language and source, each language, and the whole table, each scaled so that
its group's median distance is that of the chi-square law. A row is judged by its language and
source; with n rows that estimate has the weight n / (n + ``PRIOR_ROWS``), and the language's,
weighted against the table's in the same way, has the rest: large groups stand on their own,
small ones lean on their parent, and no row count changes the method. Every variance has a
floor, so a statistic that hardly varies cannot reject a row by a trifle.

``CUT`` lies far beyond the chi-square law's tail: texts of different length and kind are no normal
sample, and ordinary long ones reach squared distances of some hundreds.

Defined results: null and blank texts have no words and fail the base rules; null ``lang`` and
``source`` are groups of their own; where no row passes the base rules there is no estimate (and
none is needed); an empty table gives an empty table; repeated rows count as rows;
a null ``doc_id`` is treated like any other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.llm import shingles
from cutpoint.llm.common import map_slices, raw_texts, store

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Statistics of the vector, in order, and the floor of each one's standard deviation.
FLOORS = {"log_words": 1.0, "word_length": 0.25, "symbols": 0.1, "capitals": 0.12, "repeats": 0.3,
          "same_lines": 0.5, "variety": 0.1, "digits": 0.5}
P = len(FLOORS)

CHUNK_ROWS = 2000
#: Rows that a group's parent counts as against the group's own.
PRIOR_ROWS = 200
SHARE = 0.75
STARTS = 30
STEPS = 2
BINS = 8
#: Rejected beyond this squared distance (median scaled to the chi-square median).
CUT = 450.0

STATS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "lang string, source string, x array<double>")


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return run[first[1:]] - run[first[:-1]]


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a window of five found at least twice."""
    n = len(hashes) - WINDOW + 1
    if n < 2:
        return 0
    times = shingles.keys(11, WINDOW) | np.uint64(1)
    rows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rows += hashes[k:k + n] * times[k]
    order = np.argsort(shingles.mix(rows), kind="stable")
    same = rows[order][1:] == rows[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(again), 1)
    np.add.at(cover, np.flatnonzero(again) + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def line_counts(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)."""
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines), len(lines) - len(set(lines))


def counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts and further counts of whole texts."""
    a = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum([0] + [len(t) for t in texts])
    shown = ~shingles.SPACES[a] & ((a & 0xC0) != 0x80)
    hashes, bounds = shingles.word_hashes(texts, fold=False)
    by = [hashes[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    lines = np.array([line_counts(t) for t in texts], np.int64).reshape(-1, 2)
    return {"n_words": np.diff(bounds).astype(np.int64), "word_chars": _per_text(shown, first),
            "n_symbols": _per_text(SYMBOLS[a], first), "n_dup_lines": lines[:, 1],
            "n_repeat_words": np.array([repeated_words(h) for h in by], np.int64),
            "lines": lines[:, 0], "capitals": _per_text((a >= 65) & (a <= 90), first),
            "digits": _per_text((a >= 48) & (a <= 57), first),
            "distinct": np.array([len(np.unique(h)) for h in by], np.int64)}


def vectors(c: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistics, in the order of ``FLOORS``."""
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([np.log1p(c["n_words"]), np.log(chars / words), np.sqrt(c["n_symbols"] / words),
                     np.sqrt(c["capitals"] / chars), np.sqrt(c["n_repeat_words"] / words),
                     np.sqrt(c["n_dup_lines"] / np.maximum(c["lines"], 1)),
                     np.log1p(c["distinct"]) / np.log1p(words), np.sqrt(c["digits"] / chars)], axis=1)


def statistics(docs: DataFrame) -> DataFrame:
    """``STATS`` of every row: base counts, group columns and the vector ``x``."""
    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        c = counts(raw_texts(s))
        x = vectors(c)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * P, pa.int32()), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays(
            [s.column(0), *(pa.array(c[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
             s.column(2), s.column(3), lists],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lang", "source", "x"])

    return map_slices(docs.select("doc_id", "text", F.col("lang").cast("string"), F.col("source").cast("string")), run, STATS)


def covariance(x: np.ndarray) -> np.ndarray:
    return np.cov(x.T, bias=True) + np.diag(np.square(list(FLOORS.values())))


def distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    return np.square(np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)).sum(axis=0)


def fast_mcd(x: np.ndarray, share: float = SHARE, starts: int = STARTS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(mean, covariance with floors) of the best subset found of ``share`` of the rows."""
    rng, h = np.random.default_rng(seed), max(P + 1, int(np.ceil(share * len(x))))
    h = min(h, len(x))

    def concentrate(mean, cov, steps):
        for _ in range(steps):
            rows = x[np.argpartition(distances(x, mean, cov), h - 1)[:h]]
            mean, cov = rows.mean(axis=0), covariance(rows)
        return np.linalg.slogdet(cov)[1], mean, cov

    first = []
    for _ in range(starts):
        rows = x[rng.choice(len(x), min(len(x), P + 1), replace=False)]
        first.append(concentrate(rows.mean(axis=0), covariance(rows), 2))
    best = [concentrate(m, c, 15) for _, m, c in sorted(first, key=lambda f: f[0])[:4]]
    _, mean, cov = min(best, key=lambda f: f[0])
    return mean, cov


def chi_square_median(p: int = P) -> float:
    return p * (1 - 2 / (9 * p)) ** 3


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def group_keys() -> list:
    """The groups of a row, narrowest first; a null is a value of its own."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null")) for c in ("lang", "source"))
    return [F.concat_ws("|", F.lit("2"), lang, source), F.concat_ws("|", F.lit("1"), lang), F.lit("0")]


def squared_distance(x: str = "x", mean: str = "mean", inverse: str = "inverse") -> str:
    """(x - mean)' inverse (x - mean) as SQL; ``inverse`` lists the upper triangle."""
    terms, k = [], 0
    for i in range(P):
        for j in range(i, P):
            factor = "" if i == j else "2 * "
            terms.append(f"{factor}{inverse}[{k}] * ({x}[{i}] - {mean}[{i}]) * ({x}[{j}] - {mean}[{j}])")
            k += 1
    return " + ".join(terms)


UPPER = np.triu_indices(P)
ESTIMATE = "key string, mean array<double>, inverse array<double>"


def _estimate(key: str, mean: np.ndarray, cov: np.ndarray) -> dict:
    return {"key": key, "mean": mean.tolist(), "inverse": np.linalg.inv(cov)[UPPER].tolist()}


def chunk_starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per group the chunk solution of least determinant (``ESTIMATE``). ``rows`` has ``key``,
    ``x`` and ``deal`` (a hash); ``sizes`` has ``key`` and ``n``."""
    def solve(table: pa.Table) -> pa.Table:
        x = np.array(table.column("x").to_pylist())
        mean, cov = fast_mcd(x[np.lexsort(x.T)])
        e = _estimate("", mean, cov)
        return pa.table({"key": table.column("key").slice(0, 1), "det": [float(np.linalg.slogdet(cov)[1])],
                         "mean": pa.array([e["mean"]], pa.list_(pa.float64())),
                         "inverse": pa.array([e["inverse"]], pa.list_(pa.float64()))})

    dealt = rows.join(sizes, "key").withColumn("chunk", F.pmod("deal", F.ceil(F.col("n") / CHUNK_ROWS))).select("key", "chunk", "x")
    solved = dealt.groupBy("key", "chunk").applyInArrow(solve, "key string, det double, mean array<double>, inverse array<double>")
    return solved.groupBy("key").agg(F.min(F.struct("det", "mean", "inverse")).alias("best")).select("key", "best.mean", "best.inverse")


def _bins(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows with the bin of their distance: ``BINS`` bins for each doubling."""
    return (rows.join(estimate, "key").withColumn("bin", F.floor(BINS * F.log2(F.expr(squared_distance()) + 1e-9)))
            .select("key", "x", "bin"))


def _nearest(binned: DataFrame, sizes: DataFrame, share: float) -> DataFrame:
    """Per group the first bin up to which at least ``share`` of its rows lie. The window
    runs over a group's bins, a number that does not follow its rows."""
    counted = binned.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("c"))
    run = F.sum("c").over(Window.partitionBy("key").orderBy("bin"))
    return (counted.withColumn("run", run).join(sizes, "key").where(F.col("run") >= F.col("n") * share)
            .groupBy("key").agg(F.min("bin").alias("last")))


def concentrate(rows: DataFrame, sizes: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step over whole groups: the next ``ESTIMATE``."""
    binned = _bins(rows, estimate)
    near = binned.join(_nearest(binned, sizes, SHARE), "key").where("bin <= last")
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(P)]
    sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i, j in zip(*UPPER, strict=True)]
    moments = near.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *sums)
    moments = moments.select("key", "n", F.array(*(f"s{i}" for i in range(P))).alias("one"),
                             F.array(*(f"s{i}_{j}" for i, j in zip(*UPPER, strict=True))).alias("two"))

    def solve(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                mean, cov = np.array(r["one"]) / r["n"], np.zeros((P, P))
                cov[UPPER] = np.array(r["two"]) / r["n"]
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
                values, axes = np.linalg.eigh(cov)
                cov = (axes * np.maximum(values, 0)) @ axes.T + np.diag(np.square(list(FLOORS.values())))
                out.append(_estimate(r["key"], mean, cov))
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("mean", pa.list_(pa.float64())),
                                                             ("inverse", pa.list_(pa.float64()))]))
    return moments.mapInArrow(solve, ESTIMATE)


def _full(upper: list[float]) -> np.ndarray:
    out = np.zeros((P, P))
    out[UPPER] = upper
    return out + np.triu(out, 1).T


def blend(child: tuple[int, np.ndarray, np.ndarray], parent: tuple[np.ndarray, np.ndarray],
          prior: int = PRIOR_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, covariance) of a group of n rows, leaning on its parent's."""
    n, mean, cov = child
    w = n / (n + prior)
    return w * mean + (1 - w) * parent[0], w * cov + (1 - w) * parent[1]


def leaning(final: DataFrame, parents: DataFrame) -> DataFrame:
    """``ESTIMATE`` of every language and source, leaning on its language and the table.
    ``final`` has ``key, mean, inverse, scale, n``; ``parents`` has ``key`` and the language's ``above``."""
    top = final.where(F.col("key") == "0").first()                # one row of P + P (P + 1) / 2 numbers
    if top is None:
        return final.sparkSession.createDataFrame([], ESTIMATE)
    # A scaled distance is one under the covariance over the scale.
    table = (np.array(top["mean"]), np.linalg.inv(_full(top["inverse"])) / top["scale"])
    values = F.struct("n", "mean", "inverse", "scale").alias("e")
    pairs = (parents.join(final.select("key", values), "key")
             .join(final.select(F.col("key").alias("above"), values.alias("up")), "above").select("key", "e", "up"))

    def solve(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                own, up = ((e["n"], np.array(e["mean"]), np.linalg.inv(_full(e["inverse"])) / e["scale"]) for e in (r["e"], r["up"]))
                out.append(_estimate(r["key"], *blend(own, blend(up, table))))
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.string()), ("mean", pa.list_(pa.float64())),
                                                             ("inverse", pa.list_(pa.float64()))]))
    return pairs.mapInArrow(solve, ESTIMATE)


def judge(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """One row per input row: ``doc_id``, the base counts, ``base_failed, kept`` and
    ``distance`` (null without an estimate)."""
    stats = store(statistics(docs).withColumn("base_failed", base_failed()), "statistics")
    keyed = stats.where("NOT base_failed").select(
        "x", F.explode(F.array(*group_keys())).alias("key"), F.abs(F.xxhash64("doc_id", "x")).alias("deal"))
    sizes = store(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    estimate = store(chunk_starts(keyed, sizes), "start")
    for _ in range(STEPS):
        estimate = store(concentrate(keyed, sizes, estimate), "estimate")
    middle = _nearest(_bins(keyed, estimate), sizes, 0.5)
    final = (estimate.join(middle, "key").join(sizes, "key")
             .withColumn("scale", F.lit(chi_square_median()) / F.pow(F.lit(2.0), F.col("last") / BINS)))
    final = store(final.select("key", "mean", "inverse", "scale", "n"), "final")
    narrow, above, _ = group_keys()
    parents = stats.where("NOT base_failed").select(narrow.alias("key"), above.alias("above")).distinct()
    own = store(leaning(final, parents), "leaning").select(F.col("key").alias("of"), "mean", "inverse")
    out = stats.join(own, narrow == F.col("of"), "left").withColumn("distance", F.expr(squared_distance()))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      kept.alias("kept"), "distance")
