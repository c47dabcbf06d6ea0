"""Operator 5: n-gram Jaccard join with rare-first prefix, length, positional and suffix filters.

A document's set holds its distinct five-word shingles (64-bit hashes). Two documents link
when ``100 * intersection >= 80 * union``, in integers.

1. Order. Shingles are ordered rare first, by their count in a fixed-width table over all
   documents, then by hash. Any common order gives the same links; rareness only keeps
   lists short.
2. Prefixes. Of ``n`` shingles the first ``n - ceil(4n/5) + 1`` are probed, the first
   ``n - ceil(8n/9) + 1`` are indexed: two linked sets always share a shingle that is
   indexed for the smaller and probed for the larger one.
3. Stars. Every list (prefix shingle) links its members to its first and last indexed member.
   This is linear in the list, whatever its length, and settles groups of near copies.
4. The rest. Only lists whose members still have different labels are left; while an entry has
   very many unlike neighbours, further stars with other centres run; then all pairs of unlike
   labels that pass the filters are checked, each pair once. So no link between components is
   missed, and within a component no pair needs to be listed.
5. Filters before any set is fetched: length and position per list entry, then, per pair,
   the suffix filter: sets counted in hash ranges differ by at least the sum of the counts'
   differences.
6. Verification: sets of the pairs' classes are computed again from the texts (a presence
   table passes the few needed ones) and intersected.

Equal sets form a class, of which one row stands for all.

Defined results: null and blank texts have no shingles and stand alone; fewer than five
words make one shingle of the whole sequence; an empty table gives an empty table; repeated
rows are members of one class; a null ``doc_id`` counts as larger than any number; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.llm import shingles
from cutpoint.llm.common import map_slices, raw_texts, slices, store, whole
from cutpoint.llm.components import components
from cutpoint.llm.tables import gather

SIZE = 5
#: log2 of the widths of the count table and of the presence table.
COUNT_BITS = 20
PRESENCE_BITS = 26
#: Prefix keys keep 48 bits: a chance match only adds a candidate.
KEY_SHIFT = 16
#: Hash ranges of the suffix filter.
RANGES = 16
#: All unlike neighbours are compared once an entry has at most so many of them in its list on
#: average (before any filter); until then up to MAX_STARS more rounds of stars thin them out.
FEW_PAIRS = 256
MAX_STARS = 6

SETS = "doc_id long, n int, d1 long, d2 long, prefix array<long>, parts array<int>, text_hash long"


def probe_length(n):
    return n - -(-4 * n // 5) + 1


def needed(n, m):
    """The least intersection of two linked sets of ``n`` and ``m`` (SQL)."""
    return f"((4L * ({n} + {m}) + 8) div 9)"


def count_table(docs: DataFrame, size: int = SIZE, bits: int = COUNT_BITS) -> np.ndarray:
    """How often the shingles of each hash range occur in documents' sets."""
    def fill(batches):
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for s in slices(b):
                found = shingles.shingle_sets(raw_texts(s), size)
                total += np.bincount((np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        return total
    return gather(docs.select("doc_id", "text"), fill, "<u4")


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set of hashes."""
    a, b = shingles.mix(s ^ np.uint64(0x5851F42D4C957F2D)), shingles.mix(s ^ np.uint64(0x14057B7EF767814F))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def _lists(arrays: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.cumsum([0] + [len(a) for a in arrays])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).view(kind) if kind == pa.int64() else pa.array(flat, kind))


def prefix_sets(docs: DataFrame, counts, size: int = SIZE) -> DataFrame:
    """One row per document in ``SETS``: its probe prefix in the common order."""
    table = docs.sparkSession.sparkContext.broadcast(counts)
    bits = int(len(counts)).bit_length() - 1

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        order, found = table.value, shingles.shingle_sets(raw_texts(s), size)
        prefixes, parts, digests = [], [], []
        for u in found:
            by = np.lexsort((u, order[(u >> np.uint64(64 - bits)).astype(np.int64)]))
            prefixes.append(u[by[:probe_length(len(u)) if len(u) else 0]] >> np.uint64(KEY_SHIFT))
            parts.append(np.bincount((u & np.uint64(RANGES - 1)).astype(np.int64), minlength=RANGES))
            digests.append(set_digest(u))
        return pa.RecordBatch.from_arrays(
            [s.column(0), pa.array([len(u) for u in found], pa.int32()), pa.array([d[0] for d in digests], pa.int64()),
             pa.array([d[1] for d in digests], pa.int64()), _lists(prefixes, pa.int64()), _lists(parts, pa.int32()),
             s.column(2)],
            names=["doc_id", "n", "d1", "d2", "prefix", "parts", "text_hash"])

    return map_slices(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run, SETS)


def fetch_sets(docs: DataFrame, wanted: DataFrame, size: int = SIZE) -> DataFrame:
    """``d1, d2, shingles`` of the wanted classes (``doc_id, d1``), from the texts: once per
    task. The presence table lets a few others through; they meet no pair."""
    def key(d1: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return shingles.mix(d1.view(np.uint64) ^ shingles.mix(doc.view(np.uint64))) >> np.uint64(64 - PRESENCE_BITS)

    def ids(column) -> np.ndarray:
        return column.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

    def fill(batches):
        bits = np.zeros(1 << PRESENCE_BITS, bool)
        for b in batches:
            bits[key(ids(b.column(1)), ids(b.column(0)))] = True
        return np.packbits(bits)

    present = docs.sparkSession.sparkContext.broadcast(
        gather(wanted.select("doc_id", "d1"), fill, "u1", np.bitwise_or))

    seen: set[tuple[int, int]] = set()   # every task unpickles its own

    def run(s: pa.RecordBatch) -> pa.RecordBatch:
        found = shingles.shingle_sets(raw_texts(s), size)
        digests = np.array([set_digest(u) for u in found], np.int64).reshape(-1, 2)
        at = key(np.ascontiguousarray(digests[:, 0]), ids(s.column(0)))
        hit = np.flatnonzero(present.value[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1)
        hit = np.array([i for i in hit.tolist() if (d := tuple(digests[i])) not in seen and not seen.add(d)], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(digests[hit, 0]), pa.array(digests[hit, 1]), _lists([found[i] for i in hit], pa.int64())],
            names=["d1", "d2", "shingles"])

    return map_slices(docs.select("doc_id", "text"), run, "d1 long, d2 long, shingles array<long>")


def verify(docs: DataFrame, pairs: DataFrame, size: int = SIZE) -> DataFrame:
    """The linked ones of the candidate pairs ``u, v`` (class nodes, ``u < v``), as
    ``suffix_filter`` gives them."""
    wanted = pairs.select(F.col("udoc").alias("doc_id"), F.col("u1").alias("d1")).union(pairs.select("vdoc", "v1")).distinct()
    # A centre may be in very many pairs: both joins shuffle both sides, so Spark can split it.
    sets = store(fetch_sets(docs, wanted, size), "sets")
    both = (pairs.select("u", "u1", "u2", "v", "v1", "v2").join(sets.toDF("v1", "v2", "sv"), ["v1", "v2"])
            .join(sets.toDF("u1", "u2", "su"), ["u1", "u2"])
            .select("u", "v", F.size("su").alias("n"), F.size("sv").alias("m"),
                    F.size(F.array_intersect("su", "sv")).alias("both")))
    return both.where("100L * both >= 80L * (n + m - both)").select("u", "v").distinct()


def suffix_filter(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Drop pairs whose range counts already differ too much for a link. What stays carries the
    document and the digest of both classes, so that verification looks up neither again."""
    def side(x: str) -> DataFrame:
        return classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("parts").alias(f"p{x}"),
                              F.col("doc_id").alias(f"{x}doc"), F.col("d1").alias(f"{x}1"), F.col("d2").alias(f"{x}2"))

    apart = F.aggregate(F.zip_with("pu", "pv", lambda a, b: F.abs(a - b)), F.lit(0), lambda s, x: s + x)
    return (pairs.join(side("u"), "u").join(side("v"), "v")
            .where(apart <= F.expr(f"nu + nv - 2 * {needed('nu', 'nv')}"))
            .select("u", "v", "udoc", "u1", "u2", "vdoc", "v1", "v2"))


def as_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct()


#: Entries the index holds, and the filters of a pair: ``y`` is the smaller, indexed one,
#: ``x`` the larger, probed one; positions count from 0.
INDEXED = "xpos < xn - ((8L * xn + 8) div 9) + 1"
LENGTH = "yn * 5L >= xn * 4L"
POSITION = "least(yn - ypos, xn - xpos) >= " + needed("yn", "xn")


def label(df: DataFrame, labels: DataFrame, node: str = "node") -> DataFrame:
    """Adds ``label``: the component so far, or the node itself."""
    return (df.join(labels.withColumnRenamed("node", "_node"), F.col(node) == F.col("_node"), "left")
            .withColumn("label", F.coalesce("label", F.col(node))).drop("_node"))


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links ``u, v``: only the labels they join are gone through again."""
    ends = label(label(links, labels, "u").withColumnRenamed("label", "a"), labels, "v")
    joined = store(components(ends.select(F.col("a").alias("u"), F.col("label").alias("v"))), "joined")
    moved = (labels.join(joined.toDF("label", "_new"), "label", "left")
             .select("node", F.coalesce("_new", "label").alias("label")))
    return store(moved.union(joined.join(labels, "node", "left_anti").select("node", "label")), "labels")


def star_entries(sets: DataFrame, members: DataFrame) -> DataFrame:
    """Prefix entries of lists with an indexed member other than themselves: ``h, x, xn, xpos``,
    the list's two centres ``y`` and ``z`` (its first and last indexed rows) and ``before``, the
    key right before ``h`` in the row's prefix, where that one is in the table too. Only rows
    that stand for their class stay: its other rows have the same entries.
    The join key is written anew so that both sides are shuffled for the join, which lets
    Spark split a list that very many rows share."""
    entries = sets.where("n > 0").select(F.col("row").alias("x"), F.col("n").alias("xn"),
                                         F.posexplode("prefix").alias("xpos", "h"))
    lists = (entries.where(INDEXED).groupBy("h").agg(F.min("x").alias("y"), F.max("x").alias("z"))
             .select(F.bitwise_not("h").alias("k"), "y", "z"))
    found = entries.join(lists, F.bitwise_not("h") == F.col("k")).where("x <> y OR y <> z").drop("k")
    own = Window.partitionBy("x").orderBy("xpos")
    found = found.withColumn("before", F.when(F.lag("xpos").over(own) == F.col("xpos") - 1, F.lag("h").over(own)))
    return found.join(members.where("row = node").select(F.col("row").alias("x")), "x")


def unlike(live: DataFrame, labels: DataFrame) -> DataFrame:
    """The entries of lists that hold unlike labels: adds ``label`` and ``share``, the pairs
    of unlike labels in the list over its entries."""
    labelled = label(live, labels, "x")
    mixed = (labelled.groupBy("h", "label").agg(F.count(F.lit(1)).alias("c"))
             .groupBy(F.bitwise_not("h").alias("k"))
             .agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("like"), F.count(F.lit(1)).alias("labels"))
             .where("labels > 1"))
    return (labelled.join(mixed, F.bitwise_not("h") == F.col("k"))
            .withColumn("share", (F.col("all") - F.col("like") / F.col("all")) / 2)
            .drop("k", "all", "like", "labels"))


def candidates(left: DataFrame, turn: int | None) -> DataFrame:
    """Pairs ``x, y`` of unlike labels that share a list: with one centre for each list and
    size class (another one each turn), or with all indexed entries (``turn`` None). Of all
    indexed entries, a pair whose keys right before are equal too is left to that earlier list:
    its first common key never has equal ones before it."""
    centres = left.where(INDEXED)
    columns = ["x", "xn", "xpos", "label", "before"]
    if turn is not None:
        first = F.struct(F.xxhash64("x", F.lit(turn)).alias("rank"), *columns)
        centres = (centres.groupBy("h", F.floor(F.log("xn") / F.lit(float(np.log(1.25)))).alias("size"))
                   .agg(F.min(first).alias("c")).select("h", *(f"c.{c}" for c in columns)))
    centres = centres.select(F.bitwise_not("h").alias("k"), F.col("x").alias("y"), F.col("xn").alias("yn"),
                             F.col("xpos").alias("ypos"), F.col("label").alias("other"), F.col("before").alias("ybefore"))
    once = "" if turn is not None else " AND (before IS NULL OR ybefore IS NULL OR before <> ybefore)"
    return (left.join(centres, (F.bitwise_not("h") == F.col("k")) & F.expr(
        f"label <> other AND (yn < xn OR (yn = xn AND y < x)) AND {LENGTH} AND {POSITION}{once}")).select("x", "y"))


def links(docs: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, members, labels): a set's description per row, the class node of each row
    with shingles, and the component label of every class node that has a link."""
    counts = count_table(docs, size)
    sets = store(prefix_sets(docs, counts, size).withColumn("row", F.monotonically_increasing_id()), "prefixes")
    named = sets.where("n > 0").select("row", "doc_id", "n", "d1", "d2", "parts")
    classes = store(named.groupBy("d1", "d2").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
        F.first("parts").alias("parts")), "classes")
    members = store(named.select("row", "d1", "d2").join(classes.select("d1", "d2", "node"), ["d1", "d2"])
                    .select("row", "node"), "members")

    star = store(star_entries(sets, members), "stars")
    near = star.select("x", F.explode(F.array("y", "z")).alias("y")).where("x <> y").distinct()
    near = near.join(members.toDF("y", "node"), "y").where("x <> node").select("x", F.col("node").alias("y"))
    near = as_pairs(near, "x", "y")
    fresh = store(suffix_filter(near, classes), "tried")
    tried = fresh.select("u", "v")
    labels = components(verify(docs, fresh, size))

    live = star.where("y <> z").select("h", "x", "xn", "xpos", "before")
    for turn in range(MAX_STARS + 1):
        left = store(unlike(live, labels), "left")
        rows, pairs = left.agg(F.count(F.lit(1)), F.sum("share")).first()
        if not rows:
            break
        exhaustive = turn == MAX_STARS or pairs <= FEW_PAIRS * rows
        fresh = as_pairs(candidates(left, None if exhaustive else turn), "x", "y").join(tried, ["u", "v"], "left_anti")
        fresh = store(suffix_filter(fresh, classes), "tried")
        tried = tried.union(fresh.select("u", "v"))
        labels = extend(labels, store(verify(docs, fresh, size), "links"))
        if exhaustive:
            break
    return sets, members, labels


def near_duplicates(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``, and ``text_hash``
    (with ``doc_id`` it names the input row)."""
    sets, members, labels = links(docs.select("doc_id", "text"), size)
    nodes = label(members, labels)
    least = (nodes.join(sets.select("row", "doc_id"), "row")
             .groupBy("label").agg(F.min("doc_id").alias("component_id")))
    known = nodes.join(least, "label").select("row", "component_id")
    return (sets.select("row", "doc_id", "n", "text_hash").join(known, "row", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "text_hash"))


def dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest
    ``doc_id``; all columns unchanged."""
    lost = (near_duplicates(docs, size).where("n_shingles > 0 AND NOT (doc_id <=> component_id)")
            .select(F.col("doc_id").alias("lost"), F.col("text_hash").alias("lost_hash")).distinct())
    rows = whole(docs, F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    return (rows.join(lost, (F.col("hash") == F.col("lost_hash")) & F.col("id").eqNullSafe(F.col("lost")), "left_anti")
            .select("row.*"))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s,
         len(w) >= 5 AS whole FROM words),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b
          ON a.s = b.s AND a.whole = b.whole AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM both_ JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 80 * (a.n + b.n - c)),
way AS (SELECT u AS a, v AS b FROM link UNION SELECT v, u FROM link),
reach AS (SELECT a, b FROM way UNION SELECT r.a, w.b FROM reach r JOIN way w ON w.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(r.b) FROM reach r WHERE r.a = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""
