"""Threshold-pair sets (F3, F4, F5, J1, U4, W6 ordinals).

Pair tables are small by construction (their size is a function of the grid
parameters, never of the data) and carry ``pair_no``: the input ordinal that
breaks every ranking tie, as the reference's stable sorts do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cutpoint.functions.bands import thresholds_valid

# Fixed values that must equal the reference's.
DEFAULT_PAIR_OFFSETS = [(0.03, -0.06), (0.05, -0.04), (0.08, 0.0), (0.10, 0.03), (0.12, 0.06)]
DEFAULT_PAIR_FALLBACK = [(0.03, 0.40), (0.05, 0.45), (0.08, 0.50), (0.12, 0.60)]
DEFAULT_BASE_CLIP = (0.25, 0.90)
APPROVE_CLIP = (0.0, 0.95)
DECLINE_CLIP = (0.05, 0.98)
MIN_DEFAULT_PAIRS = 4
# Cost search grid defaults.
GRID_DEFAULTS = dict(t1_min=0.02, t1_max=0.20, t2_min=0.20, t2_max=0.80, step=0.01)


def clip(x: Column, lo: float, hi: float) -> Column:
    """F1."""
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), x))


def _arange_len(lo: float, hi: float, step: float) -> int:
    # Length of numpy.arange(lo, hi + 1e-9, step): ceil((stop - start) / step).
    return max(0, math.ceil((hi + 1e-9 - lo) / step))


def threshold_grid(spark: SparkSession, t1_min: float, t1_max: float, t2_min: float,
                   t2_max: float, step: float) -> DataFrame:
    """F3 + J1: all (t1, t2) with t1 < t2 from two inclusive float ranges,
    each value rounded to 4 places. Generated by nested ``explode(sequence)``
    in input order; no join."""
    if step <= 0:
        raise ValueError("grid step must be > 0")
    n1, n2 = _arange_len(t1_min, t1_max, step), _arange_len(t2_min, t2_max, step)
    # The lowest approve against the highest decline threshold: the pair most likely to be valid.
    if n1 == 0 or n2 == 0 or round(t1_min, 4) >= round(t2_min + (n2 - 1) * step, 4):
        raise ValueError("no pair of this grid has approve < decline threshold")
    g = (spark.range(1)
         .select(F.explode(F.sequence(F.lit(0), F.lit(n1 - 1))).alias("i"))
         .select("i", F.explode(F.sequence(F.lit(0), F.lit(n2 - 1))).alias("j"))
         .select("i", "j",
                 F.round(F.lit(float(t1_min)) + F.col("i") * F.lit(float(step)), 4).alias("t1"),
                 F.round(F.lit(float(t2_min)) + F.col("j") * F.lit(float(step)), 4).alias("t2"))
         .filter(F.col("t1") < F.col("t2")))
    w = Window.orderBy("i", "j")   # bounded: n1 * n2 rows
    return g.select(F.row_number().over(w).alias("pair_no"), "t1", "t2")


def neighbourhood_pairs(center: DataFrame, offsets=(-0.02, -0.01, 0.0, 0.01, 0.02)) -> DataFrame:
    """The 5 x 5 offsets around a (t1, t2) row, rounded to 4 places.
    Pairs that break 0 <= t1 < t2 <= 1 are dropped."""
    arr = F.array(*[F.lit(float(o)) for o in offsets])
    g = (center.select("t1", "t2", F.posexplode(arr).alias("i", "d1"))
         .select("t1", "t2", "i", "d1", F.posexplode(arr).alias("j", "d2"))
         .select("i", "j",
                 F.round(F.col("t1") + F.col("d1"), 4).alias("t1"),
                 F.round(F.col("t2") + F.col("d2"), 4).alias("t2"))
         .filter(thresholds_valid(F.col("t1"), F.col("t2"))))
    return g.select(F.row_number().over(Window.orderBy("i", "j")).alias("pair_no"), "t1", "t2")


def dedup_pairs(pairs: DataFrame, order_col: str = "ord") -> DataFrame:
    """U4: ordered de-duplication, first occurrence wins."""
    return pairs.groupBy("t1", "t2").agg(F.min(order_col).alias(order_col))


def default_pairs(base: DataFrame, base_col: str = "base") -> DataFrame:
    """pairs around a base decline threshold, one row of ``base`` in.

    base clipped to [0.25, 0.90]; five offset pairs; approve clipped to
    [0, 0.95], decline to [0.05, 0.98]; invalid and repeated pairs dropped;
    topped up from a fixed list to at least four pairs.
    """
    lo, hi = DEFAULT_BASE_CLIP
    offs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(d).alias("d")) for a, d in DEFAULT_PAIR_OFFSETS])
    raw = (base.select(clip(F.col(base_col).cast("double"), lo, hi).alias("base"))
           .select("base", F.posexplode(offs).alias("ord", "o"))
           .select("ord",
                   clip(F.col("o.a"), *APPROVE_CLIP).alias("a"),
                   clip(F.col("base") + F.col("o.d"), *DECLINE_CLIP).alias("d"))
           .filter(F.col("a") < F.col("d"))
           .select("ord", F.round("a", 4).alias("t1"), F.round("d", 4).alias("t2")))
    cleaned = dedup_pairs(raw).withColumn("src", F.lit(0))
    fb = F.array(*[F.struct(F.lit(a).alias("t1"), F.lit(d).alias("t2")) for a, d in DEFAULT_PAIR_FALLBACK])
    fallback = (base.select(F.posexplode(fb).alias("ord", "p"))
                .select((F.col("ord") + 100).alias("ord"), F.col("p.t1").alias("t1"),
                        F.col("p.t2").alias("t2"))
                .join(cleaned.select("t1", "t2"), ["t1", "t2"], "left_anti")
                .withColumn("src", F.lit(1)))
    allp = cleaned.unionByName(fallback)
    w_all = Window.partitionBy(F.lit(1))          # at most 9 rows
    n_clean = F.sum(F.when(F.col("src") == 0, 1).otherwise(0)).over(w_all)
    w_fb = Window.partitionBy("src").orderBy("ord")
    kept = (allp.withColumn("n_clean", n_clean).withColumn("k", F.row_number().over(w_fb))
            .filter((F.col("src") == 0) | (F.col("k") <= F.lit(MIN_DEFAULT_PAIRS) - F.col("n_clean"))))
    return kept.select(F.row_number().over(Window.orderBy("ord")).alias("pair_no"), "t1", "t2")


def parse_pair_specs(df: DataFrame, spec_col: str, key_cols=()) -> DataFrame:
    """F5 re-aimed on a column of "t1:t2,t1:t2" strings.

    One output row per non-empty token: its ordinal among the spec's
    non-empty tokens (from ``posexplode``, so no window), parsed t1/t2 and
    an ``error`` (null when valid). A spec with no token gets one row with
    error 'empty'.
    """
    toks = F.filter(F.transform(F.split(F.coalesce(F.col(spec_col), F.lit("")), ","), lambda t: F.trim(t)),
                    lambda t: t != "")
    base = df.select(*key_cols, toks.alias("__toks"))
    ex = base.select(*key_cols, F.posexplode("__toks").alias("pos", "tok"))
    parts = F.split(F.col("tok"), ":", 2)
    a = F.trim(F.element_at(parts, 1)).try_cast("double")
    d = F.trim(F.element_at(parts, 2)).try_cast("double")
    has_colon = F.instr("tok", ":") > 0
    err = (F.when(~has_colon, F.lit("missing ':'"))
           .when(a.isNull() | d.isNull(), F.lit("not a number"))
           .when(~thresholds_valid(a, d), F.lit("invalid thresholds")))
    parsed = ex.select(*key_cols, (F.col("pos") + 1).alias("pair_no"), "tok",
                       F.when(has_colon, a).alias("t1"), F.when(has_colon, d).alias("t2"),
                       err.alias("error"))
    empty = base.filter(F.size("__toks") == 0).select(
        *key_cols, F.lit(0).alias("pair_no"), F.lit(None).cast("string").alias("tok"),
        F.lit(None).cast("double").alias("t1"), F.lit(None).cast("double").alias("t2"),
        F.lit("empty").alias("error"))
    return parsed.unionByName(empty)


def parse_tag_specs(df: DataFrame, spec_col: str, key_cols=()) -> DataFrame:
    """F6 re-aimed on a column of "k=v,k=v" strings: a map per row plus the
    list of bad tokens (no '=' or empty key). Later keys win, as in a dict."""
    toks = F.filter(F.transform(F.split(F.coalesce(F.col(spec_col), F.lit("")), ","), lambda t: F.trim(t)),
                    lambda t: t != "")
    good = F.filter(toks, lambda t: (F.instr(t, "=") > 0) & (F.trim(F.split(t, "=", 2)[0]) != ""))
    bad = F.filter(toks, lambda t: (F.instr(t, "=") == 0) | (F.trim(F.split(t, "=", 2)[0]) == ""))
    entries = F.transform(good, lambda t: F.struct(F.trim(F.split(t, "=", 2)[0]).alias("key"),
                                                   F.trim(F.split(t, "=", 2)[1]).alias("value")))
    # Keep the last entry per key (dict semantics) before building the map.
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries) + 1),
                                                    lambda x: x["key"] == e["key"]))
    return df.select(*key_cols,
                     F.map_from_entries(last).alias("tags"),
                     bad.alias("bad_tokens"))
