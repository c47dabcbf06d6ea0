"""Rank selection by brackets, and a coarse-to-fine KS maximum.

An order statistic needs no table of distinct values. One scan builds a bounded quantile sketch
per group; around each wanted rank it yields two bounds that the rank surely lies
between. A second scan counts: rows between brackets are only counted, rows inside a bracket are
counted by value. Running totals over those few rows give every wanted rank exactly.

The sketch's rank error is ``1 / ACCURACY`` of the rows. A bracket is the narrowest of a ladder of
widths that still spans ``SPARE`` ranks to either side, or the whole group if it is that small; for
large n about 4 / ACCURACY of the rows fall into each, one task per bracket and group.

The PSI reads edges and bin counts of both populations from the same two scans: the edges lie
inside brackets, where the values are known. The KS maximum counts both populations in
equal-count ranges; a range can hold a larger gap only if the distribution functions could move
apart within it, and only the rows of such ranges are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions.bands import guarded, is_bad
from cutpoint.operators.prefix import assign_range, interpolate, reuse

ACCURACY = 100_000
#: Half widths of brackets, in shares of the rows; the sketch is asked for all of them.
LADDER = tuple(2.0 * 10 ** k / ACCURACY for k in range(4))
SPARE = 8

#: Ranges of the first count of the KS maximum, and of each further one.
KS_RANGES = 512
#: Distinct values that are looked at one by one.
KS_VALUES = 200_000


def _same(a: Sequence[str], b: Sequence[str]) -> Column:
    cond = F.lit(True)
    for x, y in zip(a, b, strict=True):
        cond = cond & F.col(x).eqNullSafe(F.col(y))
    return cond


def _sketch(rows: DataFrame, value: Column, qs: Sequence[float], by: Sequence[str],
            extra: dict[str, Column] | None = None) -> DataFrame:
    """Scan 1. Per group the ``extra`` aggregates, ``__n, __bad``, the sorted bounds ``__cuts`` of all brackets (two per
    wanted quantile), and ``__fine``: whether the space above each bound lies inside a bracket."""
    extra = extra or {}
    asked = sorted({min(1.0, max(0.0, q + s * e)) for q in qs for e in LADDER for s in (-1, 1)})
    g = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(is_bad(value)).alias("__bad"), F.min(value).alias("__lo"),
        F.max(value).alias("__hi"), F.percentile_approx(value, [float(x) for x in asked], ACCURACY).alias("__k"),
        *[c.alias(n) for n, c in extra.items()])

    def bound(q: float, sign: int) -> Column:
        end = F.col("__lo" if sign < 0 else "__hi")
        out = end
        for e in reversed(LADDER):
            x = q + sign * e
            if 0.0 < x < 1.0:
                out = F.when(F.col("__n") * F.lit(e) >= SPARE, F.col("__k")[asked.index(x)]).otherwise(out)
            else:
                out = F.when(F.col("__n") * F.lit(e) >= SPARE, end).otherwise(out)
        return out

    g = g.withColumn("__b", F.array(*[F.struct(bound(q, -1).alias("a"), bound(q, 1).alias("z")) for q in qs]))
    g = g.withColumn("__cuts", F.array_sort(F.concat(F.transform("__b", lambda x: x["a"]), F.transform("__b", lambda x: x["z"]))))
    inside = F.transform("__cuts", lambda c, i: F.coalesce(F.exists(
        "__b", lambda b: (b["a"] <= c) & (F.get(F.col("__cuts"), i + 1) <= b["z"])), F.lit(False)))
    return g.select(*by, *extra, "__n", "__bad", "__cuts", inside.alias("__fine"))


def _cells(rows: DataFrame, value: Column, known: DataFrame, n_cuts: int, by: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Scan 2. ``by, extra, __i, __v, __c``: counts by space between bounds (``__i`` bounds at or
    below) and, inside brackets and on bounds, by value."""
    if by:
        own = [f"__by_{c}" for c in by]
        j = rows.join(known.select(*[F.col(c).alias(o) for c, o in zip(by, own)], "__cuts", "__fine"), _same(by, own))
        cuts, fine = F.col("__cuts"), F.col("__fine")
    else:
        r = known.first()
        j = rows
        cuts, fine = (F.array(*[F.lit(x) for x in (r[c] or [None] * n_cuts)]) for c in ("__cuts", "__fine"))
        cuts = cuts.cast("array<double>")
    at = sum((F.when(cuts[i] <= value, 1).otherwise(0) for i in range(n_cuts)), F.lit(0))
    cell = j.select(*by, *extra, at.alias("__i"), value.alias("__x"), cuts.alias("__cuts"), fine.alias("__fine"))
    below = F.get(F.col("__cuts"), F.col("__i") - 1)
    keep = (F.col("__x") == below) | F.coalesce(F.get(F.col("__fine"), F.col("__i") - 1).cast("boolean"), F.lit(False))
    return cell.groupBy(*by, *extra, "__i", F.when(keep, F.col("__x")).alias("__v")).agg(
        F.count(F.lit(1)).alias("__c"), F.count_if(is_bad(F.col("__x"))).alias("__bad"))


def _positions(cells: DataFrame, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Adds to each cell ``__s_<c>``: the rows of its group before it. Windows are per bracket; the
    spaces of a group (two per quantile) are added up in a window of their own."""
    total = cells.groupBy(*by, "__i").agg(*[F.sum(c).alias(f"__t_{c}") for c in counts])
    before = Window.partitionBy(*by).orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
    offset = total.select(*[F.col(c).alias(f"__of_{c}") for c in by], F.col("__i").alias("__of"),
                          *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in counts])
    j = cells.join(offset, _same([*by, "__i"], [*[f"__of_{c}" for c in by], "__of"]))
    inner = Window.partitionBy(*by, "__i").orderBy(F.col("__v").asc_nulls_last())
    return j.select(*cells.columns, *[(F.col(f"__o_{c}") + F.sum(c).over(inner) - F.col(c)).alias(f"__s_{c}") for c in counts])


def quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (),
              known: DataFrame | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (as ``prefix.exact_quantiles``) in two scans:
    ``by, q, value``. Null and NaN values fail with their count."""
    qs = [float(q) for q in qs]
    value = F.col(col).cast("double")
    known = reuse(_sketch(df, value, qs, by)) if known is None else known
    cells = reuse(_cells(df, value, known, 2 * len(qs), by))
    placed = _positions(cells.drop("__bad"), by, ["__c"])
    own = [f"__g_{c}" for c in by]
    sizes = known.select(*[F.col(c).alias(o) for c, o in zip(by, own)], guarded(F.col("__n"), F.col("__bad")).alias("__n"))
    cum = (placed.where(F.col("__v").isNotNull()).join(sizes, _same(by, own))
           .select(*by, "__v", F.col("__s___c").alias("__s"), (F.col("__s___c") + F.col("__c")).alias("__e"), "__n"))
    return interpolate(cum, qs, by)


def summary(df: DataFrame, col: str, qs: dict[str, float], extra: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per group: the aggregates ``extra`` (taken in the first scan) and the quantiles
    ``qs`` under their names. No rows without ``by``: one row of nulls and zero counts."""
    value = F.col(col).cast("double")
    known = reuse(_sketch(df, value, list(qs.values()), by, extra))
    found = quantiles(df, col, list(qs.values()), by, known)
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("q") == float(q), F.col("value"))).alias(n) for n, q in qs.items()])
    own = [f"__w_{c}" for c in by]
    left = known.select(*by, guarded(F.lit(1), F.col("__bad")).alias("__ok"), *extra)
    wide = wide.select(*[F.col(c).alias(o) for c, o in zip(by, own)], *qs)
    return left.join(wide, _same(by, own), "left").where(F.col("__ok") == 1).select(*by, *extra, *qs)


def psi_bins(df: DataFrame, pop: str, qs: Sequence[float], score: str = "score") -> DataFrame:
    """``bin, ref_n, cur_n``: rows of the two populations (``pop`` is 'ref' or 'cur') between the inner
    ones of the reference's quantiles ``qs``; ``len(qs) - 1`` bins, empty ones included."""
    qs, value = [float(q) for q in qs], F.col(score).cast("double")
    rows = df.where(F.col(pop).isin("ref", "cur"))
    known = reuse(_sketch(rows.where(F.col(pop) == "ref"), value, qs, ()))
    cells = reuse(_cells(rows, value, known, 2 * len(qs), (), [pop]).groupBy("__i", "__v").agg(
        F.sum(F.when(F.col(pop) == "ref", F.col("__c")).otherwise(0)).alias("r"),
        F.sum(F.when(F.col(pop) == "cur", F.col("__c")).otherwise(0)).alias("c"),
        F.sum("__bad").alias("__bad")))
    n, bad = known.first(), cells.agg(F.sum("__bad")).first()[0]
    if bad:
        raise ValueError(f"{bad} rows have a null or NaN score")
    placed = _positions(cells, (), ["r"])
    cum = placed.where(F.col("__v").isNotNull() & (F.col("r") > 0)).select(
        "__v", F.col("__s_r").alias("__s"), (F.col("__s_r") + F.col("r")).alias("__e"), F.lit(n["__n"]).alias("__n"))
    edges = {r["q"]: r["value"] for r in interpolate(cum, qs).collect()}             # one number per quantile
    inner = [edges[q] for q in qs[1:-1]] if edges else []
    # Inside a bracket a cell has its value; between brackets all values lie on one side of every edge.
    cuts = n["__cuts"] or []
    stands = F.coalesce(F.col("__v"), F.get(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), F.col("__i") - 1),
                        F.lit(float("-inf")))
    at = sum((F.when(F.lit(e) <= stands, 1).otherwise(0) for e in inner), F.lit(0))
    binned = cells.groupBy(at.alias("bin")).agg(F.sum("r").alias("ref_n"), F.sum("c").alias("cur_n"))
    grid = df.sparkSession.range(0, len(qs) - 1).select(F.col("id").cast("int").alias("bin"))
    return grid.join(F.broadcast(binned), "bin", "left").na.fill(0, ["ref_n", "cur_n"])


def _half_open(rows: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Adds ``__p``: the number of the sorted ``cuts`` below ``__x``, so that ranges are (cut, cut]."""
    # The negated value and cuts turn the half-open side round.
    at = assign_range(rows.withColumn("__y", F.lit(0.0) - F.col("__x")), "__y", sorted(0.0 - c for c in cuts), "__p")
    return at.withColumn("__p", F.lit(len(cuts)) - F.col("__p")).drop("__y")


def ks(df: DataFrame, pop: str, score: str = "score", ranges: int = KS_RANGES, values: int = KS_VALUES) -> DataFrame:
    """``ks_stat, reference_rows, current_rows`` of the populations 'ref' and 'cur'.

    Scan 1 sketches equal-count bounds, scan 2 counts both populations per range. With F and G at the
    start of a range and f and g their growth in it, no gap inside exceeds
    max(F + f - G, G + g - F); ranges below the largest gap at any bound are done. What remains is
    cut again until it holds few distinct values, and is then read value by value."""
    x = F.col(score).cast("double")
    # Two narrow columns, read by every count below.
    rows = reuse(df.where(F.col(pop).isin("ref", "cur")).select(
        x.alias("__x"), F.when(F.col(pop) == "ref", 1).otherwise(0).alias("__r")))
    fractions = [i / ranges for i in range(1, ranges)]
    top = rows.agg(F.sum("__r").alias("r"), F.count(F.lit(1)).alias("n"), F.count_if(is_bad(F.col("__x"))).alias("bad"),
                   F.percentile_approx("__x", fractions, max(10_000, 4 * ranges)).alias("b")).first()
    if top["bad"]:
        raise ValueError(f"{top['bad']} rows have a null or NaN score")
    nr, nc = int(top["r"] or 0), int(top["n"]) - int(top["r"] or 0)
    one, two, best = 1.0 / max(nr, 1), 1.0 / max(nc, 1), 0.0
    # What is left to look at: disjoint (low, high], in order, with the rows of both populations at or below low.
    todo, bounds = [(float("-inf"), float("inf"), 0, 0)], top["b"] or []
    kept = rows
    while todo:
        cuts = sorted({*bounds, *[z for a, z, *_ in todo for z in (a, z) if abs(z) != float("inf")]})
        placed = _half_open(kept, cuts)
        got = {r["__p"]: (int(r["r"]), int(r["c"]), r["lo"], r["hi"], int(r["d"])) for r in placed.groupBy("__p").agg(
            F.sum("__r").alias("r"), F.sum(1 - F.col("__r")).alias("c"), F.min("__x").alias("lo"), F.max("__x").alias("hi"),
            F.approx_count_distinct("__x").alias("d")).collect()}            # one row per range
        ends = [float("-inf"), *cuts, float("inf")]
        parts = []
        for a0, z0, r0, c0 in todo:
            r, c = r0, c0
            for k in range(len(ends) - 1):
                a, z = ends[k], ends[k + 1]
                if a < a0 or z > z0:
                    continue
                gr, gc, lo, hi, d = got.get(k, (0, 0, None, None, 0))
                best = max(best, abs(r * one - c * two), abs((r + gr) * one - (c + gc) * two))
                if gr + gc and lo != hi:
                    parts.append((max((r + gr) * one - c * two, (c + gc) * two - r * one), a, z, r, c, d))
                r, c = r + gr, c + gc
        parts = [p for p in parts if p[0] > best]
        if not parts:
            break
        todo = [(a, z, r, c) for _, a, z, r, c, _ in parts]
        edges = sorted({z for a, z, *_ in todo for z in (a, z) if abs(z) != float("inf")})
        number = {a: i for i, (a, *_) in enumerate(todo)}
        place = F.lit([number.get(a, -1) for a in [float("-inf"), *edges]])
        # Each range between edges is one of ``todo`` or lies outside all: a lookup, however many there are.
        kept = _half_open(rows, edges).withColumn("__p", place[F.col("__p")]).where("__p >= 0")
        few = sum(p[5] for p in parts) <= values
        bounds = [] if few else kept.agg(F.percentile_approx("__x", fractions, max(10_000, 4 * ranges))).first()[0] or []
        if few or not any(a < b < z for b in bounds for a, z, *_ in todo):
            before = {n: F.lit([t[i] for t in todo]).cast("array<long>")[F.col("__p")] for n, i in (("r", 2), ("c", 3))}
            points = kept.groupBy("__p", "__x").agg(F.sum("__r").alias("r"), F.sum(1 - F.col("__r")).alias("c"))
            run = Window.partitionBy("__p").orderBy("__x")                  # a few values of one range
            gap = F.abs((before["r"] + F.sum("r").over(run)) * one - (before["c"] + F.sum("c").over(run)) * two)
            best = max(best, points.select(gap.alias("g")).agg(F.max("g")).first()[0] or 0.0)
            break
        kept = kept.drop("__p")
    return df.sparkSession.range(1).select(F.lit(float(best)).alias("ks_stat"), F.lit(nr).cast("long").alias("reference_rows"),
                                           F.lit(nc).cast("long").alias("current_rows"))
