"""Position splits and samples.

A time split puts the first ``int(n * (1 - test_size))`` rows, in time order,
in train. Positions are never materialised for all rows: per-time counts get
running totals (rewrite 2), each cut is located in exactly one time group
(a bounded driver lookup: one row per cut), rows on either side of that
group are labelled by a range filter, and only the rows *of* the straddling
group get a within-group position, ordered by the tie-break columns. Those
start with a spread key, so even a group holding a third of all rows ranks in
parallel ranges instead of one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions.timekeys import epoch_micros, literal_like
from cutpoint.operators.prefix import AUTO, global_position, reuse, running_total


def numeric_key(df: DataFrame, col: str) -> Column:
    """Order-preserving double for numeric, date and timestamp columns."""
    t = dict(df.dtypes)[col]
    if t.startswith("timestamp") or t == "date":
        return epoch_micros(df, col).cast("double")      # exact below 2^53 us (285 years)
    return F.col(col).cast("double")


def cut_by_position(df: DataFrame, order_col: str, tiebreak: Sequence[str],
                    cuts, labels: Sequence[str], out: str = "split",
                    buckets: int | None = AUTO) -> DataFrame:
    """Label rows by position in the order (order_col, *tiebreak):
    positions [0, cuts[0]) -> labels[0], [cuts[0], cuts[1]) -> labels[1], ...

    ``cuts`` is a list of positions or a function of the row count n
    returning one (n then comes from the per-key counts, not another scan).
    ``tiebreak`` must make the order total; its first column should be a
    spread key with many distinct values.
    """
    key = "__pk"
    d = df.withColumn(key, numeric_key(df, order_col))
    per = reuse(d.groupBy(key).agg(F.count(F.lit(1)).alias("__c")))
    if callable(cuts):
        cuts = cuts(int(per.agg(F.sum("__c")).first()[0] or 0))
    assert len(labels) == len(cuts) + 1
    cum = running_total(per, key, ["__c"], buckets=buckets)
    cut_arr = F.array(*[F.lit(int(c)) for c in cuts])
    before = F.col("cum___c") - F.col("__c")
    hits = (cum.filter(F.exists(cut_arr, lambda c: (before <= c) & (c < F.col("cum___c"))))
            .select(key, before.alias("b"), F.col("cum___c").alias("e")).collect())  # <= len(cuts) rows
    # Each cut c in [0, n) lies in exactly one time group [b, e): rows of
    # smaller keys come before it, larger keys after, and the group's first
    # r = c - b rows (in tie-break order) before. c >= n: nothing after.
    fixed = []
    for c in cuts:
        m = [(float(h[key]), int(h["b"])) for h in hits if int(h["b"]) <= c < int(h["e"])]
        fixed.append((m[0][0], c - m[0][1]) if m else (float("inf"), 0))
    tie_keys = sorted({k for k, r in fixed if r > 0 and k != float("inf")})

    def after_cut(k: float, r: int, pos: Column | None) -> Column:
        kc = F.col(key)
        if k == float("inf"):
            return F.lit(False)
        if pos is None or r == 0:
            return kc >= F.lit(k) if r == 0 else kc > F.lit(k)
        return (kc > F.lit(k)) | ((kc == F.lit(k)) & (pos > F.lit(r)))

    def label_of(pos: Column | None) -> Column:
        idx = sum((after_cut(k, r, pos).cast("int") for k, r in fixed), F.lit(0))
        arr = F.array(*[F.lit(x) for x in labels])
        return F.element_at(arr, idx + 1)

    if not tie_keys:
        return d.withColumn(out, label_of(None)).drop(key)
    in_ties = F.col(key).isin([F.lit(k) for k in tie_keys])
    plain = d.filter(~in_ties).withColumn(out, label_of(None))
    # The straddling groups are found with a predicate on the raw column,
    # which the Parquet scan can push down (row-group statistics skip the
    # rest of the table when it is stored roughly in time order).
    raw = F.col(order_col).isin([literal_like(df, order_col, k) for k in tie_keys])
    tied_rows = df.filter(raw).withColumn(key, numeric_key(df, order_col)).filter(in_ties)
    tied = global_position(tied_rows, list(tiebreak), by=[key], buckets=buckets, out="__wpos")
    tied = tied.withColumn(out, label_of(F.col("__wpos"))).drop("__wpos")
    return plain.unionByName(tied).drop(key)


def temporal_split(df: DataFrame, ts_col: str, tiebreak: Sequence[str], test_size: float = 0.2,
                   buckets: int | None = AUTO) -> DataFrame:
    """``split`` in {train, test}; train = first int(n * (1 - test_size)) rows."""
    return cut_by_position(df, ts_col, tiebreak, lambda n: [int(n * (1 - test_size))],
                           ["train", "test"], buckets=buckets)


def temporal_three_way(df: DataFrame, ts_col: str, tiebreak: Sequence[str],
                       test_size: float = 0.2, calibration_fraction: float = 0.5,
                       buckets: int | None = AUTO) -> DataFrame:
    """W4 then W5: ``split`` in {train, calibration, evaluation}; the test part
    is cut at int(len(test) * fraction), both sides non-empty."""
    if not (0.1 <= calibration_fraction <= 0.9):
        raise ValueError(f"calibration fraction {calibration_fraction} is outside 0.1 to 0.9")

    def cuts(n: int) -> list[int]:
        c1 = int(n * (1 - test_size))
        n_test = n - c1
        k = int(n_test * calibration_fraction)
        if k <= 0 or k >= n_test:
            raise ValueError("the calibration split leaves a part without rows")
        return [c1, c1 + k]
    return cut_by_position(df, ts_col, tiebreak, cuts, ["train", "calibration", "evaluation"],
                           buckets=buckets)


#: Slices of the hash range in which a stratified cut is located.
SLICES = 1 << 16


def stratified_split(df: DataFrame, label_col: str, spread: str, tiebreak: Sequence[str],
                     test_size: float = 0.2, buckets: int | None = AUTO) -> DataFrame:
    """M9: per label, the first ceil(n_c * test_size) rows in hash order are
    test. ``spread`` is an integer hash column; deterministic under any
    partitioning. Counts of ``SLICES`` equal slices of the hash range find the slice
    that holds each label's cut; rows left and right of it are labelled by a
    comparison, and only the rows of that slice are ranked. No row is kept or sorted."""
    ends = df.agg(F.min(spread).cast("long").alias("lo"), F.max(spread).cast("long").alias("hi")).first()
    if ends["lo"] is None:
        return df.withColumn("split", F.lit("train"))
    width = max(1, -(-(ends["hi"] - ends["lo"] + 1) // SLICES))
    part = F.expr(f"(CAST(`{spread}` AS DECIMAL(20,0)) - {ends['lo']}) div {width}")
    counts = df.groupBy(label_col, part.alias("__part")).agg(F.count(F.lit(1)).alias("__k"))
    run = Window.partitionBy(label_col).orderBy("__part")            # at most SLICES rows per class
    n = F.sum("__k").over(Window.partitionBy(label_col))
    cut = (counts.withColumn("__upto", F.sum("__k").over(run))
           .withColumn("__n_test", F.ceil(n.cast("double") * F.lit(float(test_size))))
           .filter((F.col("__upto") >= F.col("__n_test")) & (F.col("__upto") - F.col("__k") < F.col("__n_test")))
           .select(label_col, F.col("__part").alias("__cut"),
                   (F.col("__n_test") - F.col("__upto") + F.col("__k")).alias("__need")))
    j = df.withColumn("__part", part).join(F.broadcast(cut), label_col, "left")      # one row per class
    sides = j.filter(F.col("__cut").isNull() | (F.col("__part") != F.col("__cut")))
    sides = sides.withColumn("split", F.when(F.col("__part") < F.col("__cut"), "test").otherwise("train"))
    edge = j.filter(F.col("__part") == F.col("__cut"))
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy(spread, *tiebreak))
    edge = edge.withColumn("split", F.when(rank <= F.col("__need"), "test").otherwise("train"))
    return sides.unionByName(edge).drop("__part", "__cut", "__need")


def fixed_sample(df: DataFrame, n: int, order: Sequence[str], oversample: float = 2.0) -> DataFrame:
    """A fixed-size uniform sample without replacement: the n smallest
    rows by (seeded hash, key). ``limit`` is the feature here.

    A plain ordered limit merges n rows from *every* partition in one task.
    Instead one aggregate returns the row count and a ladder of approximate
    quantiles of the hash; the smallest rung expected to keep about
    ``oversample * n`` rows becomes a cut, a count verifies that at least n
    rows fall under it (else the next rung is tried), and the ordered limit
    runs on those candidates only. Exact: every row below the cut is kept,
    and the n smallest rows are all below it.
    """
    n = int(n)
    first = F.col(order[0]).cast("double")
    ladder = sorted({min(1.0, 2.0 ** -k) for k in range(0, 41)})
    r = df.agg(F.count(F.lit(1)).alias("rows"),
               F.percentile_approx(first, ladder, 10_000).alias("q")).first()
    total = int(r["rows"] or 0)
    if total <= n:
        return df.orderBy(*order).limit(n)
    qv = list(zip(ladder, r["q"]))
    want = min(1.0, oversample * n / total)
    for q, cut in qv:
        if q < want or cut is None:
            continue
        cand = df.filter(first <= F.lit(float(cut)))
        if q >= 1.0 or cand.count() >= n:
            return cand.orderBy(*order).limit(n)
    return df.orderBy(*order).limit(n)
