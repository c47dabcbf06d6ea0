"""Order statistics without a single-task global sort (rewrite 2).

``Window.orderBy(x)`` with no partition moves every row to one task. The
operators here split the order key into ranges whose bounds come from one
``percentile_approx`` aggregate (bounded sketches, map-side merge), compute
per-range totals (at most ``buckets`` rows), turn them into running offsets,
and finish with windows partitioned by range. Bounds only balance the work:
results are exact for any bounds, and the bounds are collected once and used
as literals, so a recomputed task sees the same ranges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.functions.bands import guarded, is_bad

DEFAULT_BUCKETS = 64
AUTO = None   # buckets=None: derive from spark.sql.shuffle.partitions

_PERSISTED: list[DataFrame] = []


RELIABLE_REUSE = "spark.cutpoint.reliableReuse"


def reuse(df: DataFrame) -> DataFrame:
    """Persist a reduced table read by more than one job (the bounds job and
    the main plan). Memory first, spilling to disk; a lost block is rebuilt
    from lineage, which is deterministic. ``release()`` drops them all.

    With ``spark.cutpoint.reliableReuse=true`` the table is instead written
    as a reliable checkpoint into ``spark.checkpoint.dir`` (shared storage),
    cutting the lineage: for long pipelines on clusters where recomputing
    after an executor loss costs more than the write."""
    from pyspark import StorageLevel
    if df.isStreaming:
        return df
    if (df.sparkSession.conf.get(RELIABLE_REUSE, "false") or "false").lower() == "true":
        from cutpoint.session import cut_lineage
        return cut_lineage(df)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(df)
    return df


def release() -> None:
    while _PERSISTED:
        _PERSISTED.pop().unpersist()


def default_buckets(df: DataFrame) -> int:
    """Ranges follow the cluster's shuffle width (sized for the data by the
    operator of the job), never fewer than DEFAULT_BUCKETS."""
    try:
        sp = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        sp = DEFAULT_BUCKETS
    return max(DEFAULT_BUCKETS, sp)


def range_bounds(df: DataFrame, col: str | Column, buckets: int | None) -> list[float]:
    """Up to ``buckets - 1`` increasing interior bounds at equal-count quantiles."""
    buckets = default_buckets(df) if buckets is None else buckets
    buckets = max(1, int(buckets))
    if buckets == 1:
        return []
    c = F.col(col) if isinstance(col, str) else col
    qs = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 4 * buckets)
    row = df.agg(F.percentile_approx(c.cast("double"), qs, accuracy).alias("q")).first()
    vals = row["q"] or []
    out = sorted({float(v) for v in vals if v is not None and not math.isnan(v)
                  and not math.isinf(v)})
    return out


def assign_range(df: DataFrame, col: str, bounds: Sequence[float], out: str) -> DataFrame:
    """``out`` = number of bounds <= value (binary search on the JVM side)."""
    if not bounds:
        return df.withColumn(out, F.lit(0))
    tmp = f"__{out}_d"
    bz = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol=col,
                    outputCol=tmp, handleInvalid="keep")
    return bz.transform(df).withColumn(out, F.coalesce(F.col(tmp).cast("int"), F.lit(-1))).drop(tmp)


def running_total(df: DataFrame, order_col: str, value_cols: Sequence[str],
                  by: Sequence[str] = (), descending: bool = False,
                  buckets: int | None = AUTO, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<v>`` = sum of v over rows whose order key comes at or before
    this row's (ties included, RANGE semantics), within each ``by`` group.

    ``order_col`` must be numeric. Typical input is already aggregated to one
    row per distinct key (``groupBy(key).agg(...)``), so ranges split
    distinct values evenly and a hot key costs one row, not one task.
    """
    key = "__rt_key"
    k = F.col(order_col).cast("double")
    d = reuse(df.withColumn(key, -k if descending else k))
    bounds = range_bounds(d, key, buckets)
    d = assign_range(d, key, bounds, "__rt_b")
    tot = d.groupBy(*by, "__rt_b").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    w_off = (Window.partitionBy(*by).orderBy("__rt_b")
             .rowsBetween(Window.unboundedPreceding, -1))
    off = tot.select(*by, "__rt_b", *[F.coalesce(F.sum(f"__t_{v}").over(w_off), F.lit(0))
                                      .alias(f"__o_{v}") for v in value_cols])
    if not by:
        # At most len(bounds) + 1 rows: a checked, bounded broadcast.
        off = F.broadcast(off)
    j = d.join(off, [*by, "__rt_b"])
    w_in = Window.partitionBy(*by, "__rt_b").orderBy(key)   # RANGE frame: ties together
    return j.select(*df.columns, *[(F.col(f"__o_{v}") + F.sum(v).over(w_in)).alias(f"{prefix}{v}")
                                   for v in value_cols])


def global_position(df: DataFrame, order_cols: Sequence[str], by: Sequence[str] = (),
                    buckets: int | None = AUTO, out: str = "pos") -> DataFrame:
    """1-based position of each row in the total order ``order_cols`` (which
    must be unique per row within ``by``). Ranges come from the first order
    column, which should have many distinct values."""
    first = order_cols[0]
    key = "__gp_key"
    d = reuse(df.withColumn(key, F.col(first).cast("double")))
    bounds = range_bounds(d, key, buckets)
    d = assign_range(d, key, bounds, "__gp_b")
    cnt = d.groupBy(*by, "__gp_b").agg(F.count(F.lit(1)).alias("__gp_n"))
    w_off = Window.partitionBy(*by).orderBy("__gp_b").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.select(*by, "__gp_b", F.coalesce(F.sum("__gp_n").over(w_off), F.lit(0)).alias("__gp_o"))
    if not by:
        off = F.broadcast(off)
    j = d.join(off, [*by, "__gp_b"])
    w_in = Window.partitionBy(*by, "__gp_b").orderBy(*order_cols)
    return j.select(*df.columns, (F.col("__gp_o") + F.row_number().over(w_in)).alias(out))


def as_of(df: DataFrame, key: str, table: DataFrame, table_key: str, buckets: int | None = AUTO) -> DataFrame:
    """Each row of ``df`` with the row of ``table`` whose ``table_key`` is the largest at or
    below ``key`` (null columns where there is none).

    Both sides are cut into the same ranges; within a range one window carries the last table
    row forward, and a range starts with the last table row of the ranges before it (one row
    per range, broadcast). Neither side needs to be small. Keys should be distinct in both:
    a repeated key is one row in one range."""
    names = table.columns
    left = df.select(F.struct(*df.columns).alias("__row"), F.col(key).cast("double").alias("__k"), F.lit(1).alias("__side"),
                     F.lit(None).cast(table.select(F.struct(*names).alias("t")).schema["t"].dataType).alias("__t"))
    right = table.select(F.lit(None).cast(left.schema["__row"].dataType).alias("__row"),
                         F.col(table_key).cast("double").alias("__k"), F.lit(0).alias("__side"), F.struct(*names).alias("__t"))
    both = reuse(left.unionByName(right))
    cut = assign_range(both, "__k", range_bounds(both, "__k", buckets), "__b")
    last = cut.groupBy("__b").agg(F.max_by("__t", F.when(F.col("__side") == 0, F.col("__k"))).alias("__last"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)     # one row per range
    start = last.select("__b", F.last("__last", ignorenulls=True).over(before).alias("__start"))
    carried = F.last("__t", ignorenulls=True).over(Window.partitionBy("__b").orderBy("__k", "__side"))
    found = (cut.join(F.broadcast(start), "__b").withColumn("__f", F.coalesce(carried, F.col("__start")))
             .where(F.col("__side") == 1))
    return found.select("__row.*", *[F.col("__f")[n].alias(n) for n in names])


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (),
                    buckets: int | None = AUTO, weight: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy ``quantile`` default).

    For n values sorted x[0..n-1], q -> h = (n-1) q, result
    x[floor h] + (h - floor h) (x[floor h + 1] - x[floor h]).
    Distinct values with counts get running totals; each distinct value emits
    the requested order statistics it covers (a bounded literal list), so no
    row is ever compared with a table of positions. ``weight`` names an
    integer count column when ``df`` is already a (value, count) histogram.
    Output: by columns, ``q`` (double), ``value``.
    """
    v = F.col(col).cast("double")
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    base = df.select(*by, v.alias("__v"), w.alias("__w"))
    dist = base.groupBy(*by, "__v").agg(F.sum("__w").alias("__c"))
    # Null and NaN values have no place in the order: reading them fails with their count.
    dist = reuse(dist.withColumn("__v", guarded(F.col("__v"), F.when(is_bad(F.col("__v")), F.col("__c")))))
    cum = reuse(running_total(dist, "__v", ["__c"], by=by, buckets=buckets))
    if by:
        sizes = dist.groupBy(*by).agg(F.sum("__c").alias("__n"))
        cum = cum.join(sizes, list(by))
    else:
        n = dist.agg(F.sum("__c").alias("n")).first()["n"] or 0
        cum = cum.withColumn("__n", F.lit(int(n)))
    return interpolate(cum.select(*by, "__v", (F.col("cum___c") - F.col("__c")).alias("__s"), F.col("cum___c").alias("__e"),
                                  "__n"), qs, by)


def interpolate(cum: DataFrame, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles from values ``__v`` that cover the 0-based positions ``__s`` to ``__e`` (exclusive)
    of the ``__n`` ordered rows of their group; only the values at the wanted positions are needed."""
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    s, e = F.col("__s"), F.col("__e")
    # order statistics needed by q: lo = floor(h) and lo + 1
    need = F.transform(qarr, lambda q: F.struct(
        q.alias("q"),
        F.floor((F.col("__n") - 1).cast("double") * q).cast("long").alias("lo"),
        ((F.col("__n") - 1).cast("double") * q).alias("h")))
    mine = F.filter(need, lambda r: ((r["lo"] >= s) & (r["lo"] < e))
                    | ((r["lo"] + 1 >= s) & (r["lo"] + 1 < e)))
    hits = cum.select(*by, "__v", s.alias("s"), e.alias("e"), F.explode(mine).alias("r")).select(
        *by, "__v", F.col("r.q").alias("q"), F.col("r.lo").alias("lo"), F.col("r.h").alias("h"),
        "s", "e")
    lo_hit = hits.filter((F.col("lo") >= F.col("s")) & (F.col("lo") < F.col("e")))
    hi_hit = hits.filter((F.col("lo") + 1 >= F.col("s")) & (F.col("lo") + 1 < F.col("e")))
    lo_v = lo_hit.select(*by, "q", "h", "lo", F.col("__v").alias("x_lo"))
    hi_v = hi_hit.select(*by, "q", F.col("__v").alias("x_hi"))
    j = lo_v.join(hi_v, [*by, "q"], "left")
    t = F.col("h") - F.col("lo").cast("double")
    x_hi = F.coalesce(F.col("x_hi"), F.col("x_lo"))
    # numpy's lerp: a + (b-a) t for t < 0.5, b - (b-a)(1-t) otherwise
    val = F.when(t >= 0.5, x_hi - (x_hi - F.col("x_lo")) * (F.lit(1.0) - t)) \
           .otherwise(F.col("x_lo") + (x_hi - F.col("x_lo")) * t)
    return j.select(*by, "q", val.alias("value"))
