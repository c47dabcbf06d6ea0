"""Isotonic calibration without the driver (M6): pooled blocks that merge.

Pool-adjacent-violators may pool neighbouring blocks in any order, so it can be run in
pieces: the blocks of a score range are a complete summary of the range, and pooling the
blocks of two neighbouring ranges gives the blocks of both. The fit is therefore a tree
of groupings over a table of blocks: one pass per range, then rounds that join ``FAN``
neighbouring ranges each. The driver sees nothing but the range bounds.

How many rows a round hands to a group: blocks are kept in strictly increasing means, and
blocks of equal mean are one. With 0/1 labels the (rows, positives) pairs of the blocks are
integer vectors of different slopes, so n rows make O(n^(2/3)) blocks at the very most, and
about n^(1/3) on ordinary data, whatever the number of distinct scores.

The fitted function is a table of segments, from one block edge to the next. It is applied by
an as-of join (``prefix.as_of``) on the distinct scores, so neither side has to be small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cutpoint.operators.prefix import AUTO, as_of, assign_range, range_bounds, reuse

#: Neighbouring ranges joined into one by each round.
FAN = 16

BLOCK_SCHEMA = "part int, x_first double, x_last double, total double, weight double"
SEGMENT_SCHEMA = "x_from double, y_from double, x_to double, y_to double"


def pool(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """First positions of the blocks of an increasing fit to points in order.

    Each pass pools every maximal run of neighbours whose means do not rise: of three
    such neighbours the first two pool to a mean no lower than the third's, so the whole run
    belongs to one block."""
    first = np.arange(len(total))
    while len(first) > 1:
        sums, weights = np.add.reduceat(total, first), np.add.reduceat(weight, first)
        mean = sums / weights
        rises = np.concatenate([[True], mean[1:] > mean[:-1]])
        if rises.all():
            break
        first = first[rises]
    return first


def _blocks(table: pa.Table) -> dict[str, np.ndarray]:
    """The pooled blocks of points or blocks given in any order."""
    col = {c: table.column(c).to_numpy() for c in ("x_first", "x_last", "total", "weight")}
    order = np.argsort(col["x_first"], kind="stable")
    col = {c: v[order] for c, v in col.items()}
    first = pool(col["total"], col["weight"])
    last = np.concatenate([first[1:], [len(order)]]) - 1
    return {"x_first": col["x_first"][first], "x_last": col["x_last"][last],
            "total": np.add.reduceat(col["total"], first), "weight": np.add.reduceat(col["weight"], first)}


def _merge(shift: int):
    """Grouped map: pools one group and renumbers it for the next round."""
    def run(table: pa.Table) -> pa.Table:
        out = _blocks(table)
        part = np.full(len(out["x_first"]), table.column("part")[0].as_py() // shift, np.int32)
        return pa.table({"part": part, **out})
    return run


def blocks(points: DataFrame, buckets: int | None = AUTO, fan: int = FAN) -> DataFrame:
    """``x_first, x_last, total, weight`` of the pooled blocks of ``points`` (``x, total,
    weight``; one row per distinct x)."""
    p = reuse(points)
    bounds = range_bounds(p, "x", buckets)
    parts = assign_range(p, "x", bounds, "part").select(
        "part", F.col("x").alias("x_first"), F.col("x").alias("x_last"), "total", "weight")
    ranges = len(bounds) + 1
    merged = parts.groupBy("part").applyInArrow(_merge(fan), BLOCK_SCHEMA)
    while ranges > 1:
        ranges = -(-ranges // fan)
        merged = merged.groupBy("part").applyInArrow(_merge(fan), BLOCK_SCHEMA)
    return merged


def _segments(table: pa.Table) -> pa.Table:
    """Edges of all blocks in order, each with the next; the ends reach to infinity."""
    order = np.argsort(table.column("x_first").to_numpy())
    col = {c: table.column(c).to_numpy()[order] for c in ("x_first", "x_last", "total", "weight")}
    mean, wide = col["total"] / col["weight"], col["x_last"] > col["x_first"]
    at = np.repeat(np.arange(len(order)), 1 + wide)
    second = np.concatenate([[False], at[1:] == at[:-1]])
    x, y = np.where(second, col["x_last"][at], col["x_first"][at]), mean[at]
    return pa.table({"x_from": np.concatenate([[-np.inf], x]), "y_from": np.concatenate([y[:1], y]),
                     "x_to": np.concatenate([x, [np.inf]]), "y_to": np.concatenate([y, y[-1:]])})


def fit(cal: DataFrame, score: str = "score", label: str = "label", weight: str | None = None,
        buckets: int | None = AUTO, fan: int = FAN) -> DataFrame:
    """Segments of the increasing fit: rows, or a (score, label, ``weight``) histogram, are
    first added up to one point per distinct score. No rows give no segments."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    points = cal.groupBy(F.col(score).cast("double").alias("x")).agg(
        F.sum(F.col(label).cast("double") * w).alias("total"), F.sum(w).alias("weight"))
    # After the last round all blocks carry the same number.
    found = blocks(points, buckets, fan)
    return found.groupBy(F.col("part") * 0).applyInArrow(_segments, SEGMENT_SCHEMA)


def value(x: Column) -> Column:
    """The fit at ``x`` within its segment: a straight line, flat at both ends."""
    y0, y1, x0, x1 = (F.col(c) for c in ("y_from", "y_to", "x_from", "x_to"))
    flat = (y0 == y1) | (x == x0)
    return F.when(flat, y0).otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0))


def apply(segments: DataFrame, ev: DataFrame, score: str = "score", buckets: int | None = AUTO) -> DataFrame:
    """``ev`` with ``score`` replaced by its fitted value. Only distinct scores meet the
    segments; rows then look up their score, so a score shared by a third of all rows is
    compared once."""
    cols = [c for c in ev.columns if c != score]
    rows = ev.withColumn("__iso_x", F.col(score).cast("double"))
    distinct = rows.select("__iso_x").distinct()
    known = as_of(distinct, "__iso_x", segments, "x_from", buckets)
    fitted = known.select("__iso_x", value(F.col("__iso_x")).alias("__iso_y"))
    return rows.join(fitted, "__iso_x").select(*cols, F.col("__iso_y").alias(score))
