"""Sweeps over pair tables that are data themselves (G5, J3 for F5 pairs).

``policy.sweep_counts`` collects the cuts of a grid, whose number follows its parameters. A pair
table made from data may have any number of pairs, and other pairs for every group, so here
cuts and scores are merged as events on one line: each distinct value is one event with its
rows, its positives and negatives, and whether it is a cut. Running totals over ranges
(``prefix.running_total``) give what lies below every cut; pairs look up their two cuts by
equi-joins. Nothing is collected but range bounds, and neither table has to be small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.functions.bands import guarded, is_bad, thresholds_valid
from cutpoint.operators.policy import cost_metrics, policy_metrics
from cutpoint.operators.prefix import AUTO, reuse, running_total

VALUES = ("n", "pos", "neg")


def below_cuts(scored: DataFrame, cuts: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label",
               weight: str | None = None, buckets: int | None = AUTO) -> DataFrame:
    """``by, cut`` with ``n, pos, neg`` below the cut and ``tot_n, tot_pos, tot_neg`` of the group.
    ``cuts`` has ``by`` and ``cut``; groups without rows give no cut."""
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    zero, y = F.lit(0).cast("long"), F.col(label)
    rows = scored.select(*by, F.col(score).cast("double").alias("__x"), w.alias("n"), F.when(y == 1, w).otherwise(zero).alias("pos"),
                         F.when(y == 0, w).otherwise(zero).alias("neg"), F.lit(0).alias("__cut"))
    marks = cuts.select(*by, F.col("cut").cast("double").alias("__x"), *[zero.alias(v) for v in VALUES], F.lit(1).alias("__cut"))
    events = reuse(rows.unionByName(marks).groupBy(*by, "__x").agg(*[F.sum(v).alias(v) for v in VALUES], F.max("__cut").alias("__cut")))
    bad = F.sum(F.when(is_bad(F.col("__x")), F.col("n")))
    totals = events.groupBy(*by).agg(guarded(F.sum("n"), bad).alias("tot_n"), F.sum("pos").alias("tot_pos"), F.sum("neg").alias("tot_neg"))
    run = running_total(events, "__x", VALUES, by=by, buckets=buckets).where("__cut = 1")
    # A score equal to the cut lies above it.
    under = run.select(*by, F.col("__x").alias("cut"), *[(F.col(f"cum_{v}") - F.col(v)).alias(v) for v in VALUES])
    placed = under.join(totals, list(by)) if by else under.crossJoin(F.broadcast(totals))      # one row of totals
    return placed.where(F.col("tot_n") > 0)


def sweep_counts(scored: DataFrame, pairs: DataFrame, by: Sequence[str] = (), score: str = "score", label: str = "label",
                 weight: str | None = None, buckets: int | None = AUTO) -> DataFrame:
    """Base counts for every pair of ``pairs`` (``by, pair_no, t1, t2``) over the rows of its own
    group; same columns as ``policy.sweep_counts``. A pair that breaks 0 <= t1 < t2 <= 1 is an error."""
    t1, t2 = F.col("t1").cast("double"), F.col("t2").cast("double")
    bad = F.raise_error(F.format_string("pair %s breaks 0 <= t1 < t2 <= 1", F.col("pair_no").cast("string")))
    ok = F.coalesce(thresholds_valid(t1, t2), F.lit(False))
    pk = pairs.select(*by, "pair_no", F.when(ok, t1).otherwise(bad).alias("approve_threshold"), t2.alias("decline_threshold"))
    cuts = pairs.select(*by, F.explode(F.array(t1, t2)).alias("cut")).distinct()
    found = reuse(below_cuts(scored, cuts, by, score, label, weight, buckets))
    lo = found.select(*by, F.col("cut").alias("approve_threshold"), *[F.col(v).alias(f"lo_{v}") for v in VALUES], "tot_n", "tot_pos", "tot_neg")
    hi = found.select(*by, F.col("cut").alias("decline_threshold"), *[F.col(v).alias(f"hi_{v}") for v in VALUES])
    j = pk.join(lo, [*by, "approve_threshold"]).join(hi, [*by, "decline_threshold"])
    c = F.col
    return j.select(
        *by, "pair_no", "approve_threshold", "decline_threshold", c("tot_n").alias("total"), c("tot_pos").alias("fraud_total"),
        c("tot_neg").alias("nonfraud_total"), c("lo_n").alias("approve_count"), (c("hi_n") - c("lo_n")).alias("review_count"),
        (c("tot_n") - c("hi_n")).alias("decline_count"), c("lo_pos").alias("fraud_approve"), (c("hi_pos") - c("lo_pos")).alias("fraud_review"),
        (c("tot_pos") - c("hi_pos")).alias("fraud_decline"), (c("tot_neg") - c("hi_neg")).alias("nonfraud_decline"))


def evaluate_pairs(scored: DataFrame, pairs: DataFrame, by: Sequence[str] = (), **kw) -> DataFrame:
    """G3's metrics per pair of each group's own pairs."""
    return policy_metrics(sweep_counts(scored, pairs, by, **kw), keep=[*by, "pair_no"])


def cost_pairs(scored: DataFrame, pairs: DataFrame, c_fn: float, c_fd: float, c_rev: float, by: Sequence[str] = (), **kw) -> DataFrame:
    """G4's metrics per pair of each group's own pairs."""
    return cost_metrics(sweep_counts(scored, pairs, by, **kw), c_fn, c_fd, c_rev, keep=[*by, "pair_no"])
