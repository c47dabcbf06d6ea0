"""Operator 9: exact duplicates with a heavy-hitter split.

Every whole text is normalised (each run of white space becomes one space) and
digested with SHA-256. A Misra-Gries summary (``freqItems``, at most
``1 / support`` counters per task, merged on the way to the driver) proposes the
digests that more than ``support`` of the rows may carry. One exact count
verifies them; the winners, never more than ``1 / support`` rows, are broadcast
and settle their rows on the map side. All other digests take the ordinary
shuffle, where no key holds more than ``support`` of the rows.

Defined results: null texts count as empty; an empty table gives no rows; rows
with a null ``doc_id`` lose to any numbered row, and stay if their whole group is
unnumbered; repeated rows with the same ``doc_id`` and text share one verdict in
``annotate``, and ``dedup`` keeps the one whose raw text sorts first. Other columns are ignored by ``annotate`` and passed through by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cutpoint.llm.common import SPACE_RUN, store, text_or_empty, whole

SUPPORT = 0.001


def digest(column: str = "text"):
    return F.unhex(F.sha2(F.regexp_replace(text_or_empty(column), SPACE_RUN, " ").cast("binary"), 256))


def heavy_winners(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified frequent digests: ``digest, keep_id, group_size``; at most
    ``1 / support`` rows."""
    candidates = (digests.select(F.hex("digest").alias("d")).freqItems(["d"], support)
                  .select(F.explode("d_freqItems").alias("d"))
                  .select(F.unhex("d").alias("digest")).distinct())
    counted = (digests.join(F.broadcast(candidates), "digest")
               .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return counted.where(F.col("group_size") > digests.count() * support)


def split(digests: DataFrame, support: float = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(winners, groups): the heavy digests, and all other groups."""
    winners = store(heavy_winners(digests, support), "winners")
    groups = (digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
              .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return winners, groups


def annotate(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = store(docs.select("doc_id", digest().alias("digest")), "digests")
    winners, groups = split(digests, support)
    heavy = digests.join(F.broadcast(winners), "digest")
    rest = (digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
            .join(groups, "digest"))
    return heavy.unionByName(rest).select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def repeated(digests: DataFrame) -> DataFrame:
    """``lost_id, lost``: the (id, digest) pairs that occur in more than one row."""
    return (digests.groupBy(F.col("doc_id").alias("lost_id"), F.col("digest").alias("lost"))
            .agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))


def dedup(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each text, all columns unchanged. Texts are not
    shuffled for the heavy digests; the others meet only the ids that go. Rows repeated
    with their id and text, rare as they are, are settled apart: one of them stays."""
    digests = store(docs.select("doc_id", digest().alias("digest")), "digests")
    winners, groups = split(digests, support)
    losers = (digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
              .join(groups.where("group_size > 1"), "digest")
              .where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
              .select(F.col("doc_id").alias("lost_id"), F.col("digest").alias("lost")).distinct())
    rows = whole(docs, F.col("doc_id").alias("id"), digest().alias("digest"))
    heavy = F.broadcast(winners.select(F.col("digest").alias("heavy"), F.col("keep_id").alias("keep")))
    rows = (rows.join(heavy, F.col("digest") == F.col("heavy"), "left")
            .where(F.col("heavy").isNull() | F.col("id").eqNullSafe(F.col("keep"))))
    same = (F.col("digest") == F.col("lost")) & F.col("id").eqNullSafe(F.col("lost_id"))
    rows = rows.join(losers, same, "left_anti")
    again = store(repeated(digests), "repeated-rows")
    if not again.isEmpty():
        at = F.row_number().over(Window.partitionBy("id", "digest").orderBy("row.text"))
        once = rows.join(again, same, "left_semi").withColumn("at", at).where("at = 1").drop("at")
        rows = rows.join(again, same, "left_anti").unionByName(once)
    return rows.select("row.*")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE_RUN}', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
