"""Daily decision mix as a stream.

Each micro-batch is reduced to counts per day and band and written under its own batch
number; a repeated batch overwrites itself. Reading the table sums the batches by day, so
every day is present as soon as one of its rows is, and a late row amends its day instead
of being dropped. The query keeps no state between batches. ``TIMESTAMP_NTZ`` columns are
read as UTC wall-clock time, so days are the naive dates whatever the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.functions import bands
from cutpoint.functions.timekeys import as_instant

COUNTS = ("rows", "approve_count", "review_count", "decline_count", "fraud_total", "fraud_flagged")


def utc_day(instant):
    """The UTC calendar day of an instant, independent of the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(instant) / 86_400_000_000).cast("int"))


def daily_counts(events: DataFrame, t1: float, t2: float, ts: str = "ts", score: str = "score",
                 label: str = "label") -> DataFrame:
    """Counts per day of one batch (or of a whole batch table)."""
    s, y = F.col(score).cast("double"), F.col(label)
    d = bands.decision(s, t1, t2)
    day = F.date_format(utc_day(as_instant(events, ts)), "yyyy-MM-dd").alias("day")
    counted = events.groupBy(day).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(d == bands.APPROVE).alias("approve_count"),
        F.count_if(d == bands.REVIEW).alias("review_count"), F.count_if(d == bands.DECLINE).alias("decline_count"),
        F.count_if(y == 1).alias("fraud_total"), F.count_if((y == 1) & (d != bands.APPROVE)).alias("fraud_flagged"),
        F.count_if(bands.is_bad(s)).alias("bad"))
    return counted.withColumn("rows", bands.guarded(F.col("rows"), F.col("bad"))).drop("bad")


def read_mix(spark: SparkSession, out_path: str) -> DataFrame:
    """The mix so far: the batches' counts summed by day."""
    parts = spark.read.schema("day string, " + ", ".join(f"{c} long" for c in COUNTS)).parquet(f"{out_path}/batch=*")
    return parts.groupBy("day").agg(*(F.sum(c).alias(c) for c in COUNTS))


def run_to_table(spark: SparkSession, stream: DataFrame, t1: float, t2: float, out_path: str,
                 checkpoint: str) -> DataFrame:
    """Drain the available input (``availableNow``) into ``out_path`` in the shared folder and
    return the mix. A restarted query resumes from the checkpoint's offsets."""
    def write(batch: DataFrame, number: int) -> None:
        daily_counts(batch, t1, t2).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_mix(spark, out_path)
