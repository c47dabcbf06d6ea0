"""Daily decision mix on event time (D7): watermark, tumbling windows, state, append mode.

Unlike ``daily_mix``, which amends a day whenever one of its rows comes, this stream closes days:
rows are counted in one-day event-time windows kept in the state store, and a window leaves the
state, once and for good, when the watermark (the latest event time seen less a delay) passes its
end. The sink is append-only Parquet with exactly-once batches; a restarted query goes on
from the offsets and the state in its checkpoint. Rows behind the watermark are dropped by the
window operator and counted in ``EventTimeRun.late_rows``.

What the state holds is one row per open day, whatever the number of rows. Open days are read from the
state store itself (``open_days``), so nothing is lost between the sink and the state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.functions import bands
from cutpoint.functions.timekeys import as_instant
from cutpoint.streaming.daily_mix import COUNTS, utc_day

CLOSED, OPEN = "closed", "open"
DAY_SCHEMA = "day string, " + ", ".join(f"{c} long" for c in COUNTS)


@dataclass(frozen=True)
class EventTimeRun:
    """What one drain of the stream did."""
    batches: int
    late_rows: int


def _day(window: str):
    return F.date_format(utc_day(F.col(window)), "yyyy-MM-dd").alias("day")


def windowed_mix(stream: DataFrame, t1: float, t2: float, delay: str, ts: str = "ts", score: str = "score",
                 label: str = "label") -> DataFrame:
    """Counts per one-day event-time window. A null or NaN score belongs to no band (trap 2)
    and fails the batch that holds it."""
    s, y = F.col(score).cast("double"), F.col(label)
    good = F.when(bands.is_bad(s), F.raise_error(F.lit("null or NaN score"))).otherwise(s)
    rows = stream.select(as_instant(stream, ts).alias("__at"), bands.decision(good, t1, t2).alias("__d"), y.alias("__y"))
    d, fraud = F.col("__d"), F.col("__y") == 1
    # The order of the counts is the order of COUNTS: the state is read back by position.
    return rows.withWatermark("__at", delay).groupBy(F.window("__at", "1 day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(d == bands.APPROVE).alias("approve_count"),
        F.count_if(d == bands.REVIEW).alias("review_count"), F.count_if(d == bands.DECLINE).alias("decline_count"),
        F.count_if(fraud).alias("fraud_total"), F.count_if(fraud & (d != bands.APPROVE)).alias("fraud_flagged"))


def run_event_time(stream: DataFrame, t1: float, t2: float, out_path: str, checkpoint: str,
                   delay: str = "30 days") -> EventTimeRun:
    """Drain the available input (``availableNow``); closed days are appended to ``out_path``."""
    mix = windowed_mix(stream, t1, t2, delay).select(_day("window.start"), *COUNTS)
    q = (mix.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    done = q.recentProgress
    return EventTimeRun(len(done), sum(int(s["numRowsDroppedByWatermark"]) for p in done for s in p["stateOperators"]))


def closed_days(spark: SparkSession, out_path: str) -> DataFrame:
    """The days that the stream has closed so far."""
    try:
        return spark.read.schema(DAY_SCHEMA).parquet(out_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DAY_SCHEMA)


def open_days(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The days still in the state, with their counts so far."""
    held = spark.read.format("statestore").load(checkpoint)
    counts = F.col("value").cast("struct<" + ", ".join(f"{c}: long" for c in COUNTS) + ">")
    return held.select(_day("key.window.start"), counts.alias("c")).select("day", "c.*")


def days(spark: SparkSession, out_path: str, checkpoint: str) -> DataFrame:
    """All days seen: ``day, state`` (closed or open) and the counts."""
    closed = closed_days(spark, out_path).withColumn("state", F.lit(CLOSED))
    return closed.unionByName(open_days(spark, checkpoint).withColumn("state", F.lit(OPEN))).select("day", "state", *COUNTS)
