"""Run log as a table.

Instead of a tracking server, each run appends one row (run id, name,
params MAP, metrics MAP, tags MAP) to a Parquet table in the shared folder.
Metrics arrive as a DataFrame of (key, value) computed by Spark and are
folded into the map by an aggregate, so nothing passes through the driver
but the run's identity.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cutpoint.functions.pairs import parse_tag_specs


def log_run(spark: SparkSession, table: str, run_name: str, params: dict[str, str],
            metrics: DataFrame, tags_spec: str | None = None) -> str:
    run_id = uuid.uuid4().hex
    tags = parse_tag_specs(spark.range(1).select(F.lit(tags_spec or "").alias("spec")), "spec")
    bad = tags.select(F.size("bad_tokens")).first()[0]
    if bad:
        raise ValueError("Invalid tag: expected key=value")
    pmap = F.create_map(*[x for k, v in sorted(params.items()) for x in (F.lit(k), F.lit(str(v)))]) if params \
        else F.create_map().cast("map<string,string>")
    m = metrics.agg(F.map_from_entries(F.collect_list(F.struct(F.col("key"), F.col("value").cast("double"))))
                    .alias("metrics"))
    tag_map = tags.first()["tags"] or {}          # a handful of user tags
    tmap = (F.create_map(*[x for k, v in sorted(tag_map.items()) for x in (F.lit(k), F.lit(v))])
            if tag_map else F.create_map().cast("map<string,string>"))
    row = m.select(F.lit(run_id).alias("run_id"), F.lit(run_name).alias("run_name"),
                   pmap.alias("params"), "metrics", tmap.alias("tags"),
                   F.current_timestamp().alias("logged_at"))
    row.write.mode("append").parquet(table)
    return run_id


def read_run(spark: SparkSession, table: str, run_id: str) -> DataFrame:
    """One row per metric of a logged run, with its params and tags."""
    r = spark.read.parquet(table).filter(F.col("run_id") == run_id)
    return r.select("run_name", F.explode("metrics").alias("metric", "value"),
                    F.to_json("params").alias("params"), F.to_json("tags").alias("tags"))
