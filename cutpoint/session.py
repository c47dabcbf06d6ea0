"""Session helpers: builder defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "cutpoint",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults the library assumes.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    checkpoint folder must then come from ``spark.checkpoint.dir``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, executors: int = 1000, cores_per_executor: int = 4,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet.

    Shuffle partitions start at input / 256 MB (AQE coalesces small ones
    and splits skewed ones); scans split at 256 MB; explicit broadcasts in
    the library are parameter-sized, so the automatic threshold stays at
    Spark's size check.
    """
    slots = executors * cores_per_executor
    shuffle = max(slots * 2, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading ``spark.checkpoint.dir``.

    Only a local-mode session (tests, benches) without the setting gets a
    fresh folder under the system temp directory; a cluster session without
    it is an error, because a machine-local folder does not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running cutpoint jobs on a cluster")
    path = tempfile.mkdtemp(prefix="cutpoint-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
