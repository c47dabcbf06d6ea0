import datetime as dt

import pytest
from pyspark.sql import functions as F

from cutpoint.streaming.daily_mix import daily_counts, run_to_table


@pytest.mark.parametrize("files", [1, 4])
def test_stream_equals_batch_for_any_layout(spark, tmp_path, files):
    """Every day is there and late rows count, one file per micro-batch included."""
    d0 = dt.datetime(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=(7 * k) % 11, hours=k % 24), (k % 10) / 10, k % 2) for k in range(200)]
    src = str(tmp_path / "src.parquet")
    spark.createDataFrame(rows, "ts timestamp, score double, label int").repartition(files).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_to_table(spark, stream, 0.2, 0.8, str(tmp_path / "out"), str(tmp_path / "ck"))
    want = daily_counts(spark.read.parquet(src), 0.2, 0.8)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 11 and got.agg(F.sum("rows")).first()[0] == 200


def test_late_file_amends_its_day(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src.parquet", "out", "ck"))
    schema = "ts timestamp, score double, label int"
    day = dt.datetime(2024, 5, 1)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        return {r["day"]: r["rows"] for r in run_to_table(spark, stream, 0.2, 0.8, out, ck).collect()}
    assert run([(day, 0.1, 0), (day + dt.timedelta(days=30), 0.9, 1)]) == {"2024-05-01": 1, "2024-05-31": 1}
    assert run([(day, 0.5, 0)]) == {"2024-05-01": 2, "2024-05-31": 1}
