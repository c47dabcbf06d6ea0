import datetime as dt

import pytest

from cutpoint.streaming import event_time as E
from cutpoint.streaming.daily_mix import COUNTS, daily_counts

D0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, score double, label int"


def rows(days, per_day=7):
    return [(D0 + dt.timedelta(days=d, hours=3 * k), ((d + k) % 10) / 10, (d * k) % 2) for d in days for k in range(per_day)]


@pytest.fixture()
def place(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src.parquet", "out", "ck"))

    def run(new, files=1):
        spark.createDataFrame(new, SCHEMA).repartition(files).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        did = E.run_event_time(stream, 0.2, 0.8, out, ck, "2 days")
        return did, {r["day"]: r for r in E.days(spark, out, ck).collect()}, spark.read.parquet(src)
    return run


def by_day(df):
    return {r["day"]: tuple(r[c] for c in COUNTS) for r in df.collect()}


@pytest.mark.parametrize("files", [1, 3])
def test_days_equal_the_batch_mix_and_close_behind_the_watermark(place, files):
    did, got, table = place(rows(range(9)), files)
    want = by_day(daily_counts(table, 0.2, 0.8))
    assert {d: tuple(r[c] for c in COUNTS) for d, r in got.items()} == want
    # The latest row is on day 8 at 18:00, so the watermark stands on day 6 at 18:00: days 0 to 5 are closed.
    assert sorted(d for d, r in got.items() if r["state"] == E.CLOSED) == sorted(want)[:6]
    assert did.late_rows == 0


def test_a_restarted_stream_goes_on_from_its_state(place):
    place(rows(range(4)))
    did, got, table = place(rows(range(3, 9)))
    assert {d: tuple(r[c] for c in COUNTS) for d, r in got.items()} == by_day(daily_counts(table, 0.2, 0.8))
    assert did.late_rows == 0 and got["2024-01-04"]["rows"] == 14
    assert sum(r["state"] == E.CLOSED for r in got.values()) == 6


def test_rows_behind_the_watermark_are_counted_not_added(place):
    _, before, _ = place(rows(range(9)))
    did, got, _ = place(rows([1], per_day=2) + rows([8], per_day=1))
    assert did.late_rows >= 1                       # partial counts of the late day
    assert got["2024-01-02"]["rows"] == before["2024-01-02"]["rows"]
    assert got["2024-01-09"]["rows"] == before["2024-01-09"]["rows"] + 1


def test_a_bad_score_fails_the_stream(place):
    with pytest.raises(Exception, match="null or NaN score"):
        place([(D0, float("nan"), 0)])
