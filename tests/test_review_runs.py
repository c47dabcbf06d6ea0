import datetime as dt
import random

import pytest

from cutpoint.operators import monitor


@pytest.mark.parametrize("seed", range(3))
def test_runs_are_the_islands_of_days_over_the_cap(spark, seed):
    rng = random.Random(seed)
    d0 = dt.date(2024, 2, 20)
    days = sorted(rng.sample(range(60), 45))
    daily = [((d0 + dt.timedelta(days=d)).isoformat(), rng.randrange(1, 50), rng.randrange(0, 20), rng.random()) for d in days]
    df = spark.createDataFrame(daily, "day string, rows long, review_count long, review_rate double")
    want, run = [], []
    for row in [x for x in daily if x[3] > 0.4] + [None]:
        if run and (row is None or dt.date.fromisoformat(row[0]) - dt.date.fromisoformat(run[-1][0]) > dt.timedelta(days=1)):
            want.append((run[0][0], run[-1][0], len(run), sum(x[1] for x in run), sum(x[2] for x in run), max(x[3] for x in run)))
            run = []
        run.append(row)
    assert sorted(map(tuple, monitor.review_runs(df, 0.4).collect())) == want
    assert monitor.review_runs(df, 1.0).count() == 0
