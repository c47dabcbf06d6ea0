"""Time keys that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since 1970-01-01 as a long. A ``TIMESTAMP_NTZ`` is read
    as UTC wall-clock time (its fields, not the session zone), so day
    windows and orderings match the naive timestamps in every engine."""
    t = dict(df.dtypes)[col]
    c = F.col(col)
    if t == "timestamp_ntz":
        secs = (F.unix_date(F.to_date(c)).cast("long") * 86400
                + F.hour(c).cast("long") * 3600 + F.minute(c).cast("long") * 60)
        frac = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return secs * 1_000_000 + frac
    if t == "timestamp":
        return F.unix_micros(c)
    if t == "date":
        return F.unix_date(c).cast("long") * 86_400_000_000
    return c.cast("long")


def as_instant(df: DataFrame, col: str) -> Column:
    """A zoned TIMESTAMP for event-time operators (watermarks need one)."""
    return F.timestamp_micros(epoch_micros(df, col))


def literal_like(df: DataFrame, col: str, micros_or_value) -> Column:
    """A literal of ``col``'s own type for a value of ``epoch_micros`` (or the
    plain value for other types), built without the session zone, so a filter
    ``col == literal`` can be pushed into the Parquet scan."""
    import datetime as _dt
    t = dict(df.dtypes)[col]
    if t == "timestamp_ntz":
        wall = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=int(micros_or_value))
        return F.lit(wall.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if t == "timestamp":
        return F.timestamp_micros(F.lit(int(micros_or_value)))
    if t == "date":
        return F.date_from_unix_date(F.lit(int(micros_or_value) // 86_400_000_000))
    return F.lit(micros_or_value).cast(t)
