"""Shared helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Computed doubles are compared across engines at 6 decimal places.
DECIMALS = 6


def round_doubles(df: DataFrame, places: int = DECIMALS) -> DataFrame:
    """Doubles rounded to ``places``; every integer type widened to bigint."""
    out = []
    for c, t in df.dtypes:
        if t in ("double", "float"):
            out.append(F.round(F.col(c).cast("double"), places).alias(c))
        elif t in ("int", "smallint", "tinyint"):
            out.append(F.col(c).cast("long").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def one_row_bool(df: DataFrame, col: str) -> bool:
    return bool(df.select(col).first()[0])


def ts_text(col: str = "ts"):
    """Row-level outputs carry time as text: identical in every engine and
    free of timestamp-precision differences between result converters."""
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss").alias(col)
