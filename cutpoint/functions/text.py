"""Report text helpers (F9, F10): numbers stay numeric in results; these
render them for people, on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_text(x: Column, places: int = 2) -> Column:
    """0.1234 -> '12.34%'."""
    return F.format_string(f"%.{int(places)}f%%", x * F.lit(100.0))


def fixed_text(x: Column, places: int = 4) -> Column:
    """0.2 -> '0.2000'."""
    return F.format_string(f"%.{int(places)}f", x)


def today_iso() -> Column:
    """Current date as yyyy-MM-dd (kept out of compared outputs)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")
