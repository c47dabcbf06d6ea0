"""Score bands and threshold rules as Column expressions.

All comparisons are on doubles (trap 3): callers cast scores and thresholds
to double before banding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

APPROVE, REVIEW, DECLINE = "approve", "review", "decline"

# Fixed values that must equal the reference's for identical decisions.
ARTIFACT_DECLINE_FALLBACK = 0.45   # decline threshold when a bundle has none
ARTIFACT_APPROVE_CAP = 0.11        # approve = min(0.11, decline * 0.5)
DEFAULT_PROFILE = "phase2_guarded"


class ThresholdError(ValueError):
    pass


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def decision(score, t1, t2) -> Column:
    """Score < T1 approve, T1 <= score < T2 review, score >= T2 decline."""
    s = _c(score) if not isinstance(score, str) else F.col(score)
    return (F.when(s < _c(t1), F.lit(APPROVE))
            .when(s < _c(t2), F.lit(REVIEW))
            .otherwise(F.lit(DECLINE)))


def is_bad(score: Column) -> Column:
    """A score that belongs to no band (trap 2): null or NaN."""
    return score.isNull() | F.isnan(score)


def guarded(value: Column, n_bad: Column) -> Column:
    """``value``, unless bad scores were counted in the same pass: then reading it
    fails and names their number. Every score operator ends in this guard."""
    return F.when(F.coalesce(n_bad, F.lit(0)) > 0, F.raise_error(
        F.concat(n_bad.cast("string"), F.lit(" rows have a null or NaN score")))).otherwise(value)


def predicted_class(score, threshold) -> Column:
    """P5: 1 when score >= threshold (the decline threshold), else 0."""
    s = _c(score) if not isinstance(score, str) else F.col(score)
    return (s >= _c(threshold)).cast("int")


def thresholds_valid(t1, t2) -> Column:
    """0 <= t1 < t2 <= 1 as a boolean column."""
    a, b = _c(t1), _c(t2)
    return (a >= 0.0) & (a < b) & (b <= 1.0)


def check_thresholds(t1: float, t2: float) -> None:
    """P7 for driver-side parameters."""
    if not (0.0 <= float(t1) < float(t2) <= 1.0):
        raise ThresholdError(f"need 0 <= approve_threshold < decline_threshold <= 1, got {t1} and {t2}")


def artifact_thresholds(bundle_threshold) -> tuple[Column, Column]:
    """P14 ``artifact`` profile: T2 from the bundle (else 0.45), T1 = min(0.11, T2/2)."""
    t2 = F.coalesce(_c(bundle_threshold) if bundle_threshold is not None else F.lit(None).cast("double"),
                    F.lit(ARTIFACT_DECLINE_FALLBACK))
    t1 = F.least(F.lit(ARTIFACT_APPROVE_CAP), t2 * F.lit(0.5))
    return t1, t2


def with_override(profile_t: Column, override) -> Column:
    """An explicit override wins per side."""
    if override is None:
        return profile_t
    return F.coalesce(_c(override), profile_t)
