"""Column contract.

The reference checks presence only. Presence is schema metadata, so it costs
no job; the data-level extension (null and NaN counts per column) is one
aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Sorted required names absent from the schema (set difference, U3)."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"the contract asks for columns that the table lacks: {missing}")


def feature_columns(columns: Iterable[str], leakage: Iterable[str] = ("label",)) -> list[str]:
    """Drop leakage columns, sort by name."""
    drop = set(leakage)
    return sorted(c for c in columns if c not in drop)


def resolve_feature_columns(df: DataFrame, bundle_cols: list[str] | None,
                            leakage: Iterable[str] = ("label",)) -> list[str]:
    """The bundle's order wins; error on any missing input column."""
    if bundle_cols:
        require_columns(df, bundle_cols)
        return list(bundle_cols)
    return feature_columns(df.columns, leakage)


def column_profile(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """P1 over data: one row per required column with presence, null and NaN
    counts. Missing columns come from a left-anti join of the required names
    against the schema names (J5); present ones from a single aggregate."""
    spark = df.sparkSession
    required = list(dict.fromkeys(required))
    present = [c for c in required if c in df.columns]
    types = dict(df.dtypes)
    aggs = []
    for c in present:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n__{c}"))
        if types[c] in ("double", "float"):
            aggs.append(F.count_if(F.isnan(F.col(c))).alias(f"x__{c}"))
    names = T.StructType([T.StructField("column_name", T.StringType(), False)])
    req_df = spark.createDataFrame([(c,) for c in required], names)
    have_df = spark.createDataFrame([(c,) for c in df.columns], names)
    missing = (req_df.join(have_df, "column_name", "left_anti")
               .select("column_name", F.lit(False).alias("present"),
                       F.lit(None).cast("bigint").alias("null_count"),
                       F.lit(None).cast("bigint").alias("nan_count")))
    if not present:
        return missing
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{c}', `n__{c}`, " + (f"`x__{c}`" if f"x__{c}" in wide.columns else "CAST(0 AS BIGINT)")
        for c in present)
    long = wide.selectExpr(
        f"stack({len(present)}, {stack_args}) AS (column_name, null_count, nan_count)")
    return (long.select("column_name", F.lit(True).alias("present"), "null_count", "nan_count")
            .unionByName(missing))


def bad_score_counts(df: DataFrame, by: Sequence[str] = (), score_col: str = "score") -> DataFrame:
    """Trap 2: per group the rows, and those whose score is null or NaN and so falls in
    no band. The score operators fail on them; this reports them."""
    s = F.col(score_col).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(s.isNull()).alias("null_scores"),
                               F.count_if(F.isnan(s)).alias("nan_scores"))


def assert_no_bad_scores(df: DataFrame, score_col: str = "score") -> None:
    """Trap 2 as a check up front."""
    r = bad_score_counts(df, score_col=score_col).first()
    if r["null_scores"] + r["nan_scores"]:
        raise ContractError(f"{r['null_scores']} null and {r['nan_scores']} NaN values in `{score_col}`")
