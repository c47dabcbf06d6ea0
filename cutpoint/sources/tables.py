"""Table scans and the ``txn`` transaction view.

``txn`` stands in for a card-transaction table: one row per line item, a
0/1 ``label`` and a model ``score`` that both depend on the row's features.
The same definition exists as SQL in ``cutpoint.plans.oracle`` so DuckDB
can check every query against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Columns of txn that, appended after the time column, give a total order
# (the four key columns alone repeat a handful of times).
TXN_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
TXN_TIEBREAK = TXN_KEY + ("amount", "l_quantity", "l_discount", "l_tax",
                          "l_returnflag", "l_linestatus")
# Model inputs, sorted by name as the reference's feature_columns() does.
TXN_FEATURES = ("amount", "l_discount", "l_quantity", "l_tax")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan of one driver table; filters and projections push down."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass)."""
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "FAILFAST").csv(path))


def tie_hash(orderkey: Column, linenumber: Column) -> Column:
    """Integer spread key for time ties; plain integer arithmetic so every
    engine computes the same value and no product can overflow."""
    return ((orderkey % 1000003) * 7919 + linenumber * 104729) % 1000003


def txn_from_lineitem(lineitem: DataFrame) -> DataFrame:
    d, q, tax, price = (F.col("l_discount"), F.col("l_quantity"), F.col("l_tax"),
                        F.col("l_extendedprice"))
    bump = F.when((d >= 0.08) & (q >= 40), F.lit(200)).otherwise(F.lit(0))
    label = F.when(((F.col("l_partkey") * 7 + F.col("l_suppkey") * 13) % 1000) < (F.lit(2) + bump),
                   1).otherwise(0).cast("int")
    z = F.lit(-7.5) + F.lit(45.0) * d + F.lit(0.08) * q + F.lit(4.0) * tax + price / F.lit(100000.0)
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").alias("ts"), price.alias("amount"), "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        label.alias("label"), score.alias("score"),
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def typed_load(df: DataFrame, label_col: str = "label",
               feature_cols: tuple[str, ...] = TXN_FEATURES) -> DataFrame:
    """Features as double, label as tinyint; the contract is checked first."""
    from cutpoint.sources.contract import require_columns
    require_columns(df, [*feature_cols, label_col])
    keep = [c for c in df.columns if c not in (*feature_cols, label_col)]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in feature_cols],
                     F.col(label_col).cast("tinyint").alias(label_col))
