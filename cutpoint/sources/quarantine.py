"""Typed CSV loads that set bad rows aside.

``read_csv_typed`` stops at the first bad row. A load of many files should not: here every row is
parsed once, rows that break the schema or the typed contract get a reason, and good and
bad rows are written side by side by that one pass, as two partitions of one Parquet table.
Bad rows keep their raw text and file, so they can be mended and loaded again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cutpoint.sources.contract import ContractError

RAW, FILE, REASON = "_raw", "_file", "_reason"
#: A row that does not parse, and the contract's rules in the order they are tried.
MALFORMED = "malformed"


@dataclass(frozen=True)
class Load:
    """A finished load: the table of both parts."""
    path: str
    schema: T.StructType

    def good(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).where(F.col("ok")).select(*self.schema.names)

    def bad(self, spark: SparkSession) -> DataFrame:
        """``_reason, _raw, _file`` of the rows set aside."""
        return self._rows(spark).where(~F.col("ok")).select(REASON, RAW, FILE)

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows by reason; ``loaded`` for the good ones."""
        return self._rows(spark).groupBy(F.coalesce(REASON, F.lit("loaded")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))

    def _rows(self, spark: SparkSession) -> DataFrame:
        extra = [T.StructField(RAW, T.StringType()), T.StructField(FILE, T.StringType()), T.StructField(REASON, T.StringType())]
        # The partition column's type is given, so an empty part is no matter of inference.
        schema = T.StructType([*self.schema.fields, *extra, T.StructField("ok", T.BooleanType())])
        return spark.read.schema(schema).parquet(self.path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str, out: str,
             rules: dict[str, Column] | None = None, header: bool = True) -> Load:
    """Parse all files below ``path`` once and write good and bad rows to ``out``. ``rules`` maps a
    reason to what must hold; a rule that is null counts as broken. A row has the first reason
    that applies."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    clash = {RAW, FILE, REASON, "ok"} & set(schema.names)
    if clash:
        raise ContractError(f"column names kept for the load: {sorted(clash)}")
    parsed = (spark.read.schema(T.StructType([*schema.fields, T.StructField(RAW, T.StringType())]))
              .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).csv(path))
    reason = F.when(F.col(RAW).isNotNull(), F.lit(MALFORMED))
    for name, holds in (rules or {}).items():
        reason = reason.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
    rows = parsed.select("*", F.input_file_name().alias(FILE), reason.alias(REASON))
    # A row that parses but breaks a rule has no raw text of its own: it is written out again.
    text = F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(RAW), F.to_csv(F.struct(*schema.names))))
    file = F.when(F.col(REASON).isNotNull(), F.col(FILE))
    rows = rows.withColumns({RAW: text, FILE: file, "ok": F.col(REASON).isNull()})
    rows.write.partitionBy("ok").parquet(out)
    return Load(out, schema)
