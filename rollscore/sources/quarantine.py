"""Read JSON Lines whole, with bad lines in a side table.

One scan parses every line with the declared schema and writes two tables, the rows that fit and the lines that do not,
with their file and a reason. Nothing is inferred and nothing is dropped: good and bad rows are all lines but blank ones
(which the JSON reader skips).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
REASONS = ("malformed", "type", "missing")  # no JSON object; a value of another type; a required field without a value


def split_jsonl(spark: SparkSession, path: str, schema: T.StructType, out: str, required: Sequence[str] | None = None) -> None:
    """Scan ``path`` once and write ``out`` (partitioned by ``good``); the same call again replaces it.

    ``required`` fields (all by default) must have a value; an array must not hold nulls where its type forbids them."""
    required = [f.name for f in schema] if required is None else list(required)
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    line = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[f.name for f in schema])))
    is_object = F.trim(F.col(CORRUPT)).startswith("{") & F.get_json_object(CORRUPT, "$").isNotNull()
    absent = F.lit(False)
    for name in required:
        absent = absent | F.col(name).isNull()
    reason = (F.when(F.col(CORRUPT).isNotNull() & ~F.coalesce(is_object, F.lit(False)), REASONS[0])
              .when(F.col(CORRUPT).isNotNull(), REASONS[1]).when(absent, REASONS[2]))
    judged = rows.select(*[f.name for f in schema], reason.alias("reason"), F.col("_metadata.file_path").alias("file"),
                         F.when(reason.isNotNull(), line).alias("line"))
    judged.withColumn("good", F.col("reason").isNull()).write.mode("overwrite").partitionBy("good").parquet(out)


def _part(spark: SparkSession, schema: T.StructType, out: str, good: bool) -> DataFrame:
    extra = [T.StructField(c, T.StringType()) for c in ("reason", "file", "line")] + [T.StructField("good", T.BooleanType())]
    return spark.read.schema(T.StructType(schema.fields + extra)).parquet(out).where(F.col("good") == good)


def good_rows(spark: SparkSession, schema: T.StructType, out: str) -> DataFrame:
    return _part(spark, schema, out, True).select(*[f.name for f in schema])


def bad_lines(spark: SparkSession, schema: T.StructType, out: str) -> DataFrame:
    """(file, reason, line)"""
    return _part(spark, schema, out, False).select("file", "reason", "line")


def read_parquet_declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet by a declared schema: a missing column, or one of another type than declared, raises before any row is
    read (Spark itself would fill the first with NULL and fail on the second only in a task)."""
    stored = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    wrong = [f.name for f in schema if f.name not in stored or _plain(stored[f.name]) != _plain(f.dataType)]
    if wrong:
        raise ValueError(f"{path} does not have the declared columns {wrong}")
    return spark.read.schema(schema).parquet(path)


def _plain(kind: T.DataType) -> str:
    """The type without nullability."""
    return kind.simpleString()
