"""Readers for task and fine-tuning splits.

Schemas are always explicit (no inference pass over the data). JSON Lines
reading defaults to ``FAILFAST`` like the reference, which raises on a bad
line; ``PERMISSIVE`` keeps bad lines in ``_corrupt_record`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .quarantine import read_parquet_declared


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """JSON Lines with an explicit schema."""
    reader = spark.read.schema(schema).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
        reader = spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.json(path)


def read_tasks(spark: SparkSession, path: str, split: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Task table (parquet of the declared task schema, or JSONL of
    ``{target, nums}``); ``split`` filters (partition pruning when the data is
    partitioned by it)."""
    if fmt == "parquet":
        df = read_parquet_declared(spark, path, schemas.TASK)
    elif fmt == "json":
        df = read_jsonl(spark, path, schemas.TASK_JSON)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    if split is not None:
        if "split" not in df.columns:
            raise ValueError(f"{path} has no split column to select {split!r} from")
        df = df.where(F.col("split") == split)
    return df


def split_dataset(**splits: DataFrame) -> DataFrame:
    """One table from named splits, ``split`` column added."""
    if not splits:
        raise ValueError("no splits given")
    out = None
    for name, df in splits.items():
        part = df.withColumn("split", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_sft_splits(spark: SparkSession, train_path: str, validation_path: str) -> DataFrame:
    """Fine-tuning JSONL files as one table with ``split``."""
    return split_dataset(
        train=read_jsonl(spark, train_path, schemas.SFT_JSON),
        validation=read_jsonl(spark, validation_path, schemas.SFT_JSON),
    )
