"""Intermediate tables in the shared folder the cluster names.

Jobs here cut lineage by writing Parquet below ``spark.checkpoint.dir`` and
reading it back, so a lost executor never forces a long recomputation and no
task depends on another machine's local disk.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


class Workspace:
    """A fresh folder for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def address(self, name: str) -> str:
        """The folder as an address that pyarrow opens."""
        path = self.folder(name)
        return path if re.match(r"[a-z0-9]+:", path) else f"file://{os.path.abspath(path)}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return the stored table."""
        path = self.folder(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.folder(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_row(documents: DataFrame, *without: str) -> Column:
    """All columns as one struct ``__all``: whatever their names, they meet none that an operator adds. ``__all.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in documents.columns if c not in without]).alias("__all")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
