"""Stored tables laid out for their readers.

* The task store (P1, S1) is partitioned by ``split`` and ``n_nums``: a curriculum filter, or a join with a small table
  of wanted sizes, reads only the folders it needs.
* Co-located tables (W1, T10-T12) are bucketed by one key and sorted, with one file per bucket, so that joining them
  moves no row: token arrays stay where they were written.
* A large table can be written in waves: each reads the source again and shuffles only its own share, so that what a
  write keeps on disk besides the table does not grow with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

TASK_STORE = T.StructType([f for f in schemas.TASK if f.name != "split"] + [T.StructField("split", T.StringType()),
                                                                            T.StructField("n_nums", T.IntegerType())])


def write_task_store(tasks: DataFrame, path: str, files_per_folder: int = 1) -> None:
    """Tasks in folders ``split=.../n_nums=...``, each dealt by task over ``files_per_folder`` writers."""
    sized = tasks.select("task_id", "target", "nums", "split", F.size("nums").alias("n_nums"))
    part = F.pmod(F.xxhash64("task_id"), F.lit(files_per_folder))
    dealt = sized.withColumn("__part", part).repartition("split", "n_nums", "__part").drop("__part")
    dealt.write.mode("overwrite").partitionBy("split", "n_nums").parquet(path)


def read_task_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TASK_STORE).parquet(path)


def tasks_of_sizes(store: DataFrame, sizes: DataFrame) -> DataFrame:
    """P1 by table: tasks whose (split, n_nums) is in ``sizes``; the folders are pruned by its rows at run time."""
    return store.join(sizes.select("split", "n_nums").distinct(), ["split", "n_nums"], "left_semi")


def waves_of(rows: int, wave_rows: int) -> int:
    """How many waves of at most ``wave_rows`` rows, about, hold ``rows``."""
    return max(1, -(-rows // wave_rows))


def wave(df: DataFrame, number: Column, waves: int, i: int) -> DataFrame:
    """The rows of ``df`` whose ``number`` falls to wave ``i``."""
    return df if waves == 1 else df.where(F.pmod(number, F.lit(waves)) == i)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, sort: Sequence[str] | None = None,
                   waves: int = 1, then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Store ``df`` as the external table ``table`` at ``path``, bucketed by ``keys`` and sorted by ``sort`` (the keys, when
    not given); returns it. Each of the ``waves`` writes the buckets that are its own. ``then`` is applied to the rows
    once they are dealt by ``keys``: a window over them needs no shuffle of its own."""
    spark = df.sparkSession
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    for i in range(waves):
        rows = wave(df, bucket, waves, i).repartition(buckets, *keys)
        rows = then(rows) if then else rows
        (rows.write.mode("append" if i else "overwrite").format("parquet").option("path", path).option("compression", "zstd")
         .bucketBy(buckets, *keys).sortBy(*(sort or keys)).saveAsTable(table))
    return spark.table(table)


@contextmanager
def bucket_names(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """Table names for one job; the names are dropped afterwards, the files stay."""
    made = [f"{n}_{uuid.uuid4().hex}" for n in names]
    try:
        yield made
    finally:
        for n in made:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
