"""Replay a table as a file stream with a known order of arrival.

One Spark write makes the files; they then get modification times in the
order of the batches, which is the order in which the file source takes them.
Only file names reach the driver. :func:`land_batches` makes a file per batch,
for tables whose batches are few; :func:`land_partitions` makes a file per
partition, whatever number of steps a partition holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "arrival_folder"
_SECOND = 1000


def land_batches(df: DataFrame, path: str, batch: Column) -> None:
    """Write ``df`` below ``path``, one file per value of the integer ``batch``, arriving in ascending order."""
    df.withColumn(FOLDER, batch.cast("bigint")).repartition(FOLDER).write.mode("overwrite").partitionBy(FOLDER).parquet(path)
    _arrive_in_order(df.sparkSession, path, rf"{FOLDER}=(-?\d+)/[^/]*\.parquet$")


def land_partitions(df: DataFrame, path: str) -> None:
    """Write ``df`` below ``path``, one file per partition that has rows, arriving in the order of the partitions.

    After ``repartitionByRange(n, key)`` the files arrive in ascending order of the key, each value of it whole in one
    file. Their number is that of the partitions, so a replay takes as many batches for many steps as for a few."""
    df.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(path)
    _arrive_in_order(df.sparkSession, path, r"/part-(\d+)-[^/]*\.parquet$")


def _arrive_in_order(spark: SparkSession, path: str, number: str) -> None:
    """Give the files below ``path`` modification times in the order of the number that the pattern finds in their names."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files, listing = [], fs.listFiles(root, True)
    while listing.hasNext():
        entry = listing.next()
        found = re.search(number, entry.getPath().toString())
        if found:
            files.append((int(found.group(1)), entry.getPath().toString(), entry.getPath(), entry.getModificationTime()))
    files.sort(key=lambda f: f[:2])
    newest = max((f[3] for f in files), default=0)
    for place, (_, _, name, _) in enumerate(files):
        fs.setTimes(name, newest - (len(files) - 1 - place) * _SECOND, -1)


def with_closing_row(df: DataFrame, event_time: str, batch: str, after: str) -> DataFrame:
    """``df`` and one more row, a batch after the last one: every column NULL but ``batch`` and an event time ``after``
    (an interval such as ``'2 days'``) beyond the newest. It moves the watermark past all windows, so that a finite
    replay ends with every window emitted. The caller drops the row's own key (NULL)."""
    last = df.agg(F.max(batch).alias("b"), F.max(event_time).alias("t")).where("b IS NOT NULL")
    kind = dict(df.dtypes)
    values = {batch: (F.col("b") + 1).cast(kind[batch]), event_time: (F.col("t") + F.expr(f"INTERVAL {after}")).cast(kind[event_time])}
    closing = last.select(*[values.get(c, F.lit(None).cast(kind[c])).alias(c) for c in df.columns])
    return df.unionByName(closing)


def landed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything that arrived below ``path``, as a batch table."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
