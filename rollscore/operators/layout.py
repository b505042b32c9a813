"""Input layout helpers.

A small source file becomes one read partition; when a job then multiplies
the rows (G samples per prompt, token arrays per sample), the whole job runs
as one task. ``spread`` hash-partitions such an input by a key, and only
when it has fewer partitions than the cluster can run at once: on a real
multi-file table it is a no-op and adds no shuffle.

Spread by a unique key (or one whose groups are bounded) so the spreading
itself cannot concentrate a hot key in one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, keys: Sequence[str], min_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    try:
        # Two tasks per core the cluster offers: enough to keep every core busy
        # and to even out stragglers, independent of the shuffle setting.
        target = min_partitions or 2 * spark.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 -- no RDD access (e.g. Spark Connect): leave as is
        return df
    if current >= target:
        return df
    return df.repartition(target, *keys)


def join_small(rows: DataFrame, small: DataFrame, keys: Sequence[str], by: str, how: str = "inner", copies: int = 16) -> DataFrame:
    """Join ``rows`` with a table of one narrow row per key. A key that holds a large share of ``rows`` is dealt by
    the values of column ``by`` over ``copies`` groups, for which the small row is repeated; nothing is broadcast by
    hint."""
    part = F.pmod(F.xxhash64(by), F.lit(copies)).cast("int")
    repeated = small.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return rows.withColumn("__copy", part).join(repeated, [*keys, "__copy"], how).drop("__copy")
