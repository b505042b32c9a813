"""Per-group statistics attached back to rows, safe for hot groups.

``Window.partitionBy(key)`` sends every row of a group to one task and
buffers it there, which is unbounded when one key holds a large share of
the rows. Here the statistics are computed with a partial aggregation
(combined map-side, so a hot key costs one buffer per map task) and joined
back on the key. The join is planned by Catalyst: broadcast when the
statistics are small (few groups, a checked size), otherwise a sort-merge
join whose hot partitions AQE splits (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window


def with_group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """``df`` + aggregate columns ``{name: agg}`` per ``keys`` (aggregate + join)."""
    stats = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return df.join(stats, list(keys), "inner")


def with_window_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Same result with one window (one exchange, no join). Only for groups
    whose size is known to be bounded, e.g. validated groups of G samples."""
    w = Window.partitionBy(*keys)
    return df.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])
