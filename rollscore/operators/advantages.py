"""Group-normalised advantages (W1, W2) and reward metadata.

One group = the G samples of one prompt in one step of one run, identified
by keys instead of list positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .groupstats import with_group_stats, with_window_stats

GROUP_KEYS = ("run_id", "step", "task_id")
STEP_KEYS = ("run_id", "step")


def normalizes_by_std(loss_type: str) -> bool:
    """Which advantages a loss is fed: divided by the group's deviation for ``grpo``, only centred for ``dr_grpo``."""
    if loss_type not in ("grpo", "dr_grpo"):
        raise ValueError(f"unknown loss type {loss_type!r}")
    return loss_type == "grpo"


def group_advantages(
    scored: DataFrame,
    normalize_by_std: bool = True,
    eps: float = 1e-6,
    group_keys: Sequence[str] = GROUP_KEYS,
    reward: str = "reward",
    stabilized: bool = False,
    clamp: float = 10.0,
    strategy: str = "window",
) -> DataFrame:
    """Adds ``group_mean``, ``group_std`` (population) and ``advantage``.

    * W1: ``(r - mean) / (std + eps)``, or ``r - mean`` without std (DR-GRPO)
    * W2 (``stabilized``): ``(r - mean) / max(std, eps)`` clamped to
      ``[-clamp, clamp]``; the clamp applies only when normalising.

    ``strategy="window"`` (default): one exchange on the group key and one
    pass. A group is the G samples of one prompt in one step, so it never
    holds more than G rows (``ragged_groups`` checks this); no key can
    concentrate a large share of the rows. ``"aggregate"`` pre-aggregates
    and joins the statistics back, for keys whose groups are unbounded; it
    reads its input twice, so materialise the input first.
    """
    r = F.col(reward)
    aggs = {"group_mean": F.avg(r), "group_std": F.stddev_pop(r), "group_n": F.count(F.lit(1))}
    if strategy not in ("aggregate", "window"):
        raise ValueError(f"unknown strategy {strategy!r}")
    attach = with_group_stats if strategy == "aggregate" else with_window_stats
    df = attach(scored, group_keys, aggs)
    centered = r - F.col("group_mean")
    if not normalize_by_std:
        adv = centered
    elif stabilized:
        scaled = centered / F.greatest(F.col("group_std"), F.lit(eps))
        adv = F.least(F.greatest(scaled, F.lit(-clamp)), F.lit(clamp))
    else:
        adv = centered / (F.col("group_std") + F.lit(eps))
    return df.withColumn("advantage", adv)


def observe_groups(advantages: DataFrame, group_size: int, size: str = "group_n") -> tuple[DataFrame, Observation]:
    """W1's groups counted in the same pass: an observation with ``n_rows`` and ``n_ragged`` (rows of groups whose size is
    not G), filled by the first action on the returned rows."""
    seen = Observation()
    return advantages.observe(seen, F.count(F.lit(1)).alias("n_rows"),
                              F.count_if(F.col(size) != group_size).alias("n_ragged")), seen


def ragged_groups(scored: DataFrame, group_size: int, group_keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """Groups whose size is not G (the reference's reshape would fail)."""
    return scored.groupBy(*group_keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != group_size)


def reward_metadata(scored: DataFrame, keys: Sequence[str] = STEP_KEYS, reward: str = "reward") -> DataFrame:
    """Mean, population std, max, min of raw rewards per step."""
    r = F.col(reward)
    return scored.groupBy(*keys).agg(
        F.avg(r).alias("reward_mean"), F.stddev_pop(r).alias("reward_std"),
        F.max(r).alias("reward_max"), F.min(r).alias("reward_min"),
    )


def zero_std_groups(
    scored: DataFrame,
    eps: float = 1e-4,
    keys: Sequence[str] = STEP_KEYS,
    group_keys: Sequence[str] = GROUP_KEYS,
    reward: str = "reward",
) -> DataFrame:
    """Per step, how many groups have population std below ``eps``.

    Two partial aggregations; nothing is windowed."""
    per_group = scored.groupBy(*group_keys).agg(F.stddev_pop(F.col(reward)).alias("group_std"))
    return per_group.groupBy(*keys).agg(
        F.count_if(F.col("group_std") < F.lit(eps)).alias("zero_std_groups"),
        F.count(F.lit(1)).alias("num_groups"),
    )
