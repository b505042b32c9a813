"""Scoring job: rollouts (+ tasks) -> staged answer columns -> reward.

Plan shape: one narrow pass over the rollouts. The answer, found numbers and
F3 result are staged as columns once and shared by every reward rule and
metric (the reference parses each response twice). The only Python node is
F3's Arrow UDF; the task join is an equi-join that Catalyst plans as a
broadcast hash join when the tasks side is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked size) and as a
sort-merge join otherwise, with AQE splitting a hot ``task_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from ..functions.equation import with_equation_result
from ..functions.rewards import AnswerColumns, reward_column

STAGED = ["equation", "numbers_ok", "result", "distance", "has_think", "n_matched", "n_nums", "n_words"]


def attach_tasks(rollouts: DataFrame, tasks: DataFrame, keys=("task_id",), how: str = "inner", also=()) -> DataFrame:
    """Pair each response with its ground truth by key, not by position."""
    cols = list(keys) + [c for c in ("target", "nums") if c not in keys] + list(also)
    return rollouts.join(tasks.select(*cols), list(keys), how)


def attach_tasks_observed(rollouts: DataFrame, tasks: DataFrame, keys=("task_id",)) -> tuple[DataFrame, Observation]:
    """J1/J2 with its data quality counted in the same pass: the joined rows, and an observation with ``n_rollouts`` and
    ``n_unmatched`` that is filled by the first action on them (see :func:`require`). The count sits below the filter
    on matched rows, so no second scan is needed."""
    found = attach_tasks(rollouts, tasks.withColumn("__task", F.lit(True)).select(*keys, *[
        c for c in ("target", "nums") if c not in keys], "__task"), keys, "left", ("__task",))
    seen = Observation()
    counted = found.observe(seen, F.count(F.lit(1)).alias("n_rollouts"), F.count_if(F.col("__task").isNull()).alias("n_unmatched"))
    return counted.where(F.col("__task")).drop("__task"), seen


def require(*observed: Observation, **limits: int) -> dict[str, int]:
    """Raise when a counter, summed over the observations, exceeds its limit; returns all counters. Call it after the
    actions."""
    counts = dict.fromkeys(limits, 0)
    for seen in observed:
        for k, v in seen.get.items():
            counts[k] = counts.get(k, 0) + (v or 0)
    over = {k: counts[k] for k, most in limits.items() if counts[k] > most}
    if over:
        raise ValueError(f"data quality: {over} (limits {limits}), counters {counts}")
    return counts


def unmatched_rollouts(rollouts: DataFrame, tasks: DataFrame, keys=("task_id",)) -> DataFrame:
    """Rows a positional zip would have dropped silently (reported, not hidden)."""
    return rollouts.join(tasks.select(*keys), list(keys), "left_anti")


def stage_answers(
    df: DataFrame,
    text: str = "response",
    nums: str = "nums",
    target: str = "target",
    eval_strategy: str = "batch",
) -> DataFrame:
    """Add F1-F8 columns (see :data:`STAGED`).

    Columns nobody reads later (``n_words`` for most rules) are pruned by
    Catalyst, so staging everything costs nothing.
    """
    staged = df.withColumn("equation", X.extract_answer(F.col(text))).withColumn("__nums", N.task_numbers(nums))
    staged = staged.withColumn("__found", N.found_numbers(F.col("equation")))
    staged = with_equation_result(staged, "equation", "result", eval_strategy)
    return (
        staged.withColumn("numbers_ok", N.numbers_match(F.col("__found"), F.col("__nums")))
        .withColumn("n_matched", N.matched_count(F.col("__found"), F.col("__nums")).cast("bigint"))
        .withColumn("n_nums", F.size(F.col(nums)).cast("bigint"))
        .withColumn("distance", N.distance(F.col("result"), F.col(target)))
        .withColumn("has_think", X.has_think_tags(F.col(text)))
        .withColumn("n_words", X.word_count(F.col(text)).cast("bigint"))
        .drop("__found", "__nums")
    )


def score(
    df: DataFrame,
    reward: str = "hybrid",
    scale: float | None = None,
    text: str = "response",
    nums: str = "nums",
    target: str = "target",
    eval_strategy: str = "batch",
    keep_staged: bool = False,
) -> DataFrame:
    """Scored examples: input columns + ``equation``, ``result``, ``reward``."""
    staged = stage_answers(df, text, nums, target, eval_strategy)
    scored = staged.withColumn("reward", reward_column(reward, AnswerColumns.staged(), scale))
    if keep_staged:
        return scored
    return scored.drop(*[c for c in STAGED if c not in ("equation", "result")])


def score_all(
    df: DataFrame,
    rewards: dict[str, tuple[str, float | None]],
    text: str = "response",
    nums: str = "nums",
    target: str = "target",
    eval_strategy: str = "batch",
) -> DataFrame:
    """Several reward rules over one parse: ``{out_col: (rule, scale)}``."""
    staged = stage_answers(df, text, nums, target, eval_strategy)
    a = AnswerColumns.staged()
    return staged.select("*", *[reward_column(r, a, s).alias(name) for name, (r, s) in rewards.items()])


def is_correct(reward_col: str = "reward") -> "F.Column":
    """correct iff the reward equals 1.0 exactly."""
    return F.coalesce(F.col(reward_col) == F.lit(1.0), F.lit(False))
