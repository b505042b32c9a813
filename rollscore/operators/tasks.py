"""Task-level operators: curriculum filter, projection, per-step prompt
sampling, group expansion, rollout flattening, micro-batch ids, eval-step
filter, previews and split statistics (P1, P2, P9-P15, G8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sampling


def filter_by_size(tasks: DataFrame, k: int = 3, nums: str = "nums", n_nums: str | None = "n_nums") -> DataFrame:
    """Keep tasks with exactly ``k`` numbers.

    ``size(nums)`` cannot reach the Parquet reader; a stored ``n_nums``
    column (or a table partitioned by it) can, so it is used when present."""
    if n_nums and n_nums in tasks.columns:
        return tasks.where(F.col(n_nums) == k)
    return tasks.where(F.size(F.col(nums)) == k)


def project_tasks(tasks: DataFrame) -> DataFrame:
    """``{target, nums}``."""
    return tasks.select("target", "nums")


def _sample_key(seed: int, step: Column, task_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), step.cast("string"), task_id.cast("string")))


def sample_step(tasks: DataFrame, step: int, k: int, seed: int = 42, key: str = "task_id") -> DataFrame:
    """P9 for one step: ``k`` tasks without replacement, reproducible from
    (seed, step). Planned as a top-k (TakeOrderedAndProject): each partition
    keeps k rows, the driver merges at most k x partitions."""
    order = _sample_key(seed, F.lit(step), F.col(key))
    return (
        tasks.withColumn("__k", order)
        .orderBy("__k", key)
        .limit(k)
        .drop("__k")
        .withColumn("step", F.lit(step).cast("bigint"))
    )


def sample_steps(
    tasks: DataFrame, n_steps: int, k: int, seed: int = 42, key: str = "task_id", first_step: int = 1
) -> DataFrame:
    """P9 for many steps at once: an independent sample of ``k`` tasks per
    step, with ``prompt_ord`` = position in the sample (see
    :mod:`.sampling`). Fewer than k tasks raise, as ``random.sample`` does."""
    steps = tasks.sparkSession.range(first_step, first_step + n_steps).withColumnRenamed("id", "step")
    return sampling.sample_steps(tasks, steps, k, seed, key)


def check_population(tasks: DataFrame, k: int) -> None:
    """Raise like ``random.sample`` when there are fewer than ``k`` tasks (an action)."""
    _check_size(tasks.count(), k)


def _check_size(n: int, k: int) -> None:
    if k > n:
        raise ValueError(f"Sample larger than population or is negative: k={k}, n={n}")


def expand_groups(df: DataFrame, group_size: int, slot: str = "slot") -> DataFrame:
    """P10: G adjacent copies of each row, ``slot`` = 0..G-1."""
    seq = F.sequence(F.lit(0).cast("bigint"), F.lit(group_size - 1).cast("bigint"))
    return df.select("*", F.explode(seq).alias(slot))


def flatten_outputs(df: DataFrame, outputs: str = "outputs", text_field: str = "text") -> DataFrame:
    """One row per generated output; empty lists produce no rows."""
    base = [c for c in df.columns if c != outputs]
    return df.select(*base, F.posexplode(F.col(outputs)).alias("output_ord", "__out")).select(
        *base, F.col("output_ord").cast("bigint").alias("output_ord"), F.col(f"__out.{text_field}").alias("response")
    )


def token_bounds(df: DataFrame, at_least: int | None = None, at_most: int | None = None, tokens: str = "output_tokens") -> DataFrame:
    """Rows whose token count lies within the bounds, both included; a missing
    bound does not limit, a null count passes only without bounds.

    Plain comparisons, so they reach the Parquet reader."""
    if at_least is not None and at_most is not None and at_least > at_most:
        raise ValueError(f"at_least ({at_least}) is above at_most ({at_most})")
    if at_least is not None:
        df = df.where(F.col(tokens) >= at_least)
    if at_most is not None:
        df = df.where(F.col(tokens) <= at_most)
    return df


def micro_batch_id(prompt_ord, slot, group_size: int, micro_size: int) -> Column:
    """Contiguous micro-batches of ``micro_size`` rows within a step."""
    po = F.col(prompt_ord) if isinstance(prompt_ord, str) else prompt_ord
    s = F.col(slot) if isinstance(slot, str) else slot
    return F.floor((po * F.lit(group_size) + s) / F.lit(micro_size)).cast("bigint")


def micro_size(rollout_batch_size: int, gradient_accumulation_steps: int) -> int:
    return rollout_batch_size // gradient_accumulation_steps


def eval_steps(df: DataFrame, every: int, step: str = "step") -> DataFrame:
    """Rows of evaluation steps (multiples of ``every``, step 0 included)."""
    return df.where((F.col(step) % every == 0) | (F.col(step) == 0))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ("task_id",)) -> DataFrame:
    """First ``n`` rows in key order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def text_preview(text, n: int = 200) -> Column:
    """First ``n`` characters."""
    return F.substring(F.col(text) if isinstance(text, str) else text, 1, n)


def split_stats(tasks: DataFrame, k: int = 3, split: str = "split", nums: str = "nums") -> DataFrame:
    """Per split, size, kept size for ``k`` numbers and kept percentage."""
    kept = F.count_if(F.size(F.col(nums)) == k)
    n = F.count(F.lit(1))
    return tasks.groupBy(split).agg(
        n.alias("total"), kept.alias("kept"), (kept.cast("double") / n.cast("double") * F.lit(100.0)).alias("kept_pct")
    )
