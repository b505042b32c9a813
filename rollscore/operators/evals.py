"""Evaluation summaries (G1-G3, G6), example reports.

All summaries are one ``groupBy(...).agg(...)`` with partial aggregation, so
a hot (run, step) group is combined map-side before the shuffle; the shuffle
carries one small buffer per group and map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.decimals import fixed, shortest
from ..functions.prompts import py_list
from ..sources.sinks import text_metrics

BUCKET_TOL = 1e-8
BUCKET_RULES = ("exact", "remainder", "range")


def bucket_flags(reward: Column, rule: str = "exact", tol: float = BUCKET_TOL) -> tuple[Column, Column, Column]:
    """(correct, partial, failed) predicates for one reward.

    * ``exact``: 1 / 0.1 / 0 within ``tol``; other values in no bucket (G2a)
    * ``remainder``: correct 1, failed 0, partial the rest (G2b)
    * ``range``: correct 1, partial ``0 < r < 1 - tol``, failed ``r <= 0`` (G2c)
    """
    correct = F.abs(reward - F.lit(1.0)) < F.lit(tol)
    if rule == "exact":
        return correct, F.abs(reward - F.lit(0.1)) < F.lit(tol), F.abs(reward - F.lit(0.0)) < F.lit(tol)
    if rule == "remainder":
        failed = F.abs(reward - F.lit(0.0)) < F.lit(tol)
        return correct, ~correct & ~failed, failed
    if rule == "range":
        return correct, (reward > F.lit(0.0)) & (reward < F.lit(1.0 - tol)), reward <= F.lit(0.0)
    raise ValueError(f"unknown bucket rule {rule!r}; use one of {BUCKET_RULES}")


def _count_if(pred: Column) -> Column:
    return F.count_if(F.coalesce(pred, F.lit(False)))


def eval_summary(
    scored: DataFrame,
    keys: Sequence[str] = ("run_id", "step"),
    rule: str = "exact",
    reward: str = "reward",
    output_tokens: str = "output_tokens",
) -> DataFrame:
    """G1 + G2: mean, sample std (0 when n <= 1), count, buckets, accuracy %,
    average output tokens. With no keys, an empty input gives mean 0 and
    accuracy 0 like the reference."""
    r = F.col(reward)
    correct, partial, failed = bucket_flags(r, rule)
    n = F.count(F.lit(1))
    aggs = [
        F.coalesce(F.avg(r), F.lit(0.0)).alias("mean_reward"),
        F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("std_reward"),
        n.alias("num_examples"),
        _count_if(correct).alias("count_correct"),
        _count_if(partial).alias("count_partial"),
        _count_if(failed).alias("count_failed"),
        F.coalesce(F.try_divide(_count_if(correct).cast("double"), n.cast("double")) * F.lit(100.0), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.avg(F.col(output_tokens).cast("double")), F.lit(0.0)).alias("avg_output_tokens"),
    ]
    return scored.groupBy(*keys).agg(*aggs) if keys else scored.agg(*aggs)


def format_metrics(
    staged: DataFrame,
    keys: Sequence[str] = ("run_id", "step"),
    text: str = "response",
) -> DataFrame:
    """Tag and number counts with two percentages (divide by prompts;
    ``try_divide`` instead of the reference's division error on empty input)."""
    t = F.col(text)
    has_answer = X.has_answer_tags(t)
    both = has_answer & X.has_think_tags(t)
    numbers = F.col("equation").isNotNull() & (F.col("equation") != "") & F.col("numbers_ok")
    n = F.count(F.lit(1)).cast("double")
    aggs = [
        F.count(F.lit(1)).alias("num_examples"),
        _count_if(has_answer).alias("count_has_answer"),
        _count_if(both).alias("count_has_both_tags"),
        _count_if(numbers).alias("count_correct_numbers"),
        F.try_divide(F.lit(100.0) * _count_if(both).cast("double"), n).alias("format_accuracy"),
        F.try_divide(F.lit(100.0) * _count_if(numbers).cast("double"), n).alias("number_accuracy"),
    ]
    return staged.groupBy(*keys).agg(*aggs) if keys else staged.agg(*aggs)


def zero_shot_accuracy(scored: DataFrame, keys: Sequence[str] = ("model", "max_tokens")) -> DataFrame:
    """G6 + F9: correct = reward exactly 1.0, accuracy in percent."""
    correct = _count_if(F.col("reward") == F.lit(1.0))
    n = F.count(F.lit(1))
    return scored.groupBy(*keys).agg(
        correct.alias("correct"),
        n.alias("total"),
        (correct.cast("double") / n.cast("double") * F.lit(100.0)).alias("accuracy"),
    )


def example_bucket(reward: Column, rule: str = "exact", tol: float = BUCKET_TOL) -> Column:
    """Bucket name used to pick report examples ("correct"/"partial"/"failed").

    ``log_eval`` keeps the exact 0.1 rule even where counts use the
    remainder rule; pass ``rule`` accordingly."""
    correct, partial, failed = bucket_flags(reward, rule, tol)
    return F.when(correct, "correct").when(partial, "partial").when(failed, "failed")


def top_examples(
    scored: DataFrame,
    keys: Sequence[str] = ("run_id", "step"),
    order: Sequence[str] = ("task_id", "slot"),
    n: int = 10,
    rule: str = "exact",
) -> DataFrame:
    """First ``n`` examples per bucket in input order.

    ``row_number() <= n`` is planned as a WindowGroupLimit: each map task
    keeps at most ``n`` rows per group before the shuffle, so a hot bucket
    never moves more than ``n`` rows per task.
    """
    b = example_bucket(F.col("reward"), rule)
    w = Window.partitionBy(*keys, "bucket").orderBy(*order)
    ranked = scored.withColumn("bucket", b).withColumn("rank", F.row_number().over(w))
    # The NULL-bucket test mentions ``rank`` so it stays above the window: a
    # filter on ``bucket`` alone would be pushed under the projection and
    # evaluate the scoring UDF a second time.
    keep = F.col("bucket").isNotNull() | (F.col("rank") < 0)
    return ranked.where((F.col("rank") <= n) & keep)


def example_text(scored: DataFrame, target: str = "target", nums: str = "nums") -> DataFrame:
    """report text of one example, numbers printed as Python prints them
    (the result as ``repr``, the reward with 3 correctly rounded decimals)."""
    c = F.col
    prompt = c("prompt") if "prompt" in scored.columns else F.lit("")
    target_txt = F.when(c(target).isNull(), F.lit("?")).otherwise(c(target).cast("string"))
    numbers = F.when(c(nums).isNull(), F.lit("None")).otherwise(py_list(nums))
    # The labels of the report.
    text = F.concat(
        F.lit("Prompt: "), F.coalesce(prompt, F.lit("")), F.lit("\n"),
        F.lit("Response: "), F.coalesce(c("response"), F.lit("")), F.lit("\n"),
        F.lit("Equation: "), F.coalesce(c("equation"), F.lit("None")), F.lit(" | Result: "),
        F.coalesce(shortest("result"), F.lit("None")),
        F.lit(" | Target: "), target_txt, F.lit(" | Numbers: "), numbers, F.lit("\n"),
        F.lit("Reward: "), fixed(F.coalesce(c("reward"), F.lit(0.0)), 3), F.lit("\n"),
    )
    return scored.withColumn("example_text", text)


def examples_report(top: DataFrame, keys: Sequence[str] = ("run_id", "step")) -> DataFrame:
    """S7 text per bucket: the chosen examples joined by a blank line, in order."""
    texts = example_text(top)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "example_text")))
    return texts.groupBy(*keys, "bucket").agg(
        F.array_join(F.transform(ordered, lambda s: s["example_text"]), "\n\n").alias("text")
    )


def examples_long(top: DataFrame, keys: Sequence[str] = ("run_id", "step")) -> DataFrame:
    """The reports as rows of the metrics table, tags ``eval/examples_correct``, ``_partial`` and ``_failed``."""
    return text_metrics(examples_report(top, keys), F.concat(F.lit("eval/examples_"), F.col("bucket")), "text", keys)


__all__ = [
    "bucket_flags", "eval_summary", "format_metrics", "zero_shot_accuracy", "top_examples",
    "example_text", "examples_report", "examples_long",
]
