"""Derived tables for the registered queries (FIXTURES.md section 4).

The driver's tables hold no puzzles or rollouts, so tasks, rollouts,
fine-tuning rows, log-prob/token arrays and a metric history are derived from
them with integer arithmetic. DuckDB derives the same rows in
:mod:`rollscore.plans.oracle`; only Spark parses the text afterwards.

Every derivation is narrow (projection / generator) over the whole source
table, so its cost grows with the input and it never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import spread

GROUP_SIZE = 8
PROMPTS_PER_STEP = 16
N_RUNS = 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A driver table, hash-spread by ``key`` when it reads as too few partitions."""
    return spread(read_table(spark, sf_dir, name), [key])


def _s(c: Column) -> Column:
    return c.cast("string")


def task_parts(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """Tasks with the helper columns the fixtures are built from; ``ranges`` lays them out in so many partitions of
    ascending ``task_id`` (and so of ascending ``step``)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    o = o.repartitionByRange(ranges, "o_orderkey") if ranges else spread(o, ["o_orderkey"])
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    df = o.select(
        k.alias("task_id"),
        F.when(k % 10 == 3, "test").otherwise("train").alias("split"),
        ((k * 7) % 99 + 1).cast("int").alias("n1"),
        ((c * 13) % 99 + 1).cast("int").alias("n2"),
        ((k + c) % 99 + 1).cast("int").alias("n3"),
        (k % 97 + 1).cast("int").alias("n4"),
        F.when(k % 2 == 0, 3).otherwise(4).cast("int").alias("n_nums"),
    )
    four = F.col("n_nums") == 4
    t4 = F.when(four, F.col("n4")).otherwise(0)
    base = F.col("n1") + F.col("n2") - F.col("n3") + t4
    miss = (
        F.when(F.expr("(task_id div 2) % 5") <= 1, 0)
        .when(F.expr("(task_id div 2) % 5") == 2, 1)
        .when(F.expr("(task_id div 2) % 5") == 3, 4)
        .otherwise(60)
    )
    return df.select(
        "*",
        F.when(four, F.array("n1", "n2", "n3", "n4")).otherwise(F.array("n1", "n2", "n3")).alias("nums"),
        t4.alias("t4"),
        F.when(four, F.concat(F.lit(" + "), _s(F.col("n4")))).otherwise(F.lit("")).alias("tail"),
        base.alias("base"),
        (base + miss).cast("int").alias("target"),
        (F.col("task_id") % N_RUNS).alias("run_id"),
        (F.expr("task_id div 48") + 1).cast("bigint").alias("step"),
        F.expr("(task_id % 48) div 3").cast("bigint").alias("prompt_ord"),
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tasks(task_id, split, target, nums, n_nums)``."""
    return task_parts(spark, sf_dir).select("task_id", "split", "target", "nums", F.col("n_nums").cast("bigint"))


def _response(kind: Column, e: Column) -> Column:
    n1, n2, n3, tail, base = (_s(F.col("n1")), _s(F.col("n2")), _s(F.col("n3")), F.col("tail"), _s(F.col("base")))
    return (
        F.when(kind == 0, F.concat(F.lit("<answer>"), e, F.lit("</answer>")))
        .when(kind == 1, F.concat(F.lit("<think>step by step</think> <answer>("), e, F.lit(")</answer>")))
        .when(kind == 2, F.concat(F.lit("The result is "), e))
        .when(kind == 3, F.concat(F.lit("<answer>"), n1, F.lit(" + "), n2, F.lit("</answer>")))
        .when(kind == 4, F.concat(F.lit("<answer>"), e, F.lit(" +</answer>")))
        .when(kind == 5, F.concat(F.lit("<answer>1</answer> <ANSWER> "), e, F.lit(" </ANSWER>")))
        .when(kind == 6, F.concat(F.lit("<answer>"), e, F.lit(" = "), base, F.lit("</answer>")))
        .when(kind == 7, F.concat(F.lit("<think>a</think><answer>-(-("), e, F.lit("))</answer>")))
        .when(kind == 8, F.concat(F.lit("<answer>"), n1, F.lit(" * "), n2, F.lit(" - "), n3, tail, F.lit("</answer>")))
        .otherwise(F.concat(F.lit("<answer>"), n1, F.lit(" / "), n2, F.lit(" + "), n3, tail, F.lit("</answer>")))
    )


def _kind(slot: Column) -> Column:
    return F.when(F.col("task_id") % 10 == 9, 2).otherwise((F.col("task_id") * 3 + slot) % 10)


def _e() -> Column:
    return F.concat(_s(F.col("n1")), F.lit(" + "), _s(F.col("n2")), F.lit(" - "), _s(F.col("n3")), F.col("tail"))


def rollout_parts(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """Rollouts with task helper columns (P10 expansion: G adjacent slots)."""
    t = task_parts(spark, sf_dir, ranges)
    r = t.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(GROUP_SIZE - 1).cast("bigint"))).alias("slot"))
    kind = _kind(F.col("slot"))
    e = _e()
    return r.select(
        "*",
        kind.cast("bigint").alias("kind"),
        e.alias("e"),
        _response(kind, e).alias("response"),
        (F.lit(4) + (F.col("task_id") * 5 + F.col("slot") * 3) % 60).cast("bigint").alias("output_tokens"),
    )


ROLLOUT_COLUMNS = ["run_id", "step", "task_id", "prompt_ord", "slot", "response", "output_tokens"]


def rollouts(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """``rollouts(run_id, step, task_id, prompt_ord, slot, response, output_tokens)``."""
    return rollout_parts(spark, sf_dir, ranges).select(*ROLLOUT_COLUMNS)


def rollouts_with_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts already carrying ``target`` and ``nums`` (no join needed)."""
    return rollout_parts(spark, sf_dir).select(*ROLLOUT_COLUMNS, "target", "nums")


# --- token ids and log-prob arrays (T1-T13) --------------------------------

TOKEN_EOS = 1000
TOKEN_PAD = 1000


def _index_array(n: Column, fn) -> Column:
    return F.transform(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1), fn)


def token_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollout keys with prompt and output token ids (ids 0..999)."""
    r = rollout_parts(spark, sf_dir)
    t, s = F.col("task_id"), F.col("slot")
    p_len = F.lit(3) + t % 5
    o_len = F.lit(1) + (t + s) % 6
    return r.select(
        "run_id", "step", "task_id", "prompt_ord", "slot",
        _index_array(p_len, lambda i: ((t * 17 + i * 29) % 1000).cast("int")).alias("prompt_ids"),
        _index_array(o_len, lambda i: ((t * 13 + s * 7 + i * 31) % 1000).cast("int")).alias("output_ids"),
    )


def with_logprob_arrays(df: DataFrame) -> DataFrame:
    """Add policy / old / reference log-prob arrays and a response mask of
    length ``4 + task_id % 9`` to any table keyed by (task_id, slot)."""
    t, s = F.col("task_id"), F.col("slot")
    n = F.lit(4) + t % 9

    def lp(a: int, b: int, c: int) -> Column:
        return _index_array(n, lambda i: -((t * a + s * b + i * c) % 50).cast("double") / F.lit(10.0))

    return df.select(
        "*",
        lp(31, 7, 13).alias("policy_log_probs"),
        lp(11, 5, 17).alias("old_log_probs"),
        lp(19, 3, 23).alias("ref_log_probs"),
        _index_array(n, lambda i: i >= t % 3).alias("response_mask"),
    )


def logprob_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts (with target, nums, response) plus log-prob arrays."""
    return with_logprob_arrays(rollout_parts(spark, sf_dir).select(*ROLLOUT_COLUMNS, "target", "nums"))


def nested_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generator-shaped records: one row per prompt with ``outputs`` =
    ``[{text}, ...]`` (G entries; empty for task_id % 7 == 0)."""
    t = task_parts(spark, sf_dir)
    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(GROUP_SIZE - 1).cast("bigint"))
    outputs = F.transform(slots, lambda s: F.struct(_response(_kind(s), _e()).alias("text")))
    empty = F.array().cast("array<struct<text:string>>")
    return t.select("run_id", "step", "task_id",
                    F.when(F.col("task_id") % 7 == 0, empty).otherwise(outputs).alias("outputs"))


def sft_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fine-tuning rows: completions of kinds 0, 1, 7; ``solution`` = the
    equation, ``result`` = its value, ``is_exact`` = target reached."""
    r = rollout_parts(spark, sf_dir).where(F.col("kind").isin(0, 1, 7))
    return r.select(
        "task_id", "slot",
        F.when(F.col("task_id") % 10 == 3, "validation").otherwise("train").alias("split"),
        "target", "nums",
        F.col("e").alias("solution"),
        F.col("response").alias("completion"),
        F.col("base").cast("double").alias("result"),
        (F.col("target") == F.col("base")).alias("is_exact"),
    )


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation history from ``events``: run = user_id % 5, step = event_id,
    category = event_type, score = value."""
    ev = spread(read_table(spark, sf_dir, "events"), ["event_id"])
    return ev.select(
        (F.col("user_id") % 5).alias("run_id"),
        F.col("event_type").alias("category"),
        F.col("event_id").alias("step"),
        F.col("value").cast("double").alias("score"),
    )


def gradient_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gradient norm per run, step and parameter (the tasks of a step stand in for parameters)."""
    return task_parts(spark, sf_dir).select(
        "run_id", "step", F.col("task_id").alias("parameter"), ((F.col("task_id") * 7 % 13).cast("double") / 16.0).alias("norm"))
