"""End-to-end jobs: the reference's four workflows as Spark plans.

* :func:`training_step_job` -- rollouts (+ tasks, token ids, log-probs) ->
  scores -> advantages -> sequence losses -> per-step metrics, written as
  tables (SURVEY 3.A). Scored rollouts are written once and every later
  stage reads that table, so parsing and equation evaluation run once even
  though several aggregations consume them.
* :func:`zero_shot_job` -- rollouts x tasks -> hybrid reward -> accuracy per
  (model, max_tokens) (3.B).
* :func:`sft_prep_job` -- fine-tuning rows -> chat text -> token rows with
  prompt-masked labels (3.C); token ids come from a caller-supplied
  tokenizer column function, the tokenizer itself is not rebuilt.
* :func:`easy_set_job` -- tasks -> k-number filter -> JSONL per split plus
  split statistics (3.D).

Paths are folders on shared storage; every write is an overwrite of the
job's own output, so a re-run after a lost executor or driver is safe.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts as PR
from ..operators import advantages as A
from ..operators import evals as E
from ..operators import losses as LO
from ..operators import metrics as M
from ..operators import tasks as TS
from ..operators import tokens as TO
from ..operators.scoring import attach_tasks, attach_tasks_observed, require, score
from ..session import FREE_SHUFFLES, settings
from ..sources import sinks as SK
from ..sources import stores as ST

ROW_KEYS = ["run_id", "step", "task_id", "slot"]
# Tables bucketed by some of the join's keys are joined as they lie; a group never holds more than its G rows.
AS_THEY_LIE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def training_step_job(
    spark: SparkSession,
    rollouts: DataFrame,
    tasks: DataFrame,
    out_dir: str,
    reward: str = "hybrid",
    scale: float | None = None,
    group_size: int = 8,
    rollout_batch_size: int = 128,
    gradient_accumulation_steps: int = 32,
    loss_type: str = "grpo",
    clip_range: float = 0.2,
    advantage_eps: float = 1e-6,
    stabilized: bool = False,
    max_completion_length: int = 256,
    eval_every: int = 10,
    buckets: int = 64,
    bucket_rows: int = 1 << 18,
    grad_norm: DataFrame | None = None,
    batch: int = 0,
    wave_rows: int = 1 << 26,
) -> dict[str, str]:
    """Score, normalise and reduce a table of rollouts; returns table paths.

    Rollouts without a task, and groups of another size than ``group_size``,
    raise after the table that shows them has been written; they are counted
    in that write. Token arrays and advantages are laid out by group in ``buckets``
    buckets, or in more where those would hold over ``bucket_rows`` rollouts
    each (choose both by the size of the arrays). ``batch`` names the rows of the
    metrics table that this run replaces.

    Each of the large tables is written in waves of about ``wave_rows`` rollouts
    (twice as many for the step metrics; choose it by the size of the arrays and
    the free disk): a wave reads its source again, shuffles its own share and
    frees that before the next. Only a hot task or step makes a wave larger.

    ``rollouts`` needs ``run_id, step, task_id, prompt_ord, slot, response,
    output_tokens`` plus ``policy_log_probs, old_log_probs, response_mask``.
    """
    paths = {name: os.path.join(out_dir, name) for name in
             ("scored", "advantages", "tokens", "step_metrics", "metrics", "eval_metrics", "eval_summary", "examples")}
    rollouts = rollouts.drop("target", "nums")  # ground truth comes from the task table
    arrays = ["policy_log_probs", "old_log_probs", "response_mask"]
    with settings(spark, FREE_SHUFFLES), ST.bucket_names(spark, "tokens", "advantages") as (tokens_name, adv_name):
        waves, matched, groups = ST.waves_of(rollouts.count(), wave_rows), [], []
        for i in range(waves):
            joined, seen = attach_tasks_observed(ST.wave(rollouts, F.xxhash64("task_id"), waves, i), tasks)
            matched.append(seen)
            scored = score(joined, reward=reward, scale=scale).drop(*arrays)
            (scored.write.mode("append" if i else "overwrite").option("partitionOverwriteMode", "static")
             .option("compression", "zstd").partitionBy("run_id").parquet(paths["scored"]))
        n_rollouts = require(*matched, n_unmatched=0)["n_rollouts"]
        buckets, waves = max(buckets, -(-n_rollouts // bucket_rows)), ST.waves_of(n_rollouts, wave_rows)
        scored_t = spark.read.schema(scored.schema).parquet(paths["scored"])

        # Token arrays are laid out by the group once; the narrow advantages follow them, not the other way round.
        tokens = ST.write_bucketed(rollouts.select(*ROW_KEYS, *arrays), tokens_name, paths["tokens"],
                                   A.GROUP_KEYS, buckets, ROW_KEYS, waves)

        def advantages(rows: DataFrame) -> DataFrame:
            adv, seen = A.observe_groups(A.group_advantages(
                rows, normalize_by_std=A.normalizes_by_std(loss_type), eps=advantage_eps, stabilized=stabilized), group_size)
            groups.append(seen)
            return adv

        adv_t = ST.write_bucketed(
            scored_t.select("run_id", "step", "task_id", "prompt_ord", "slot", "reward", "output_tokens"),
            adv_name, paths["advantages"], A.GROUP_KEYS, buckets, ROW_KEYS, waves, advantages)
        require(*groups, n_ragged=0)

        waves = ST.waves_of(n_rollouts, 2 * wave_rows)  # rows without text and arrays
        for i in range(waves):
            adv, token_rows = (ST.wave(t, F.xxhash64(*A.STEP_KEYS), waves, i) for t in (adv_t, tokens))
            seqs = LO.sequence_losses(
                adv.join(token_rows, ROW_KEYS),
                clip_range=clip_range, loss_type=loss_type, max_completion_length=max_completion_length,
                gradient_accumulation_steps=gradient_accumulation_steps, clamp_log_ratio=stabilized,
            ).withColumn("micro_batch", TS.micro_batch_id(
                "prompt_ord", "slot", group_size, TS.micro_size(rollout_batch_size, gradient_accumulation_steps)))
            step_metrics = M.train_step_metrics(seqs, rescale=True, grad_norm=grad_norm)
            with settings(spark, AS_THEY_LIE):
                step_metrics.write.mode("append" if i else "overwrite").parquet(paths["step_metrics"])
        stored = spark.read.schema(step_metrics.schema).parquet(paths["step_metrics"])
        SK.write_metrics(M.train_metrics_long(stored), paths["metrics"], "train", batch)

        evals = TS.eval_steps(scored_t, eval_every)
        summary = E.eval_summary(evals, ("run_id", "step"), "exact")
        summary.write.mode("overwrite").parquet(paths["eval_summary"])
        summary_t = spark.read.schema(summary.schema).parquet(paths["eval_summary"])
        SK.write_metrics(M.eval_metrics_long(M.with_best_accuracy(summary_t)), paths["eval_metrics"], "eval", batch)
        top = E.top_examples(evals, n=10)
        E.examples_report(top).write.mode("overwrite").parquet(paths["examples"])
        SK.write_metrics(E.examples_long(top), paths["eval_metrics"], "examples", batch)
    return paths


def zero_shot_job(rollouts: DataFrame, tasks: DataFrame, keys=("model", "max_tokens")) -> DataFrame:
    """Accuracy of each (model, max_tokens) on its responses: reward exactly 1."""
    scored = score(attach_tasks(rollouts.drop("target", "nums"), tasks), reward="hybrid")
    return E.zero_shot_accuracy(scored, keys)


def sft_prep_job(
    sft: DataFrame,
    tokenize: Callable[[Column], Column],
    out_path: str | None = None,
    width: int = 512,
    pad_id: int = 0,
) -> DataFrame:
    """Chat-wrapped prompt + stripped completion -> fixed-width ids with
    prompt-masked labels. ``tokenize`` maps a string Column to an id array
    Column (an Arrow UDF around a tokenizer, or ids already stored)."""
    chat = PR.chat_prompt(PR.prompt("C"))
    rows = sft.select("*", chat.alias("prompt_text"))
    rows = rows.select("*", PR.sft_text_chat(F.col("prompt_text"), "completion").alias("text"))
    rows = rows.select("*", tokenize(F.col("text")).alias("token_ids"),
                       F.size(tokenize(F.col("prompt_text"))).alias("prompt_len"))
    out = TO.fixed_width_rows(rows, width=width, pad_id=pad_id)
    if out_path:
        out.write.mode("overwrite").partitionBy("split").parquet(out_path)
    return out


def easy_set_job(tasks: DataFrame, out_path: str, k: int = 3) -> DataFrame:
    """Keep k-number tasks, write ``{target, nums}`` JSONL per split and
    return the split statistics."""
    SK.write_tasks_jsonl(TS.filter_by_size(tasks, k), out_path)
    return TS.split_stats(tasks, k)
