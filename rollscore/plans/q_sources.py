"""Registered queries for stored tables: quarantine on reading (S1, S2, S5), the pruned task store (P1, S1), the batched
map (U2), the join on (step, task_id) with observed counters (J2) and the whole training step over co-located tables."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import prompts as PR
from ..functions._util import report_double
from ..functions.batched import batched_map
from ..operators.metrics import grad_norm_per_step
from ..operators.scoring import attach_tasks_observed
from ..session import scratch_dir
from ..sources import quarantine as Q
from ..sources import sinks as SK
from ..sources import stores as ST
from . import fixtures as FX
from . import jobs as J
from .oracle import ROLLOUT_PARTS, rd
from .q_metrics import _M1_FULL
from .q_prompts import _sft_sql, _tasks_sql, _template_sql
from .q_tokens import _loss_sql
from .registry import register

# --- S2: JSON Lines with planted bad lines --------------------------------------------


def _task_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON line per task; some are cut, some carry a text for a number, some lack a field."""
    t = F.col("task_id")
    good = F.to_json(F.struct("target", "nums"))
    return FX.tasks(spark, sf).select(
        F.when(t % 13 == 0, F.substring(good, F.lit(1), F.length(good) - 4))
        .when(t % 13 == 1, F.regexp_replace(good, '"target":(-?[0-9]+)', '"target":"about $1"'))
        .when(t % 13 == 2, F.to_json(F.struct("target"))).otherwise(good).alias("line"))


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "quarantine")
    lines, out = os.path.join(work, "lines"), os.path.join(work, "read")
    _task_lines(spark, sf).write.text(lines)
    Q.split_jsonl(spark, lines, schemas.TASK_JSON, out)
    good = Q.good_rows(spark, schemas.TASK_JSON, out).select(
        F.lit("good").alias("kind"), F.concat(F.col("target").cast("string"), F.lit(":"), F.array_join("nums", ",")).alias("content"))
    bad = Q.bad_lines(spark, schemas.TASK_JSON, out).select(F.col("reason").alias("kind"), F.col("line").alias("content"))
    return good.union(bad).groupBy("kind", "content").agg(F.count(F.lit(1)).alias("n"))


register("jsonl_quarantine", _tasks_sql(
    ", j AS (SELECT *, '{\"target\":' || CAST(target AS VARCHAR) || ',\"nums\":[' || array_to_string(nums, ',') || ']}' AS good FROM task_parts), "
    "k AS (SELECT CASE task_id % 13 WHEN 0 THEN 'malformed' WHEN 1 THEN 'type' WHEN 2 THEN 'missing' ELSE 'good' END AS kind, "
    "CASE task_id % 13 WHEN 0 THEN substr(good, 1, length(good) - 4) "
    "WHEN 1 THEN '{\"target\":\"about ' || CAST(target AS VARCHAR) || '\",\"nums\":[' || array_to_string(nums, ',') || ']}' "
    "WHEN 2 THEN '{\"target\":' || CAST(target AS VARCHAR) || '}' "
    "ELSE CAST(target AS VARCHAR) || ':' || array_to_string(nums, ',') END AS content FROM j) "
    "SELECT kind, content, count(*) AS n FROM k GROUP BY kind, content"))(_quarantine)

# --- P1, S1, S3: task store ------------------------------------------------------------


def _task_store(spark: SparkSession, sf: str) -> DataFrame:
    """A curriculum: three numbers in training, all sizes in the test split, as a table that prunes folders."""
    path = scratch_dir(spark, "task-store")
    ST.write_task_store(FX.tasks(spark, sf), path)
    sizes = spark.createDataFrame([("train", 3), ("test", 3), ("test", 4)], "split string, n_nums int")
    return ST.tasks_of_sizes(ST.read_task_store(spark, path), sizes).select(
        "task_id", "split", "n_nums", "target", PR.py_list("nums").alias("nums"))


register("task_store", _tasks_sql(
    "SELECT task_id, split, n_nums, target, '[' || array_to_string(nums, ', ') || ']' AS nums FROM task_parts "
    "WHERE split = 'test' OR n_nums = 3"))(_task_store)


def _tasks_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of every task, written as JSON Lines per split and read back with the declared schema."""
    path = scratch_dir(spark, "tasks-jsonl")
    SK.write_tasks_jsonl(FX.tasks(spark, sf), path)
    schema = T.StructType(schemas.TASK_JSON.fields + [T.StructField("split", T.StringType())])
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.select("split", "target", PR.py_list("nums").alias("nums")).groupBy("split", "target", "nums").agg(
        F.count(F.lit(1)).alias("n"))


register("tasks_jsonl", _tasks_sql(
    "SELECT split, CAST(target AS BIGINT) AS target, '[' || array_to_string(nums, ', ') || ']' AS nums, count(*) AS n FROM task_parts "
    "GROUP BY ALL"))(_tasks_jsonl)

# --- U2: tokenise and mask in batches ----------------------------------------------------

IGNORED = -100


def _encode(text: str) -> list[int]:
    return [ord(w[0]) * 7 + len(w) for w in text.split(" ") if w]


def _tokenise(batch: pa.RecordBatch) -> dict[str, list]:
    """Ids of prompt and completion; labels are those of the completion."""
    prompts, completions = (batch.column(c).to_pylist() for c in ("prompt", "completion"))
    ids, labels = [], []
    for p, c in zip(prompts, completions):
        head, tail = _encode(p), _encode(c)
        ids.append(head + tail)
        labels.append([IGNORED] * len(head) + tail)
    return {"input_ids": ids, "labels": labels}


TOKEN_COLUMNS = T.StructType([T.StructField("input_ids", T.ArrayType(T.IntegerType())), T.StructField("labels", T.ArrayType(T.IntegerType()))])


def _tokenise_and_mask(spark: SparkSession, sf: str) -> DataFrame:
    rows = FX.sft_rows(spark, sf).withColumn("prompt", PR.prompt("D"))
    out = batched_map(rows, _tokenise, TOKEN_COLUMNS, reads=["prompt", "completion"],
                      remove=["prompt", "completion", "solution", "nums", "target", "result", "is_exact"])
    return out.select("task_id", "slot", "split", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"))


def _ids_sql(text: str) -> str:
    return f"list_transform(list_filter(string_split({text}, ' '), lambda w: w <> ''), lambda w: ascii(w) * 7 + length(w))"


register("tokenise_batches", _sft_sql(
    f", t AS (SELECT *, {_ids_sql(_template_sql(PR.TEMPLATE_D))} AS p, {_ids_sql('completion')} AS c FROM sft) "
    "SELECT task_id, slot, split, array_to_string(list_concat(p, c), ' ') AS input_ids, "
    f"array_to_string(list_concat(list_transform(p, lambda x: {IGNORED}), c), ' ') AS labels FROM t"))(_tokenise_and_mask)

# --- J2: the join on (step, task_id), unmatched keys counted ------------------------------


def _step_task_join(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks as they were sampled per step; those of every seventh step are missing."""
    sampled = FX.task_parts(spark, sf).where(F.col("step") % 7 != 0).select("step", "task_id", "target", "nums")
    joined, seen = attach_tasks_observed(FX.rollouts(spark, sf), sampled, ("step", "task_id"))
    path = scratch_dir(spark, "step-task-join")
    joined.groupBy("run_id", "step").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").alias("sum_target")).write.parquet(path)
    counts = seen.get
    return spark.read.parquet(path).withColumns({c: F.lit(counts[c]).cast("bigint") for c in ("n_rollouts", "n_unmatched")})


register("step_task_join", "WITH " + ROLLOUT_PARTS.strip() +
         ", c AS (SELECT count(*) AS n_rollouts, count(*) FILTER (step % 7 = 0) AS n_unmatched FROM rollout_parts) "
         "SELECT run_id, step, count(*) AS n_rows, CAST(sum(target) AS BIGINT) AS sum_target, any_value(n_rollouts) AS n_rollouts, "
         "any_value(n_unmatched) AS n_unmatched FROM rollout_parts, c WHERE step % 7 <> 0 GROUP BY run_id, step")(_step_task_join)

# --- the training step, whole ---------------------------------------------------------------


def _training_step(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring, advantages and losses over bucketed tables; training and evaluation rows of the metrics table."""
    work = scratch_dir(spark, "training-step")
    rollouts = FX.logprob_rollouts(spark, sf)
    paths = J.training_step_job(spark, rollouts, FX.tasks(spark, sf), work, buckets=8,
                                grad_norm=grad_norm_per_step(FX.gradient_norms(spark, sf)))
    rows = SK.read_metrics(spark, paths["metrics"]).where(F.col("writer") == "train")
    return rows.select("run_id", "step", "tag", report_double(F.col("value")).alias("value"))


register("training_step", _loss_sql(_M1_FULL + " UNION ALL ".join(
    f"SELECT run_id, step, 'train/{c}' AS tag, {rd(c)} AS value FROM full_m"
    for c in ("loss", "grad_norm", "reward_mean", "reward_std", "avg_output_tokens"))))(_training_step)
