"""Table schemas of the data model (tasks, rollouts, tokens, metrics)."""

from __future__ import annotations

from pyspark.sql import types as T

TASK = T.StructType(
    [
        T.StructField("task_id", T.LongType(), False),
        T.StructField("split", T.StringType(), True),
        T.StructField("target", T.IntegerType(), True),
        T.StructField("nums", T.ArrayType(T.IntegerType(), False), True),
    ]
)

# JSONL tasks as written by the easy-set job: two fields per line.
TASK_JSON = T.StructType(
    [
        T.StructField("target", T.LongType(), True),
        T.StructField("nums", T.ArrayType(T.LongType(), True), True),
    ]
)

SFT_JSON = T.StructType(
    [
        T.StructField("target", T.LongType(), True),
        T.StructField("nums", T.ArrayType(T.LongType(), True), True),
        T.StructField("solution", T.StringType(), True),
        T.StructField("completion", T.StringType(), True),
        T.StructField("result", T.DoubleType(), True),
        T.StructField("is_exact", T.BooleanType(), True),
    ]
)

ROLLOUT = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("step", T.LongType(), False),
        T.StructField("task_id", T.LongType(), False),
        T.StructField("prompt_ord", T.LongType(), True),
        T.StructField("slot", T.IntegerType(), False),
        T.StructField("prompt", T.StringType(), True),
        T.StructField("response", T.StringType(), True),
        T.StructField("output_tokens", T.IntegerType(), True),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("step", T.LongType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

CHECKPOINT = T.StructType(
    [
        T.StructField("run_id", T.LongType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("step", T.LongType(), False),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("path", T.StringType(), True),
    ]
)

CHAT_MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType(), False),
        T.StructField("content", T.StringType(), True),
    ]
)
