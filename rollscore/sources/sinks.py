"""Sinks: task JSONL, the long metrics table, text metrics, best-checkpoint
manifest and the dataset card (S3, S6-S9).

Writes are plain DataFrame writes: partitioned, no driver-side loops. Metrics
and manifests are written in batches named by (writer, batch): a batch is a
folder of its own and writing it again replaces it whole, so a retry, complete
or after a crash half-way, leaves the rows of one write.
"""

from __future__ import annotations

from collections.abc import Sequence

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def write_tasks_jsonl(tasks: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """S3: ``{target, nums}`` per line, one folder per split."""
    tasks.select("target", "nums", split).write.mode(mode).partitionBy(split).json(path)


def metrics_long(
    wide: DataFrame,
    tags: dict[str, str],
    keys: Sequence[str] = ("run_id", "step"),
) -> DataFrame:
    """Wide per-step metrics -> ``(keys..., tag, value, text)`` rows.

    ``tags`` maps column -> tag name (e.g. ``{"reward_mean": "train/reward_mean"}``).
    """
    pairs = [F.struct(F.lit(tag).alias("tag"), F.col(c).cast("double").alias("value")) for c, tag in tags.items()]
    return wide.select(*keys, F.explode(F.array(*pairs)).alias("m")).select(
        *keys, "m.tag", "m.value", F.lit(None).cast("string").alias("text")
    )


def text_metrics(df: DataFrame, tag: Column, text: str = "text", keys: Sequence[str] = ("run_id", "step")) -> DataFrame:
    """Text rows of the same metrics table."""
    return df.select(*keys, tag.alias("tag"), F.lit(None).cast("double").alias("value"), F.col(text).alias("text"))


def _write_batch(rows: DataFrame, schema: T.StructType, path: str, writer: str, batch: int) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", writer):
        raise ValueError(f"writer {writer!r}: letters, digits, _ and - only (it names a folder)")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    folder = f"{path.rstrip('/')}/writer={writer}/batch={int(batch)}"
    rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run_id").parquet(folder)


def _read_batches(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Declared types for the folder names as well, so that a run_id is never inferred."""
    full = T.StructType(schema.fields + [T.StructField("writer", T.StringType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(full).parquet(path)


def write_metrics(metrics: DataFrame, path: str, writer: str, batch: int) -> None:
    """One batch of the long metrics table; the same (writer, batch) again replaces it."""
    _write_batch(metrics, schemas.METRIC, path, writer, batch)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table of all batches, with ``writer`` and ``batch``; a filter on them or on run_id prunes folders."""
    return _read_batches(spark, schemas.METRIC, path)


def checkpoint_manifest(best: DataFrame, base_dir: str = "./output/best_models") -> DataFrame:
    """One row per new best (run, category, step, score, path); the
    weights themselves are written by the trainer, not here."""
    path = F.concat_ws("/", F.lit(base_dir), F.concat(F.lit("best_"), F.col("category"), F.lit("_step_"), F.col("step").cast("string")))
    return best.select("run_id", "category", "step", F.col("score").cast("double").alias("score"), path.alias("path"))


def write_manifest(manifest: DataFrame, path: str, writer: str, batch: int) -> None:
    """One batch of the manifest; the same (writer, batch) again replaces it."""
    _write_batch(manifest, schemas.CHECKPOINT, path, writer, batch)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return _read_batches(spark, schemas.CHECKPOINT, path)


# The dataset card text (front matter, headings, example block).
CARD_DEFAULT_DESCRIPTION = """This dataset contains supervised fine-tuning (SFT) data for the Countdown math puzzle task.

## Task Description
Given a set of numbers and a target number, generate an equation using basic arithmetic operations (+, -, *, /) where each number is used exactly once.

## Format
Each example contains:
- `target`: The target number to reach
- `nums`: List of available numbers
- `solution`: The equation that solves the puzzle
- `completion`: Full formatted response with <think> reasoning and <answer> tags
- `result`: The evaluated result of the equation
- `is_exact`: Whether the solution exactly matches the target

## Usage
```python
from datasets import load_dataset

dataset = load_dataset("YOUR_USERNAME/countdown-sft")
train_data = dataset["train"]
val_data = dataset["validation"]
```
"""

CARD_HEAD = """---
language:
- en
task_categories:
- text-generation
tags:
- math
- reasoning
- reinforcement-learning
- sft
pretty_name: Countdown SFT Dataset
size_categories:
- n<1K
---

# Countdown SFT Dataset

"""

CARD_TAIL = """
## Example

```python
{
  "target": 36,
  "nums": [79, 17, 60],
  "solution": "79 - (60 - 17)",
  "completion": "<think>\\nI need to reach 36 using 79, 17, and 60...\\n</think>\\n\\n<answer>79 - (60 - 17)</answer>",
  "result": 36.0,
  "is_exact": true
}
```
"""


def dataset_card(sft: DataFrame, description: str | None = None, split: str = "split") -> DataFrame:
    """One-row aggregate of split sizes rendered into the card text.

    The citation block of the original card names a third party and is left
    to the caller (``description`` may carry it)."""
    counts = sft.agg(
        F.count_if(F.col(split) == "train").alias("num_train"),
        F.count_if(F.col(split) == "validation").alias("num_val"),
    )
    body = description if description else CARD_DEFAULT_DESCRIPTION
    text = F.concat(
        F.lit(CARD_HEAD + body + "\n## Dataset Statistics\n- **Train examples**: "),
        F.col("num_train").cast("string"),
        F.lit("\n- **Validation examples**: "),
        F.col("num_val").cast("string"),
        F.lit("\n- **Total**: "),
        (F.col("num_train") + F.col("num_val")).cast("string"),
        F.lit("\n" + CARD_TAIL),
    )
    return counts.select("num_train", "num_val", text.alias("card"))


def write_card(card: DataFrame, path: str) -> None:
    card.select("card").coalesce(1).write.mode("overwrite").text(path)
