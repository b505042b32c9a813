"""Structured Streaming versions of scoring, per-step metrics and best-so-far
(ST1-ST3), re-aimed from the trainer's step loop.

* ST1: rollouts arrive as files; each micro-batch is joined to the static
  task table (stream-static join) and scored with the same Column functions
  as the batch job. Append mode, file sink (exactly-once via the sink log).
* ST2: per-(run, step) reward metrics kept in the state store (one small
  buffer per step) and published in complete mode, each batch overwriting
  the result table (idempotent on retry).
* ST2 on event time: windows emitted in append mode; a replay that ends with a
  closing row (``replay.with_closing_row``) emits every window, and late rows
  are reported per window.

ST3 (best-so-far) is in ``manifest.py``, the replay of tables as streams in
``replay.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scoring import attach_tasks, score
from ..session import scratch_dir  # noqa: F401  (kept here for callers)
from .replay import land_partitions


def replay_files(df: DataFrame, path: str, by: str = "step", files: int | None = None) -> None:
    """Write a table as files of ascending ``by``, the order in which a generator
    delivers steps. A file holds a range of values, each of them whole, so the
    number of files is ``files`` however many steps there are. Without ``files``
    the table's partitions are such ranges already."""
    land_partitions(df.repartitionByRange(files, by) if files else df, path)


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 64) -> DataFrame:
    """Stream a folder of Parquet files with a fixed schema."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def score_stream(rollouts: DataFrame, tasks: DataFrame, reward: str = "hybrid", scale: float | None = None) -> DataFrame:
    """ST1: streaming rollouts -> task join -> reward."""
    return score(attach_tasks(rollouts, tasks), reward=reward, scale=scale)


def step_metrics_stream(scored: DataFrame, keys=("run_id", "step")) -> DataFrame:
    """ST2: reward mean / population std / max / min, count and average
    output tokens per step."""
    r = F.col("reward")
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_rollouts"), F.avg(r).alias("reward_mean"), F.stddev_pop(r).alias("reward_std"),
        F.max(r).alias("reward_max"), F.min(r).alias("reward_min"),
        F.avg(F.col("output_tokens").cast("double")).alias("avg_output_tokens"),
    )


def step_metrics_by_event_time(
    scored: DataFrame,
    event_time: str = "ts",
    delay: str = "10 minutes",
    window: str = "1 minute",
    keys=("run_id",),
) -> DataFrame:
    """ST2 on event time: reward metrics per run and tumbling window, emitted
    once the watermark passes the window (append mode). Rows later than the
    watermark are dropped by Spark, as documented for watermarks.

    Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column (such as ``events.ts``)
    is read as UTC timestamps first (session time zone UTC)."""
    ts = F.col(event_time).cast("timestamp")
    r = F.col("reward")
    return (
        scored.withColumn("__event_time", ts)
        .withWatermark("__event_time", delay)
        .groupBy(*keys, F.window("__event_time", window).alias("window"))
        .agg(F.count(F.lit(1)).alias("num_rollouts"), F.avg(r).alias("reward_mean"),
             F.stddev_pop(r).alias("reward_std"), F.max(r).alias("reward_max"), F.min(r).alias("reward_min"))
    )


def late_report(arrived: DataFrame, windows: DataFrame, event_time: str = "ts", window: str = "1 minute",
                keys=("run_id",), count: str = "num_rollouts") -> DataFrame:
    """Rows that arrived in each (key, window) and how many of them came after the window had been emitted.

    ``arrived`` holds the delivered rows, ``windows`` the emitted ones with their ``window_start``. A window that
    only late rows fell into has a report but no metrics. Both sides are aggregates by the same keys."""
    start = F.window(F.col(event_time).cast("timestamp"), window)["start"]
    counted = arrived.groupBy(*keys, start.alias("window_start")).agg(F.count(F.lit(1)).alias("n_arrived"))
    joined = counted.join(windows, [*keys, "window_start"], "left")
    return joined.withColumn("late_rows", F.col("n_arrived") - F.coalesce(F.col(count), F.lit(0)))


def run_append(df: DataFrame, sink: str, checkpoint: str) -> None:
    """Run a stream over everything available into a Parquet sink."""
    q = (
        df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_complete(df: DataFrame, sink: str, checkpoint: str) -> None:
    """Run a complete-mode aggregation; every batch overwrites ``sink``."""

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    q = (
        df.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
        .outputMode("complete").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
