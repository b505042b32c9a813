"""Registered streaming queries: the driver collects batch DataFrames, so
each query replays the derived rollouts (files of ascending steps) through
the stream, runs it to completion and returns the sink table. The stream result
must equal the batch result, so the batch oracles apply unchanged."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import report_double
from ..streaming import scoring as ST
from ..streaming.manifest import ARRIVAL, BestManifest, track_best
from ..streaming.replay import land_batches, land_partitions, landed, with_closing_row
from . import fixtures as FX
from .q_metrics import _HIST
from .q_scoring import ROLL_KEYS, _RK, _rewarded_sql
from .oracle import rd
from .registry import ORACLES, register


# Micro-batches of a replay. Each one reads the static tasks (or the stored result) again and has fixed costs, so their
# number does not grow with the table; the files of one do, so that it is spread over the cluster.
_DELIVERIES = 8
_TASKS_PER_FILE = 1 << 15


def _replayed_rollouts(spark: SparkSession, sf: str, work: str) -> DataFrame:
    src = os.path.join(work, "rollouts")
    per_delivery = max(8, -(-FX.read_table(spark, sf, "orders").count() // (_DELIVERIES * _TASKS_PER_FILE)))
    rows = FX.rollouts(spark, sf, ranges=_DELIVERIES * per_delivery)
    ST.replay_files(rows, src, by="step")
    return ST.file_stream(spark, src, rows.schema, max_files_per_trigger=per_delivery)


def _stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    work = ST.scratch_dir(spark, "stream-scores")
    scored = ST.score_stream(_replayed_rollouts(spark, sf, work), FX.tasks(spark, sf), reward="hybrid")
    sink = os.path.join(work, "out")
    ST.run_append(scored.select(*ROLL_KEYS, "reward"), sink, os.path.join(work, "chk"))
    return spark.read.parquet(sink).select(*ROLL_KEYS, report_double(F.col("reward")).alias("reward"))


register("stream_scores", ORACLES["reward_hybrid"])(_stream_scores)


def _stream_step_metrics(spark: SparkSession, sf: str) -> DataFrame:
    work = ST.scratch_dir(spark, "stream-metrics")
    scored = ST.score_stream(_replayed_rollouts(spark, sf, work), FX.tasks(spark, sf), reward="hybrid")
    sink = os.path.join(work, "out")
    ST.run_complete(ST.step_metrics_stream(scored), sink, os.path.join(work, "chk"))
    out = spark.read.parquet(sink)
    return out.select("run_id", "step", "num_rollouts", *[report_double(F.col(c)).alias(c) for c in
                      ("reward_mean", "reward_std", "reward_max", "reward_min", "avg_output_tokens")])


register("stream_step_metrics", _rewarded_sql("hybrid",
    f"SELECT run_id, step, count(*) AS num_rollouts, {rd('avg(r)')} AS reward_mean, {rd('stddev_pop(r)')} AS reward_std, "
    f"{rd('max(r)')} AS reward_max, {rd('min(r)')} AS reward_min, {rd('avg(output_tokens)')} AS avg_output_tokens "
    "FROM rewarded GROUP BY run_id, step"))(_stream_step_metrics)


_ARRIVAL_STEPS = 2000


def _tracked(spark: SparkSession, sf: str, arrival: Column) -> BestManifest:
    """The history in order of arrival; a file, and so a micro-batch, holds the arrivals of a range."""
    work = ST.scratch_dir(spark, "stream-best")
    src = os.path.join(work, "history")
    hist = FX.metric_history(spark, sf).withColumn(ARRIVAL, arrival.cast("bigint"))
    land_partitions(hist.repartitionByRange(_DELIVERIES, ARRIVAL), src)
    manifest = BestManifest(spark, os.path.join(work, "manifest"), init=0.0, chunk_steps=1000)
    track_best(ST.file_stream(spark, src, hist.schema, max_files_per_trigger=1), manifest, "replay", os.path.join(work, "chk"))
    return manifest


register("stream_best", _HIST +
         f"SELECT run_id, category, step, {rd('score')} AS score FROM w WHERE score > greatest(coalesce(prev, 0.0), 0.0)")(
    lambda spark, sf: _tracked(spark, sf, F.expr(f"step div {_ARRIVAL_STEPS}")).bests().select(
        "run_id", "category", "step", report_double(F.col("score")).alias("score"))
)


def _stream_best_late(spark: SparkSession, sf: str) -> DataFrame:
    """Every eleventh evaluation arrives two arrivals late: the manifest ends as the batch result all the same."""
    late = F.when(F.col("step") % 11 == 0, 2).otherwise(0)
    manifest = _tracked(spark, sf, F.expr(f"step div {_ARRIVAL_STEPS}") + late)
    best = manifest.bests().groupBy("run_id", "category").agg(
        F.max(F.struct("score", (-F.col("step")).alias("s"))).alias("m"), F.count(F.lit(1)).alias("n_bests"))
    return manifest.seen().join(best, ["run_id", "category"], "left").select(
        "run_id", "category", "n_rows", "n_late", F.coalesce("n_bests", F.lit(0)).alias("n_bests"),
        report_double(F.col("m.score")).alias("best_score"), (-F.col("m.s")).alias("best_step"))


register("stream_best_late", _HIST.rstrip() +
         f", a AS (SELECT *, step // {_ARRIVAL_STEPS} + CASE WHEN step % 11 = 0 THEN 2 ELSE 0 END AS batch FROM h), "
         "l AS (SELECT *, max(step) OVER (PARTITION BY run_id, category ORDER BY batch "
         "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_step FROM a), "
         "n AS (SELECT run_id, category, count(*) AS n_rows, count(*) FILTER (step <= last_step) AS n_late FROM l GROUP BY 1, 2), "
         "b AS (SELECT run_id, category, count(*) AS n_bests, max(score) AS best_score, arg_max(step, score) AS best_step "
         "FROM w WHERE score > greatest(coalesce(prev, 0.0), 0.0) GROUP BY 1, 2)\n"
         f"SELECT run_id, category, n_rows, n_late, coalesce(n_bests, 0) AS n_bests, {rd('best_score')} AS best_score, best_step "
         "FROM n LEFT JOIN b USING (run_id, category)")(_stream_best_late)

# --- ST2 on event time: a day per batch, some events a day or two late, closed at the end ---

_WINDOW, _DELAY = "6 hours", "12 hours"


def _stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    work = ST.scratch_dir(spark, "stream-windows")
    src = os.path.join(work, "events")
    late = F.when(F.col("event_id") % 7 == 3, 1).when(F.col("event_id") % 7 == 5, 2).otherwise(0)
    day = F.datediff(F.col("ts").cast("date"), F.lit("2000-01-01").cast("date"))
    events = FX.read_spread(spark, sf, "events", "event_id").select(
        (F.col("user_id") % 5).alias("run_id"), "ts", F.col("value").cast("double").alias("reward"), (day + late).alias("batch"))
    events = with_closing_row(events, "ts", "batch", "'3 days'")
    land_batches(events, src, F.col("batch"))
    stream = ST.file_stream(spark, src, events.schema, max_files_per_trigger=1)
    sink = os.path.join(work, "out")
    ST.run_append(ST.step_metrics_by_event_time(stream, delay=_DELAY, window=_WINDOW), sink, os.path.join(work, "chk"))
    windows = spark.read.parquet(sink).where(F.col("run_id").isNotNull()).withColumn("window_start", F.col("window.start"))
    arrived = landed(spark, src, events.schema).where(F.col("run_id").isNotNull())
    out = ST.late_report(arrived, windows, window=_WINDOW)
    return out.select(
        "run_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.coalesce("num_rollouts", F.lit(0)).alias("num_rollouts"), "late_rows",
        *[report_double(F.col(c)).alias(c) for c in ("reward_mean", "reward_std", "reward_max", "reward_min")])


# A row is late when its window ended at or before the watermark of the batch before the previous one: Spark drops
# by the watermark with which the previous batch closed its windows.
register("stream_windows",
         "WITH e AS (SELECT user_id % 5 AS run_id, ts, value AS r, time_bucket(INTERVAL '6 hours', ts) AS w, "
         "date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) "
         "+ CASE event_id % 7 WHEN 3 THEN 1 WHEN 5 THEN 2 ELSE 0 END AS batch FROM events), "
         "b AS (SELECT batch, max(ts) AS newest FROM e GROUP BY batch), "
         "m AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) "
         "- INTERVAL '12 hours' AS mark FROM b), "
         "f AS (SELECT e.*, coalesce(e.w + INTERVAL '6 hours' <= m.mark, false) AS late FROM e JOIN m USING (batch))\n"
         "SELECT run_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) FILTER (NOT late) AS num_rollouts, "
         "count(*) FILTER (late) AS late_rows, " +
         ", ".join(f"{rd(fn + '(r) FILTER (NOT late)')} AS {name}" for fn, name in (
             ("avg", "reward_mean"), ("stddev_pop", "reward_std"), ("max", "reward_max"), ("min", "reward_min"))) +
         " FROM f GROUP BY run_id, w")(_stream_windows)

__all__ = ["_RK"]
