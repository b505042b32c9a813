"""Registered queries for training/eval metrics tables, the wide view, best-
so-far tracking, final best and the checkpoint manifest (M1-M4, W4, W5,
S6-S8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._util import report_double
from ..operators import evals as E
from ..operators import metrics as M
from ..operators import tasks as TS
from ..operators.scoring import score, stage_answers
from ..session import scratch_dir
from ..sources import sinks as SK
from . import fixtures as FX
from .oracle import ROLLOUT_PARTS, rd, reward_sql
from .q_tokens import _MICRO, _loss_sql, _seq
from .registry import ORACLES, register

# --- M1, M3, M4: training metrics -------------------------------------------------


def _step_metrics(spark: SparkSession, sf: str) -> DataFrame:
    seqs = _seq(spark, sf, loss_type="grpo", gradient_accumulation_steps=32)
    seqs = seqs.withColumn("micro_batch", TS.micro_batch_id("prompt_ord", "slot", 8, _MICRO))
    return M.train_step_metrics(seqs)


def _rounded_long(long: DataFrame) -> DataFrame:
    return long.select("run_id", "step", "tag", report_double(F.col("value")).alias("value"), "text")


_TRAIN_TAGS_USED = {"loss": "train/loss", "reward_mean": "train/reward_mean", "reward_std": "train/reward_std",
                    "avg_output_tokens": "train/avg_output_tokens"}
_M1_BODY = (
    f", micro AS (SELECT run_id, step, (prompt_ord * 8 + slot) // {_MICRO} AS mb, avg(seq_grpo) / 32.0 AS ml "
    "FROM seq GROUP BY run_id, step, mb), "
    "sl AS (SELECT run_id, step, sum(ml) / count(*) AS loss FROM micro GROUP BY run_id, step), "
    "st AS (SELECT run_id, step, avg(r) AS reward_mean, stddev_pop(r) AS reward_std, avg(output_tokens) AS avg_output_tokens "
    "FROM rewarded GROUP BY run_id, step), "
    "m AS (SELECT st.*, sl.loss FROM st JOIN sl ON st.run_id = sl.run_id AND st.step = sl.step), "
    "lng AS (" + " UNION ALL ".join(
        f"SELECT run_id, step, '{tag}' AS tag, {rd(col)} AS value, CAST(NULL AS VARCHAR) AS text FROM m"
        for col, tag in _TRAIN_TAGS_USED.items()) + ") "
)

register("train_metrics", _loss_sql(_M1_BODY + "SELECT * FROM lng"))(
    lambda spark, sf: _rounded_long(M.train_metrics_long(_step_metrics(spark, sf)))
)

register("metrics_wide", _loss_sql(_M1_BODY + "SELECT run_id, step, " + ", ".join(
    f"max(CASE WHEN tag = '{t}' THEN value END) AS \"{t}\"" for t in _TRAIN_TAGS_USED.values())
    + " FROM lng GROUP BY run_id, step"))(
    lambda spark, sf: M.metrics_wide(_rounded_long(M.train_metrics_long(_step_metrics(spark, sf))),
                                     list(_TRAIN_TAGS_USED.values()))
)

_M1_FULL = _M1_BODY.rstrip() + (
    ", g AS (SELECT run_id, step, sqrt(sum(((task_id * 7 % 13) / 16.0) * ((task_id * 7 % 13) / 16.0))) AS grad_norm "
    "FROM task_parts GROUP BY run_id, step), full_m AS (SELECT m.*, g.grad_norm FROM m JOIN g USING (run_id, step)) ")
_LINE_COLUMNS = ("loss", "grad_norm", "reward_mean", "reward_std", "avg_output_tokens")


def _full_step_metrics(spark: SparkSession, sf: str) -> DataFrame:
    seqs = _seq(spark, sf, loss_type="grpo", gradient_accumulation_steps=32)
    seqs = seqs.withColumn("micro_batch", TS.micro_batch_id("prompt_ord", "slot", 8, _MICRO))
    full = M.train_step_metrics(seqs, grad_norm=M.grad_norm_per_step(FX.gradient_norms(spark, sf)))
    return full.withColumns({c: report_double(F.col(c)) for c in _LINE_COLUMNS})


register("train_summary_line", _loss_sql(
    _M1_FULL + "SELECT run_id, step, printf('Step %d | Loss: %.4f | Grad norm: %.4f | Reward mean: %.4f | Reward std: %.4f "
    "| Avg output tokens: %.1f', step, " + ", ".join(rd(c) for c in _LINE_COLUMNS) + ") AS line FROM full_m"))(
    lambda spark, sf: M.train_summary_line(_full_step_metrics(spark, sf))
)

# --- M2: evaluation metrics at eval steps -----------------------------------------


def _eval_long(spark: SparkSession, sf: str) -> DataFrame:
    rows = TS.eval_steps(FX.rollouts_with_tasks(spark, sf), 10)
    summary = E.eval_summary(score(rows, reward="hybrid"), ("run_id", "step"), "exact")
    return _rounded_long(M.eval_metrics_long(summary))


_EVAL_COLS = {
    "accuracy": "CAST(count_if(abs(r - 1.0) < 1e-8) AS DOUBLE) / count(*) * 100.0",
    "mean_reward": "avg(r)", "std_reward": "coalesce(stddev_samp(r), 0.0)", "avg_output_tokens": "avg(output_tokens)",
    "count_correct": "count_if(abs(r - 1.0) < 1e-8)", "count_partial": "count_if(abs(r - 0.1) < 1e-8)",
    "count_failed": "count_if(abs(r) < 1e-8)",
}
register("eval_metrics", "WITH " + ROLLOUT_PARTS.strip() +
         f",\nrw AS (SELECT *, CAST({reward_sql('hybrid')} AS DOUBLE) AS r FROM answers WHERE step % 10 = 0 OR step = 0)\n" +
         " UNION ALL ".join(
             f"SELECT run_id, step, 'eval/{k}' AS tag, {rd(v)} AS value, CAST(NULL AS VARCHAR) AS text FROM rw GROUP BY run_id, step"
             for k, v in _EVAL_COLS.items()))(_eval_long)

_EVAL_RW = ("WITH " + ROLLOUT_PARTS.strip() +
            f",\nrw AS (SELECT *, CAST({reward_sql('hybrid')} AS DOUBLE) AS r FROM answers WHERE step % 10 = 0 OR step = 0)")


def _eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = TS.eval_steps(FX.rollouts_with_tasks(spark, sf), 10)
    return E.eval_summary(score(rows, reward="hybrid"), ("run_id", "step"), "exact")


register("eval_summary_line", _EVAL_RW +
         " SELECT run_id, step, printf('Eval @ step %d: accuracy=%.1f%% mean_reward=%.4f avg_tokens=%.1f | correct:%d partial:%d "
         "failed:%d', step, " + ", ".join(rd(_EVAL_COLS[c]) for c in ("accuracy", "mean_reward", "avg_output_tokens")) + ", " +
         ", ".join(_EVAL_COLS[f"count_{c}"] for c in ("correct", "partial", "failed")) + ") AS line FROM rw GROUP BY run_id, step")(
    lambda spark, sf: M.eval_summary_line(_eval_summary(spark, sf).withColumns(
        {c: report_double(F.col(c)) for c in ("accuracy", "mean_reward", "avg_output_tokens")}))
)

_EXTRA_EVAL = {
    "format_accuracy": "100.0 * count_if(kind IN (1, 7)) / count(*)",
    "number_accuracy": "100.0 * count_if(x_equation IS NOT NULL AND x_equation <> '' AND x_numbers_ok) / count(*)",
}


def _eval_full(spark: SparkSession, sf: str) -> DataFrame:
    """Every tag of the trainers' evaluations, format metrics and the best accuracy so far included."""
    staged = stage_answers(TS.eval_steps(FX.rollouts_with_tasks(spark, sf), 10))
    formats = E.format_metrics(staged).select("run_id", "step", "format_accuracy", "number_accuracy")
    return M.with_best_accuracy(_eval_summary(spark, sf)).join(formats, ["run_id", "step"])


_EVAL_FULL_SQL = (
    _EVAL_RW + ", acc AS (SELECT run_id, step, " + _EVAL_COLS["accuracy"] + " AS a FROM rw GROUP BY run_id, step), "
    "top AS (SELECT run_id, step, greatest(0.0, max(a) OVER (PARTITION BY run_id ORDER BY step)) AS a FROM acc), "
    "ev AS (" + " UNION ALL ".join(
        f"SELECT run_id, step, 'eval/{k}' AS tag, {rd(v)} AS value, CAST(NULL AS VARCHAR) AS text FROM rw GROUP BY run_id, step"
        for k, v in (_EVAL_COLS | _EXTRA_EVAL).items()) +
    f" UNION ALL SELECT run_id, step, 'eval/best_accuracy' AS tag, {rd('a')} AS value, CAST(NULL AS VARCHAR) AS text FROM top) ")

register("eval_metrics_full", _EVAL_FULL_SQL + "SELECT * FROM ev")(
    lambda spark, sf: _rounded_long(M.eval_metrics_long(_eval_full(spark, sf)))
)

# --- S6, S8: written twice, read back ------------------------------------------------


def _metrics_retry(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluations of a training, written in two batches. The first attempt of each stops half-way, the second
    one is whole, and a third repeats it; the table read back holds every row once."""
    path = scratch_dir(spark, "metrics-table")
    rows = _rounded_long(M.eval_metrics_long(_eval_summary(spark, sf)))
    for batch, part in enumerate((F.col("step") % 20 == 0, F.col("step") % 20 != 0)):
        whole = rows.where(part)
        SK.write_metrics(whole.where(F.col("tag") < "eval/mean_reward"), path, "eval", batch)
        SK.write_metrics(whole, path, "eval", batch)
        SK.write_metrics(whole, path, "eval", batch)
    return SK.read_metrics(spark, path).select("run_id", "step", "tag", "value", "text", "writer", "batch")


register("metrics_table_retry", _EVAL_RW + ", lng AS (" + " UNION ALL ".join(
    f"SELECT run_id, step, 'eval/{k}' AS tag, {rd(v)} AS value, CAST(NULL AS VARCHAR) AS text FROM rw GROUP BY run_id, step"
    for k, v in _EVAL_COLS.items()) +
    ") SELECT *, 'eval' AS writer, CAST(CASE WHEN step % 20 = 0 THEN 0 ELSE 1 END AS BIGINT) AS batch FROM lng")(_metrics_retry)


def _manifest_retry(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "manifest-table")
    manifest = SK.checkpoint_manifest(M.new_bests(_history(spark, sf), init=0.0, chunk_steps=_CHUNK))
    SK.write_manifest(manifest.where(F.col("step") % 2 == 0), path, "trainer", 0)
    SK.write_manifest(manifest, path, "trainer", 0)
    out = SK.read_manifest(spark, path)
    return out.select("run_id", "category", "step", report_double(F.col("score")).alias("score"), "path")


# --- W4, W5, S8: best-so-far over a metric history ----------------------------------

_HIST = ("WITH h AS (SELECT user_id % 5 AS run_id, event_type AS category, event_id AS step, value AS score FROM events), "
         "w AS (SELECT *, max(score) OVER (PARTITION BY run_id, category ORDER BY step "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM h)\n")
_CHUNK = 1000  # small chunks so the fixture exercises the carried prefix


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return FX.metric_history(spark, sf)


# The first row of each (run, category) is its initial best; best_so_far_c starts from 0.
register("best_so_far_b", _HIST +
         f"SELECT run_id, category, step, {rd('score')} AS score, "
         f"{rd('CASE WHEN prev IS NULL THEN score ELSE greatest(prev, score) END')} AS best_score, "
         "prev IS NULL OR score > prev AS is_best FROM w")(
    lambda spark, sf: M.running_best(_history(spark, sf), init=None, chunk_steps=_CHUNK)
    .select("run_id", "category", "step", report_double(F.col("score")).alias("score"),
            report_double(F.col("best_score")).alias("best_score"), "is_best")
)

register("best_so_far_c", _HIST +
         f"SELECT run_id, category, step, {rd('score')} AS score FROM w WHERE score > greatest(coalesce(prev, 0.0), 0.0)")(
    lambda spark, sf: M.new_bests(_history(spark, sf), init=0.0, chunk_steps=_CHUNK)
    .select("run_id", "category", "step", report_double(F.col("score")).alias("score"))
)

register("final_best",
         "WITH h AS (SELECT user_id % 5 AS run_id, event_type AS category, event_id AS step, value AS score FROM events), "
         "b AS (SELECT run_id, category, max(score) AS best_score FROM h GROUP BY run_id, category)\n"
         f"SELECT b.run_id, b.category, {rd('b.best_score')} AS best_score, min(h.step) AS best_step FROM b JOIN h "
         "ON b.run_id = h.run_id AND b.category = h.category AND h.score = b.best_score "
         "GROUP BY b.run_id, b.category, b.best_score")(
    lambda spark, sf: M.final_best(_history(spark, sf)).select(
        "run_id", "category", report_double(F.col("best_score")).alias("best_score"), "best_step")
)

register("checkpoint_manifest", _HIST +
         f"SELECT run_id, category, step, {rd('score')} AS score, "
         "'./output/best_models/best_' || category || '_step_' || CAST(step AS VARCHAR) AS path "
         "FROM w WHERE score > greatest(coalesce(prev, 0.0), 0.0)")(
    lambda spark, sf: SK.checkpoint_manifest(M.new_bests(_history(spark, sf), init=0.0, chunk_steps=_CHUNK))
    .select("run_id", "category", "step", report_double(F.col("score")).alias("score"), "path")
)

register("manifest_table_retry", ORACLES["checkpoint_manifest"])(_manifest_retry)
