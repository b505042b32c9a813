"""Per-step metrics, the long metrics table, best-so-far tracking and final
best selection (M1-M4, W4, W5).

Best-so-far is a prefix maximum per (run, category) ordered by step. A plain
ordered window would put a whole run's history in one task, so the scan is
split: steps are cut into chunks, chunk maxima (small) get an exclusive
prefix maximum, and each chunk then scans only its own rows. Every window
holds at most ``chunk_steps`` rows (or one row per chunk), whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decimals import fixed
from ..sources.sinks import metrics_long

STEP_KEYS = ("run_id", "step")
DEFAULT_CHUNK_STEPS = 1 << 20

# The tags of the metrics table.
TRAIN_TAGS = {
    "loss": "train/loss",
    "grad_norm": "train/grad_norm",
    "reward_mean": "train/reward_mean",
    "reward_std": "train/reward_std",
    "avg_output_tokens": "train/avg_output_tokens",
}
EVAL_TAGS = {
    "accuracy": "eval/accuracy",
    "mean_reward": "eval/mean_reward",
    "std_reward": "eval/std_reward",
    "avg_output_tokens": "eval/avg_output_tokens",
    "count_correct": "eval/count_correct",
    "count_partial": "eval/count_partial",
    "count_failed": "eval/count_failed",
}
# Logged by some of the trainers only; used when the summary has the column.
EVAL_EXTRA_TAGS = {
    "format_accuracy": "eval/format_accuracy",
    "number_accuracy": "eval/number_accuracy",
    "best_accuracy": "eval/best_accuracy",
}


def train_step_metrics(
    seqs: DataFrame,
    keys: Sequence[str] = STEP_KEYS,
    micro: str = "micro_batch",
    rescale: bool = True,
    grad_norm: DataFrame | None = None,
) -> DataFrame:
    """M1: step loss (G11), reward mean / population std / max / min (G4) and
    average output tokens (G7) per step, in one pass over ``seqs``.

    Each row first gets its micro-batch loss from a window over the
    micro-batch (bounded: at most micro-size rows). A micro-batch of k rows
    then contributes ``loss / k`` from each row and ``1 / k`` to the
    micro-batch count, so one partial aggregation per step yields the sum of
    micro-batch losses, their number and the reward statistics together."""
    r = F.col("reward").cast("double")
    w = Window.partitionBy(*keys, micro)
    rows = seqs.select(
        *keys, r.alias("__r"), F.col("output_tokens").cast("double").alias("__tok"),
        (F.avg("seq_loss").over(w) / F.count(F.lit(1)).over(w)).alias("__share"),
        (F.lit(1.0) / F.count(F.lit(1)).over(w)).alias("__unit"),
    )
    total = F.sum("__share")
    out = rows.groupBy(*keys).agg(
        (total / F.round(F.sum("__unit")) if rescale else total).alias("loss"),
        F.avg("__r").alias("reward_mean"), F.stddev_pop("__r").alias("reward_std"),
        F.max("__r").alias("reward_max"), F.min("__r").alias("reward_min"),
        F.coalesce(F.avg("__tok"), F.lit(0.0)).alias("avg_output_tokens"),
    )
    if grad_norm is not None:
        out = out.join(grad_norm.select(*keys, "grad_norm"), list(keys), "left")
    else:
        out = out.withColumn("grad_norm", F.lit(None).cast("double"))
    return out


def train_metrics_long(step_metrics: DataFrame, keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """M1 -> S6 rows ``(run_id, step, tag, value, text)``; NULL values dropped."""
    tags = {c: t for c, t in TRAIN_TAGS.items() if c in step_metrics.columns}
    return metrics_long(step_metrics, tags, keys).where(F.col("value").isNotNull())


def grad_norm_per_step(norms: DataFrame, keys: Sequence[str] = STEP_KEYS, norm: str = "norm") -> DataFrame:
    """M1: the global gradient norm of a step, the 2-norm over its parameters' norms (one row per step and parameter)."""
    return norms.groupBy(*keys).agg(F.sqrt(F.sum(F.pow(F.col(norm).cast("double"), F.lit(2.0)))).alias("grad_norm"))


def with_best_accuracy(summary: DataFrame, run: str = "run_id", step: str = "step") -> DataFrame:
    """M2: ``best_accuracy`` of each run up to and with each eval step (0 before any), in the chunked scan of W4."""
    one = summary.withColumn("__all", F.lit(0))
    best = running_best(one, keys=(run, "__all"), step=step, score="accuracy", init=0.0)
    return best.withColumnRenamed("best_score", "best_accuracy").drop("__all", "prev_best", "is_best")


def eval_metrics_long(summary: DataFrame, keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """M2 -> S6 rows (written at every eval step, a superset of the reference)."""
    extra = {c: t for c, t in EVAL_EXTRA_TAGS.items() if c in summary.columns}
    return metrics_long(summary, EVAL_TAGS | extra, keys)


def _line(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def train_summary_line(step_metrics: DataFrame) -> DataFrame:
    """M3: the per-step console line of training, rounded as Python rounds; a missing gradient norm prints ``nan``."""
    c = F.col
    norm = F.coalesce(c("grad_norm"), F.lit(float("nan")))
    line = _line(
        "Step ", c("step").cast("string"), " | Loss: ", fixed("loss", 4), " | Grad norm: ", fixed(norm, 4),
        " | Reward mean: ", fixed("reward_mean", 4), " | Reward std: ", fixed("reward_std", 4),
        " | Avg output tokens: ", fixed("avg_output_tokens", 1))
    return step_metrics.select("run_id", "step", line.alias("line"))


def eval_summary_line(summary: DataFrame) -> DataFrame:
    """M3: the console line of an evaluation."""
    c = F.col
    count = {n: c(f"count_{n}").cast("string") for n in ("correct", "partial", "failed")}
    line = _line(
        "Eval @ step ", c("step").cast("string"), ": accuracy=", fixed("accuracy", 1), "% mean_reward=", fixed("mean_reward", 4),
        " avg_tokens=", fixed("avg_output_tokens", 1), " | correct:", count["correct"], " partial:", count["partial"],
        " failed:", count["failed"])
    return summary.select("run_id", "step", line.alias("line"))


def metrics_wide(long: DataFrame, tags: Sequence[str], keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """M4: step x tag view. Tags are listed up front so the pivot needs no
    extra pass to discover them."""
    return long.groupBy(*keys).pivot("tag", list(tags)).agg(F.first("value", ignorenulls=True))


def _number(score: str) -> Column:
    """The score; NULL where it is NaN, which is never better than another and never beaten."""
    s = F.col(score).cast("double")
    return F.when(~F.isnan(s), s)


def running_best(
    history: DataFrame,
    keys: Sequence[str] = ("run_id", "category"),
    step: str = "step",
    score: str = "score",
    init: float | None = 0.0,
    chunk_steps: int = DEFAULT_CHUNK_STEPS,
) -> DataFrame:
    """Adds ``prev_best`` (max of earlier scores, NULL if none),
    ``best_score`` (running best after this row) and ``is_best`` (strict
    improvement, like ``if score > best``).

    ``init`` is the starting best (0.0 in two trainers). ``init=None`` makes
    the first row of each group the initial best (it counts as saved, as the
    stabilised trainer saves its initial model)."""
    s = _number(score)
    chunk = F.floor(F.col(step) / F.lit(chunk_steps)).cast("bigint")
    with_chunk = history.withColumn("__chunk", chunk)
    chunk_max = with_chunk.groupBy(*keys, "__chunk").agg(F.max(s).alias("__cmax"))
    wc = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunk_max.select(*keys, "__chunk", F.max("__cmax").over(wc).alias("__carry"))
    joined = with_chunk.join(carry, [*keys, "__chunk"], "left")
    wi = Window.partitionBy(*keys, "__chunk").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.greatest(F.col("__carry"), F.max(s).over(wi))
    out = joined.withColumn("prev_best", prev)
    if init is None:
        best_before = F.col("prev_best")
        is_best = s.isNotNull() & (best_before.isNull() | (s > best_before))
    else:
        best_before = F.greatest(F.col("prev_best"), F.lit(float(init)))
        is_best = s > best_before
    return out.select(
        *[c for c in history.columns], "prev_best",
        F.greatest(best_before, s).alias("best_score"),
        F.coalesce(is_best, F.lit(False)).alias("is_best"),
    )


def new_bests(history: DataFrame, **kw) -> DataFrame:
    """W4 checkpoints: only the rows that set a new best."""
    return running_best(history, **kw).where(F.col("is_best"))


def final_best(history: DataFrame, keys: Sequence[str] = ("run_id", "category"), step: str = "step",
               score: str = "score") -> DataFrame:
    """Best score per group and the earliest step that reached it."""
    s = _number(score)
    key: Column = F.when(s.isNotNull(), F.struct(-s, F.col(step)))
    return history.groupBy(*keys).agg(
        F.max(s).alias("best_score"),
        F.min_by(F.col(step), key).alias("best_step"),
    )
