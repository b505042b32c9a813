"""Sequence and step losses.

Per-token work stays in arrays on each row; steps are combined with partial
aggregations, the ratio statistics by merging the moments of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import losses as L

STEP_KEYS = ("run_id", "step")
LOSS_TYPES = ("grpo", "dr_grpo")


def sequence_losses(
    df: DataFrame,
    policy_lp: str = "policy_log_probs",
    old_lp: str = "old_log_probs",
    mask: str = "response_mask",
    advantage: str = "advantage",
    clip_range: float = 0.2,
    loss_type: str = "grpo",
    max_completion_length: int = 256,
    gradient_accumulation_steps: int = 1,
    clamp_log_ratio: bool = False,
    ref_lp: str | None = None,
    kl_coef: float = 0.0,
) -> DataFrame:
    """Adds ``seq_loss`` (T11 -> optional T13 -> T12 per sequence, divided by
    the accumulation steps) and ``seq_kl`` (masked mean KL, when a reference
    is given).

    T14: ``loss_type`` is ``grpo`` (masked mean) or ``dr_grpo`` (masked sum
    over a constant length); anything else raises ``ValueError``.
    """
    if loss_type not in LOSS_TYPES:
        raise ValueError(f"Unknown loss type: {loss_type}")
    clamp = L.LOG_RATIO_CLAMP if clamp_log_ratio else None
    ratio = L.prob_ratio(F.col(policy_lp), F.col(old_lp), clamp)
    per_token = L.clipped_surrogate(F.col(advantage), ratio, F.lit(float(clip_range)))
    out = df
    if ref_lp is not None and kl_coef:
        out = out.withColumn("__kl", L.kl_per_token(F.col(policy_lp), F.col(ref_lp)))
        per_token = L.add_kl(per_token, F.col("__kl"), kl_coef)
        out = out.withColumn("seq_kl", L.masked_mean(F.col("__kl"), F.col(mask)))
    reduce = (
        L.masked_mean(per_token, F.col(mask))
        if loss_type == "grpo"
        else L.masked_mean_constant(per_token, F.col(mask), F.lit(max_completion_length))
    )
    out = out.withColumn("seq_loss", reduce / F.lit(float(gradient_accumulation_steps)))
    return out.drop("__kl")


def batch_loss(seqs: DataFrame, keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """Mean of the per-sequence losses."""
    return seqs.groupBy(*keys).agg(F.avg("seq_loss").alias("loss"), F.count(F.lit(1)).alias("num_sequences"))


def step_loss(
    seqs: DataFrame,
    keys: Sequence[str] = STEP_KEYS,
    micro: str = "micro_batch",
    rescale: bool = True,
) -> DataFrame:
    """Micro-batch losses (mean over their sequences, already divided by
    the accumulation steps) summed per step, then divided by the number of
    micro-batches (``rescale=False`` keeps the plain sum, as one trainer does)."""
    per_micro = seqs.groupBy(*keys, micro).agg(F.avg("seq_loss").alias("micro_loss"))
    total = F.sum("micro_loss")
    n = F.count(F.lit(1))
    loss = total / n.cast("double") if rescale else total
    return per_micro.groupBy(*keys).agg(loss.alias("step_loss"), n.alias("num_micro_batches"))


def array_moments(values: Column) -> Column:
    """(n, mean, m2, min, max) of the entries of an array that are not NULL; m2 = sum of squared deviations (Welford)."""
    kept = F.filter(values, lambda x: x.isNotNull())
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(s: Column, x: Column) -> Column:
        n = s["n"] + 1
        mean = s["mean"] + (x - s["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (s["m2"] + (x - s["mean"]) * (x - mean)).alias("m2"))

    moments = F.aggregate(kept, start, add)
    return F.struct(moments["n"].alias("n"), moments["mean"].alias("mean"), moments["m2"].alias("m2"),
                    F.array_min(kept).alias("min"), F.array_max(kept).alias("max"))


def merge_moments(rows: DataFrame, keys: Sequence[str], ratio: str = "ratio", log: str = "log") -> DataFrame:
    """The moments of rows merged per group by Chan's formula, in one pass over the rows: rows of one length weigh the
    same, so Spark's own moments of their means are exact weights of the merge; the few lengths of a group (never more
    than the longest row) then meet in a window. Columns: n, mean, std, min, max and log_mean, log_max."""
    m, g = F.col(ratio), F.col(log)
    by_length = rows.groupBy(*keys, m["n"].alias("__length")).agg(
        (F.count(F.lit(1)) * F.col("__length")).alias("__n"), F.avg(m["mean"]).alias("__mean"),
        (F.sum(m["m2"]) + F.col("__length") * F.count(F.lit(1)) * F.var_pop(m["mean"])).alias("__m2"),
        F.min(m["min"]).alias("__min"), F.max(m["max"]).alias("__max"),
        F.avg(g["mean"]).alias("__log"), F.max(g["max"]).alias("__log_max"))
    n, w = F.col("__n"), Window.partitionBy(*keys)
    centred = by_length.withColumn("__all", F.sum(n * F.col("__mean")).over(w) / F.sum(n).over(w))
    total = F.sum(F.col("__m2") + n * F.pow(F.col("__mean") - F.col("__all"), F.lit(2.0)))
    return centred.groupBy(*keys).agg(
        F.sum(n).alias("n"), F.max("__all").alias("mean"), F.when(F.sum(n) > 1, F.sqrt(total / (F.sum(n) - 1))).alias("std"),
        F.min("__min").alias("min"), F.max("__max").alias("max"),
        (F.sum(n * F.col("__log")) / F.sum(n)).alias("log_mean"), F.max("__log_max").alias("log_max"))


def ratio_stats(
    df: DataFrame,
    policy_lp: str = "policy_log_probs",
    old_lp: str = "old_log_probs",
    keys: Sequence[str] = STEP_KEYS,
    mask: str | None = None,
    clamp_log_ratio: bool = False,
) -> DataFrame:
    """Ratio mean, sample std, min, max and log-ratio mean, max over
    all positions (``mask`` restricts to masked positions). Groups without
    any position are left out.

    Each row keeps the moments of its own positions; they are merged per
    group without reading the rows again."""
    clamp = L.LOG_RATIO_CLAMP if clamp_log_ratio else None
    lr = L.log_ratio(F.col(policy_lp), F.col(old_lp), clamp)
    if mask:
        pairs = F.filter(F.arrays_zip(lr.alias("lr"), F.col(mask).alias("m")), lambda z: F.coalesce(z["m"], F.lit(False)))
        lr = F.transform(pairs, lambda z: z["lr"])
    rows = df.select(*keys, lr.alias("lr")).select(
        *keys, array_moments(F.transform("lr", lambda x: F.exp(x))).alias("ratio"), array_moments(F.col("lr")).alias("log"))
    rows = rows.where(F.col("ratio.n") > 0)
    out = merge_moments(rows, keys)
    return out.select(*keys, F.col("mean").alias("ratio_mean"), F.col("std").alias("ratio_std"), F.col("min").alias("ratio_min"),
                      F.col("max").alias("ratio_max"), F.col("log_mean").alias("log_ratio_mean"), F.col("log_max").alias("log_ratio_max"))


def kl_per_step(seqs: DataFrame, keys: Sequence[str] = STEP_KEYS) -> DataFrame:
    """Mean of the per-sequence masked KL per step."""
    return seqs.groupBy(*keys).agg(F.avg("seq_kl").alias("kl_mean"))
