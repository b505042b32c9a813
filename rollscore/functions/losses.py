"""Per-token loss functions (T8-T13) on log-prob / logit arrays, and the
learning-rate factor (P16). Native higher-order functions, one row per
sequence; nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, lit_or_col

LOG_RATIO_CLAMP = 20.0


def _logsumexp_parts(z: Column) -> tuple[Column, Column]:
    """(max, log(sum(exp(z - max)))) of a DOUBLE array."""
    m = F.array_max(z)
    s = F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - m))
    return m, F.log(s)


def log_softmax(logits) -> Column:
    """``x - max - log(sum(exp(z - max)))`` for every entry."""
    z = F.transform(as_col(logits), lambda x: x.cast("double"))
    m, ls = _logsumexp_parts(z)
    return F.transform(z, lambda x: x - m - ls)


def label_log_prob(logits, label) -> Column:
    """T9 fused with T8: log-probability of the 0-based ``label``."""
    z = F.transform(as_col(logits), lambda x: x.cast("double"))
    m, ls = _logsumexp_parts(z)
    return F.try_element_at(z, lit_or_col(label) + 1) - m - ls


def log_ratio(policy_lp, old_lp, clamp: float | None = None) -> Column:
    """``policy - old`` per token, optionally clamped to ``[-clamp, clamp]``."""
    d = F.zip_with(as_col(policy_lp), as_col(old_lp), lambda a, b: a - b)
    if clamp is None:
        return d
    return F.transform(d, lambda x: F.least(F.greatest(x, F.lit(-clamp)), F.lit(clamp)))


def prob_ratio(policy_lp, old_lp, clamp: float | None = None) -> Column:
    """``exp(policy - old)``; the stabilised variant clamps the log-ratio."""
    return F.transform(log_ratio(policy_lp, old_lp, clamp), lambda x: F.exp(x))


def clipped_surrogate(advantage, ratio, clip_range) -> Column:
    """``-min(A * r, A * clip(r, 1 - c, 1 + c))`` per token."""
    a, c = lit_or_col(advantage), lit_or_col(clip_range)
    return F.transform(
        as_col(ratio),
        lambda r: -F.least(a * r, a * F.least(F.greatest(r, F.lit(1.0) - c), F.lit(1.0) + c)),
    )


def kl_per_token(policy_lp, ref_lp) -> Column:
    """``policy - reference`` log-probs."""
    return F.zip_with(as_col(policy_lp), as_col(ref_lp), lambda a, b: a - b)


def add_kl(loss, kl, kl_coef: float) -> Column:
    """``loss + kl_coef * kl`` per token (off when the coefficient is 0)."""
    if not kl_coef:
        return as_col(loss)
    return F.zip_with(as_col(loss), as_col(kl), lambda x, k: x + F.lit(float(kl_coef)) * k)


def masked_sum(values, mask) -> Column:
    return F.aggregate(
        F.zip_with(as_col(values), as_col(mask), lambda x, k: F.when(k, x).otherwise(F.lit(0.0))),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def masked_count(mask) -> Column:
    return F.size(F.filter(as_col(mask), lambda k: k))


def masked_mean(values, mask) -> Column:
    """T12a per sequence: masked sum / max(masked count, 1)."""
    return masked_sum(values, mask) / F.greatest(masked_count(mask), F.lit(1)).cast("double")


def masked_mean_constant(values, mask, num_tokens) -> Column:
    """T12b per sequence (DR-GRPO): masked sum / a constant length."""
    return masked_sum(values, mask) / lit_or_col(num_tokens).cast("double")


def lr_factor(step, warmup_steps) -> Column:
    """``min(1, step / max(1, warmup))``. With warmup 0 the factor is 0
    at step 0, as in the reference."""
    s, w = lit_or_col(step), lit_or_col(warmup_steps)
    return F.least(F.lit(1.0), s.cast("double") / F.greatest(F.lit(1), w).cast("double"))
