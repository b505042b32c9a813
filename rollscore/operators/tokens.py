"""Token batches for training (T1-T4) and fine-tuning rows.

Padding width is a per-batch maximum. It is computed with a partial
aggregation and attached back by key (one small row per batch, broadcast by
Catalyst when it is small), never with a window that would pull a whole
batch into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as TK
from .groupstats import with_group_stats

BATCH_KEYS = ("run_id", "step")


def token_batch(
    df: DataFrame,
    prompt_ids: str = "prompt_ids",
    output_ids: str = "output_ids",
    eos_id: int = 0,
    batch_keys: Sequence[str] = BATCH_KEYS,
) -> DataFrame:
    """Adds ``prompt_len``, ``seq_len``, ``width``, ``input_ids``, ``labels``,
    ``response_mask`` (all rows of a batch share ``width = max seq_len - 1``)."""
    with_len = df.select(
        "*", F.size(F.col(prompt_ids)).alias("prompt_len"), TK.token_count(prompt_ids, output_ids).alias("seq_len")
    )
    batched = with_group_stats(with_len, batch_keys, {"width": F.max("seq_len") - 1})
    # Joined ids are made after the join, so that they are no second copy of the ids in its shuffle.
    batched = batched.withColumn("__tokens", TK.concat_tokens(F.col(prompt_ids), F.col(output_ids)))
    w = F.greatest(F.col("width"), F.lit(0))
    return batched.select(
        *[c for c in batched.columns if c != "__tokens"],
        TK.pad_right(TK.shift_inputs("__tokens"), w, F.lit(eos_id)).alias("input_ids"),
        TK.pad_right(TK.shift_labels("__tokens"), w, F.lit(eos_id)).alias("labels"),
        TK.response_mask(F.col("prompt_len"), F.col("seq_len"), w).alias("response_mask"),
    )


def fixed_width_rows(
    df: DataFrame,
    token_ids: str = "token_ids",
    prompt_len: str = "prompt_len",
    width: int = 512,
    pad_id: int = 0,
    mask_prompt: bool = True,
) -> DataFrame:
    """T5-T7 + G12: truncate/pad to ``width``; labels masked on the prompt and
    padding (T6) or a plain copy of the inputs (T7)."""
    ids = TK.pad_right(TK.truncate(F.col(token_ids), width), F.lit(width), F.lit(pad_id))
    out = df.select(
        "*",
        ids.alias("input_ids"),
        TK.attention_mask(F.size(F.col(token_ids)), F.lit(width)).alias("attention_mask"),
    )
    labels = (
        TK.prompt_masked_labels(F.col("input_ids"), F.col(prompt_len), F.lit(pad_id))
        if mask_prompt
        else F.col("input_ids")
    )
    out = out.withColumn("labels", labels)
    return out.withColumn("n_masked", TK.count_ignored("labels"))
