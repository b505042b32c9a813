"""Token-array functions (T1-T7, G12) as native higher-order functions.

Token ids stay one array per row: no explode into B x T rows, no shuffle of
token positions. Token ids themselves are an input (or come from a
pluggable tokenizer UDF); BPE internals are not rebuilt here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, lit_or_col

IGNORE_INDEX = -100


def concat_tokens(prompt_ids, output_ids) -> Column:
    """Prompt tokens followed by output tokens."""
    return F.concat(as_col(prompt_ids), as_col(output_ids))


def token_count(prompt_ids, output_ids) -> Column:
    """The size of T1's tokens, from the sizes of its parts."""
    p, o = as_col(prompt_ids), as_col(output_ids)
    missing = F.size(F.lit(None).cast("array<int>"))
    return F.when(p.isNull() | o.isNull(), missing).otherwise(F.size(p) + F.size(o))


def shift_inputs(tokens) -> Column:
    """``tokens[:-1]``."""
    t = as_col(tokens)
    return F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))


def shift_labels(tokens) -> Column:
    """``tokens[1:]``."""
    t = as_col(tokens)
    return F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))


def pad_right(values, width, pad) -> Column:
    """Right-pad to ``width`` with ``pad`` (no-op when already wider)."""
    v = as_col(values)
    w = lit_or_col(width)
    return F.concat(v, F.array_repeat(lit_or_col(pad), F.greatest(w - F.size(v), F.lit(0))))


def truncate(values, width) -> Column:
    """T5: keep the first ``width`` entries."""
    v = as_col(values)
    w = lit_or_col(width)
    return F.when(F.size(v) > w, F.slice(v, F.lit(1), w)).otherwise(v)


def response_mask(prompt_len, seq_len, width) -> Column:
    """T4: True on positions ``[prompt_len - 1, seq_len - 1)`` of a row of
    ``width`` positions; all False when that range is empty."""
    p, n, w = lit_or_col(prompt_len), lit_or_col(seq_len), lit_or_col(width)
    width_ = F.greatest(w, F.lit(0))
    start = F.least(F.greatest(p - 1, F.lit(0)), width_)
    end = F.least(F.greatest(n - 1, start), width_)
    runs = F.concat(F.array_repeat(F.lit(False), start), F.array_repeat(F.lit(True), end - start),
                    F.array_repeat(F.lit(False), width_ - end))
    # A length that is NULL leaves the positions it decides NULL.
    each = F.transform(F.array_repeat(F.lit(False), width_), lambda _, i: (i >= p - 1) & (i < n - 1))
    return F.when(p.isNull() | n.isNull(), each).otherwise(runs)


def attention_mask(n_real, width) -> Column:
    """T5: 1 for real tokens, 0 for right padding."""
    k = F.least(lit_or_col(n_real), lit_or_col(width))
    return F.concat(F.array_repeat(F.lit(1), k), F.array_repeat(F.lit(0), lit_or_col(width) - k))


def prompt_masked_labels(input_ids, prompt_len, pad_id, ignore: int = IGNORE_INDEX) -> Column:
    """``ignore`` on prompt positions and wherever the id is the pad id.

    A prompt longer than the row is clamped to the row (the reference's
    slice assignment would grow the list and then fail)."""
    p, pad = lit_or_col(prompt_len), lit_or_col(pad_id)
    return F.transform(
        as_col(input_ids), lambda x, i: F.when((i < p) | (x == pad), F.lit(ignore)).otherwise(x)
    )


def count_ignored(labels, ignore: int = IGNORE_INDEX) -> Column:
    """Number of masked label positions."""
    return F.size(F.filter(as_col(labels), lambda x: x == F.lit(ignore)))


def ids_text(ids, sep: str = ",") -> Column:
    """Render an id array as text (reports, comparisons)."""
    return F.array_join(as_col(ids).cast("array<string>"), sep)


def mask_text(mask) -> Column:
    """Render a boolean mask as a string of 0/1."""
    return F.array_join(as_col(mask).cast("array<int>").cast("array<string>"), "", "0")
