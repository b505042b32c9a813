"""Pluggable tokenizers.

Token ids are normally an input column. When they must be computed, a
tokenizer runs as an Arrow UDF over batches of strings (one call per batch,
ids returned as ``ARRAY<INT>``), so the JVM/Python boundary is crossed per
batch, not per row. The default is whitespace splitting in native Spark
(F6), which needs no Python at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import as_col
from .text import NOT_WS, word_count

EncodeBatch = Callable[[Sequence[str | None]], Sequence[Sequence[int] | None]]


def arrow_tokenizer(encode_batch: EncodeBatch) -> Callable[[Column], Column]:
    """Wrap ``encode_batch(list_of_texts) -> list_of_id_lists`` (for example a
    fast tokenizer's batch encoder) as a Column function."""

    def run(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        ids = encode_batch(texts.to_pylist())
        return pa.array(ids, type=pa.list_(pa.int32()))

    udf = F.arrow_udf(run, T.ArrayType(T.IntegerType()))
    return lambda text: udf(as_col(text))


def whitespace_tokens(text) -> Column:
    """Default tokenizer: maximal non-whitespace runs (same split as F6)."""
    return F.regexp_extract_all(as_col(text), F.lit(NOT_WS + "+"), 0)


def output_token_count(text, tokenizer: Callable[[Column], Column] | None = None) -> Column:
    """number of tokens of a response; whitespace words by default."""
    if tokenizer is None:
        return word_count(text)
    return F.size(tokenizer(as_col(text)))
