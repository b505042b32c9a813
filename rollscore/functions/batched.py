"""A batched map over a table, with new and removed columns.

The function gets record batches (at most ``max_rows`` rows and about ``max_bytes`` bytes) and returns the new columns;
all others are passed on unchanged, and removed columns never cross back to the JVM. The result's schema is derived
from the input's, so it is known without running anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MapBatch = Callable[[pa.RecordBatch], Mapping[str, pa.Array | Sequence]]


def slices(batch: pa.RecordBatch, max_rows: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into parts of bounded rows and bytes; a row larger than the bound is a part of its own."""
    if len(batch) <= max_rows and (batch.nbytes <= max_bytes or len(batch) <= 1):
        yield batch
        return
    half = min(max_rows, max(len(batch) // 2, 1))
    yield from slices(batch.slice(0, half), max_rows, max_bytes)
    yield from slices(batch.slice(half), max_rows, max_bytes)


def batched_map(df: DataFrame, fn: MapBatch, new: T.StructType, remove: Sequence[str] = (), reads: Sequence[str] | None = None,
                max_rows: int = 1000, max_bytes: int = 64 << 20) -> DataFrame:
    """``df`` without the columns ``remove`` and with those of ``new``, which ``fn(batch)`` returns, one entry per row.

    A new column replaces an input column of its name. ``reads`` limits what the function sees to these columns (all
    when None); a column that it neither reads nor keeps does not reach Python."""
    unknown = [c for c in [*remove, *(reads or ())] if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    added = [f.name for f in new]
    kept = [f for f in df.schema if f.name not in remove and f.name not in added]
    seen = list(df.columns) if reads is None else list(reads)
    names = [c for c in df.columns if c in seen or c in [f.name for f in kept]]
    out = T.StructType(kept + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = {f.name: to_arrow_type(f.dataType) for f in new}
        for whole in batches:
            for batch in slices(whole, max_rows, max_bytes):
                made = fn(batch.select(seen))
                missing = [c for c in added if c not in made]
                if missing:
                    raise ValueError(f"the function returned no {missing}")
                columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
                for c in added:
                    values = made[c]
                    column = values.cast(kinds[c]) if isinstance(values, pa.Array) else pa.array(values, kinds[c])
                    if len(column) != len(batch):
                        raise ValueError(f"column {c!r}: {len(column)} entries for {len(batch)} rows")
                    columns.append(column)
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in out])

    return df.select(*[F.col(c) for c in names]).mapInArrow(run, out)
