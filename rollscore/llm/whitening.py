"""Whitening of integer embeddings by a covariance weighted with multiplicities.

Equal vectors are grouped once (counts are partial on the map side), and every
later step works on the distinct ones: exact sums for the mean, a weighted
centred matrix product per batch for the covariance, and the projection. Only
d sums and d * d covariance entries reach the driver. The whitened vectors are
joined back to the rows by a 128-bit key of the vector and one of 64 parts of
the rows, so a vector that holds a third of all rows is spread over 64 groups.

Defined cases
* rows whose vector is null, or holds a null or non-finite entry, are left out;
  so are entries of 2**62 / scale or more, which no 64-bit integer holds;
* vectors of another length than the commonest one (ties: the longest), and
  empty ones, are left out: a covariance has one number of dimensions;
* rows that repeat, or have a null vec_id, are all kept;
* a component without variance (fewer distinct vectors than dimensions) cannot be
  scaled to one: its ``whitened`` is null and it takes no part in identity_error;
  ``explained`` is null when the vectors have no variance at all;
* a deviation beyond 64 bits is null;
* other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Workspace

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
PARTS = 64
LIMIT = 1 << 62

RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform; ``sums`` are exact, ``columns`` hold one component each, null ones left as zeros."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    columns: np.ndarray
    scaled: np.ndarray
    trace: float

    @property
    def count(self) -> int:
        return self.columns.shape[1]


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of every entry c, as 64-bit integers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(offset).cast("bigint"))


def _usable(vector: Column, scale: int) -> Column:
    def bad(c: Column) -> Column:
        c = c.cast("double")
        return c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(float(LIMIT // scale)))

    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def rows(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x, h1, h2, part) of the vectors that take part, before the choice of one length."""
    vector = F.col("embedding")
    usable = embeddings.select("vec_id", "embedding").where(_usable(vector, scale))
    out = usable.select("vec_id", integers(vector, scale, offset).alias("x"), F.monotonically_increasing_id().alias("__row"))
    return out.select(
        "vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"),
        F.pmod(F.xxhash64("vec_id", "__row"), F.lit(PARTS)).cast("int").alias("part"),
    )


def distinct_vectors(taken: DataFrame) -> DataFrame:
    """(x, w, parts): each distinct vector, its count and a bit for every part that holds it."""
    return taken.groupBy("x").agg(F.count(F.lit(1)).alias("w"), F.bit_or(F.expr("shiftleft(1L, part)")).alias("parts"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("w")).to_numpy(zero_copy_only=False)


def _exact_sums(groups: DataFrame, dims: int) -> list[int]:
    """Sum of w * x in every dimension, in unbounded integers."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for batch in batches:
            if not len(batch):
                continue
            x, w = _matrix(batch, "x"), _weights(batch)
            if int(np.abs(x).max()) * int(w.sum()) < LIMIT:
                part = w @ x
            else:
                part = w.astype(object) @ x.astype(object)
            total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(range(dims), pa.int32()),
            "part": pa.array([str(v) for v in total], pa.string()),
        })

    parts = groups.select("x", "w").mapInArrow(partial, "dim int, part string")
    found = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r.s) for r in sorted(found, key=lambda r: r.dim)]


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, exact: 64-bit where it fits, else unbounded integers."""
    reach = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
    if reach < LIMIT:
        return n * x - np.array(sums, dtype="int64")
    return n * x.astype(object) - np.array(sums, dtype=object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _deviations(x, n, sums).astype("float64") / n


def _squares(deviation: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; None beyond 64 bits."""
    largest = int(np.abs(deviation).max(initial=0))
    if largest * largest * deviation.shape[1] < 1 << 63:
        return (deviation * deviation).sum(axis=1).tolist()
    wide = deviation.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]


def _product(table: DataFrame, name: str, dims: int, n: int, centre) -> np.ndarray:
    """Sum over rows of w * c c^T / n for c = centre(row), one partial matrix per task."""
    upper = np.triu_indices(dims)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                c = centre(_matrix(batch, name))
                total += (c * (_weights(batch) / n)[:, None]).T @ c
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()), "v": pa.array(total[upper]),
        })

    parts = table.select(name, "w").mapInArrow(partial, "i int, j int, v double")
    out = np.zeros((dims, dims))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def fit(groups: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and leading components of the (x, w) table; its vectors have one length."""
    n, dims = groups.agg(F.sum("w"), F.max(F.size("x"))).first()
    sums = tuple(_exact_sums(groups, dims))
    covariance = _product(groups, "x", dims, n, lambda x: _centred(x, n, sums))
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    largest = np.abs(columns).argmax(axis=0)
    columns = columns * np.sign(columns[largest, np.arange(columns.shape[1])])
    scaled = values > max(values[0], 0.0) * dims * np.finfo("float64").eps
    factor = np.where(scaled, 1.0 / np.sqrt(np.where(scaled, values, 1.0)), 0.0)
    return Whitening(n, sums, values, columns * factor, scaled, trace)


def transform(groups: DataFrame, model: Whitening) -> DataFrame:
    """(h1, h2, parts, w, deviation, z): every distinct vector projected and scaled once."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            deviation = _deviations(_matrix(batch, "x"), model.n, model.sums)
            z = (deviation.astype("float64") / model.n) @ model.columns
            keep = [batch.column(batch.schema.get_field_index(c)) for c in ("h1", "h2", "parts", "w")]
            offsets = np.arange(0, z.size + 1, z.shape[1], dtype="int32")
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(_squares(deviation), pa.int64()), pa.ListArray.from_arrays(offsets, z.ravel())],
                names=["h1", "h2", "parts", "w", "deviation", "z"],
            )

    keyed = groups.select(F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"), "parts", "w", "x")
    return keyed.mapInArrow(project, "h1 bigint, h2 bigint, parts bigint, w bigint, deviation bigint, z array<double>")


def identity_error(white: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance (divisor n) minus the identity."""
    sums = white.select("w", F.posexplode("z").alias("k", "v")).groupBy("k").agg(F.sum(F.col("w") * F.col("v")).alias("s"))
    mean = np.zeros(model.count)
    for r in sums.collect():
        mean[r.k] = r.s / model.n
    covariance = _product(white, "z", model.count, model.n, lambda z: z - mean)
    keep = model.scaled
    wrong = np.abs(covariance - np.eye(model.count))[np.ix_(keep, keep)]
    return float(wrong.max(initial=0.0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    spark = embeddings.sparkSession
    ws = Workspace(spark, "whitening")
    taken = ws.save(rows(embeddings, scale, offset), "rows")  # stored: a row keeps its part in both uses
    lengths = taken.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    taken = taken.where(F.size("x") == lengths.d)
    groups = ws.save(distinct_vectors(taken), "groups")
    model = fit(groups, components)
    white = ws.save(transform(groups, model), "white")
    error = identity_error(white, model)
    parts = F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit("parts", p) == 1)
    spread = white.select("h1", "h2", F.explode(parts).alias("part"), "deviation", "z")
    joined = taken.select("vec_id", "h1", "h2", "part").join(spread, ["h1", "h2", "part"])
    share = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
    explained = F.array(*[F.lit(v).cast("double") for v in share])
    scaled = F.array(*[F.lit(bool(v)) for v in model.scaled])
    place = F.col("k") + 1
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("k", "v")).select(
        "vec_id", place.cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        F.when(F.element_at(scaled, place), F.col("v")).alias("whitened"),
        F.element_at(explained, place).alias("explained"), F.lit(error).alias("identity_error"),
    )
