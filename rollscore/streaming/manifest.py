"""ST3: best checkpoints tracked over a stream, on a stored manifest.

The rows that set a new best form a table small enough to be the whole state:
the new bests of (all rows so far) are the new bests of (the stored ones and
the new rows). Each micro-batch is merged by the same chunked scan that the
batch operator uses (no key is gathered in one task), so the manifest equals
the batch result over everything that has arrived, in any order of arrival. A
late row may therefore take back a stored best; late rows are counted per key.
A micro-batch may hold several arrivals (column ``arrival``, ascending): a row is
late when an earlier arrival, of this micro-batch or merged before, had its step
or a later one, so the counts do not depend on how arrivals are batched.

The manifest is versioned. A version is committed by the log that is written
last and holds the last merged batch of each stream, so a batch that is
retried, by Spark or after a restart, is merged once, and a new stream goes on
from the manifest it finds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layout import join_small
from ..operators.metrics import DEFAULT_CHUNK_STEPS, new_bests

KEYS = ("run_id", "category")
ARRIVAL = "arrival"
_LONG, _TEXT = T.LongType(), T.StringType()
BESTS = T.StructType().add("run_id", _LONG).add("category", _TEXT).add("step", _LONG).add("score", T.DoubleType())
SEEN = T.StructType().add("run_id", _LONG).add("category", _TEXT).add("last_step", _LONG).add("n_rows", _LONG).add("n_late", _LONG)
LOG = T.StructType().add("stream", _TEXT).add("batch", _LONG)


class BestManifest:
    """New bests per (run_id, category), with a version for each merged micro-batch below ``path``."""

    def __init__(self, spark: SparkSession, path: str, init: float | None = 0.0, chunk_steps: int = DEFAULT_CHUNK_STEPS):
        self.spark, self.path, self.init, self.chunk_steps = spark, path.rstrip("/"), init, chunk_steps

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        root, fs = self._fs()
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        numbers = sorted(int(m.group(1)) for m in (re.fullmatch(r"version=(\d+)", n) for n in names) if m)
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return [v for v in numbers if fs.exists(done(f"{self.path}/version={v}/log/_SUCCESS"))]

    def _table(self, name: str, schema: T.StructType, version: int | None = None) -> DataFrame:
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/version={version}/{name}")

    def bests(self) -> DataFrame:
        """(run_id, category, step, score): the new bests of all rows merged so far."""
        return self._table("bests", BESTS)

    def seen(self) -> DataFrame:
        """(run_id, category, last_step, n_rows, n_late): rows merged per key, and those that came after a later step."""
        return self._table("seen", SEEN)

    def merge(self, batch: DataFrame, stream: str, number: int) -> bool:
        """Merge batch ``number`` of ``stream``; False when it is already in the manifest."""
        have = self.versions()
        last = have[-1] if have else None
        log = self._table("log", LOG, last) if have else self.spark.createDataFrame([], LOG)
        if log.where((F.col("stream") == stream) & (F.col("batch") >= number)).head(1):
            return False
        arrival = F.col(ARRIVAL) if ARRIVAL in batch.columns else F.lit(0)
        arrived = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BESTS], arrival.cast("bigint").alias(ARRIVAL))
        rows = arrived.drop(ARRIVAL)
        bests = self._table("bests", BESTS, last) if have else self.spark.createDataFrame([], BESTS)
        seen = self._table("seen", SEEN, last) if have else self.spark.createDataFrame([], SEEN)
        folder = f"{self.path}/version={(last if have else -1) + 1}"
        merged = new_bests(bests.unionByName(rows), init=self.init, chunk_steps=self.chunk_steps).select(*BESTS.fieldNames())
        merged.write.mode("overwrite").parquet(f"{folder}/bests")
        earlier = Window.partitionBy(*KEYS).orderBy(ARRIVAL).rowsBetween(Window.unboundedPreceding, -1)
        ends = arrived.groupBy(*KEYS, ARRIVAL).agg(F.max("step").alias("end"))
        ends = ends.select(*KEYS, ARRIVAL, F.max("end").over(earlier).alias("end")).join(seen.select(*KEYS, "last_step"), list(KEYS), "left")
        ends = ends.select(*KEYS, ARRIVAL, F.greatest("end", "last_step").alias("last_step"))
        before = join_small(arrived, ends, [*KEYS, ARRIVAL], by="step", how="left")
        late = F.count_if(F.col("step") <= F.col("last_step"))
        new = before.groupBy(*KEYS).agg(F.max("step").alias("last_step"), F.count(F.lit(1)).alias("n_rows"), late.alias("n_late"))
        total = seen.unionByName(new).groupBy(*KEYS).agg(
            F.max("last_step").alias("last_step"), F.sum("n_rows").alias("n_rows"), F.sum("n_late").alias("n_late"))
        total.write.mode("overwrite").parquet(f"{folder}/seen")
        entry = self.spark.createDataFrame([(stream, number)], LOG)
        log.where(F.col("stream") != stream).unionByName(entry).write.mode("overwrite").parquet(f"{folder}/log")
        self._forget(have[:-1])
        return True

    def _forget(self, versions: list[int]) -> None:
        """Delete versions older than the one just replaced, which readers may still hold."""
        _, fs = self._fs()
        for v in versions:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={v}"), True)

    def sink(self, stream: str) -> Callable[[DataFrame, int], None]:
        """The ``foreachBatch`` function of one stream (its name must outlive restarts, as its checkpoint does)."""

        def run(batch: DataFrame, number: int) -> None:
            self.merge(batch, stream, number)

        return run


def track_best(history: DataFrame, manifest: BestManifest, stream: str, checkpoint: str) -> None:
    """Run a stream of (run_id, category, step, score) over everything available into the manifest."""
    q = (history.writeStream.foreachBatch(manifest.sink(stream)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
