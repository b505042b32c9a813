"""Spark session helpers.

Library code never builds a session; it receives one. These helpers exist for
tests, the benchmark and command-line jobs, and they only fill in settings
that the cluster has not already chosen.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the jobs in this package. Applied only where neither
# spark-submit, nor spark-defaults.conf, nor a running session has chosen one.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot keys (one task, one run, one equation holding a large share of the
    # rows) are split at runtime by AQE's skew-join handling.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _missing_defaults(explicit: dict[str, str]) -> dict[str, str]:
    """The defaults for which nothing is configured yet."""
    running = SparkSession.getActiveSession()
    if running is not None:
        # A set option differs from an unset one in that it is listed.
        chosen = set(running.conf.getAll)
    else:
        # Starts the gateway, which reads what spark-submit and the defaults file set.
        SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list(explicit.items())))
        chosen = {key for key, _ in SparkConf().getAll()}
    return {key: value for key, value in DEFAULT_CONF.items() if key not in chosen}


def build_session(
    master: str | None = None,
    app_name: str = "rollscore",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with this package's defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, and the
    defaults only where nothing is configured, so a cluster submission keeps
    whatever ``spark-submit`` configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    explicit = dict(extra_conf or {})
    if shuffle_partitions is not None:
        explicit.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    conf = _missing_defaults(explicit) | explicit
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Shuffle files go when the write that made them ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the actions of one block; the session's own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 -- no SparkContext access (Spark Connect)
        return None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001 -- Spark Connect: the master is not visible
        return False


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only when unset.

    The fallback (a fresh temporary folder) is meant for local tests and the
    benchmark; on a cluster ``spark.checkpoint.dir`` must point at shared
    storage and is then used as is.
    """
    current = checkpoint_dir(spark)
    if current:
        try:
            if spark.sparkContext.getCheckpointDir() is None:
                spark.sparkContext.setCheckpointDir(current)
        except Exception:  # noqa: BLE001 -- Spark Connect: the conf is enough
            pass
        return current
    if fallback is None and not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder "
            "(a machine-local temporary folder would not survive executor loss)"
        )
    path = fallback or tempfile.mkdtemp(prefix="rollscore-ckpt-")
    os.makedirs(path, exist_ok=True)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001
        pass
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss, unlike a local checkpoint or a cache.
    """
    if checkpoint_dir(df.sparkSession) is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(or call ensure_checkpoint_dir in tests)"
        )
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
