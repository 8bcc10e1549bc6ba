"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "pressgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE, skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_tasks(spark: SparkSession) -> int:
    """Number of tasks to ask for by name where a stage unfolds its input to many times its size: the
    runtime would merge such partitions, judging them by what it shuffled."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is built and run within are deleted as soon as it has run, not when the driver happens to
    collect its garbage. Nothing that is returned and run later should be built within."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a private folder is made in local mode
    (as in tests), where driver and executors are one process; elsewhere the setting is required.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="pressgauge-")
    sc.setCheckpointDir(path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint`` has a reliable target."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; earlier runs are never overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/pressgauge/{name}-{uuid.uuid4().hex}"
