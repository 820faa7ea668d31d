"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "outbreaklens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join input even when that costs one more exchange after the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="outbreaklens-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def checkpointed(df: DataFrame) -> DataFrame:
    """Store `df` reliably, so that later stages read the same rows even after an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Let no Arrow batch of the session grow far beyond `most` bytes.

    Whole texts are long: batches of ten thousand of them would stand in the memory of the JVM and of Python, several
    times over. A smaller setting stays. Results do not depend on it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(name, str(1 << 26)).rstrip("b"))
    if now <= 0 or now > most:
        spark.conf.set(name, str(most))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_cpus() -> str:
    return os.environ.get("BENCH_CPUS", "8")
