"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC wall-clock timestamps and strict casts; dirty input goes through try_* functions.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Run-time re-planning: partition coalescing, size-checked broadcast, and splitting of
# skewed join partitions (a hot contact or tenant is divided over several tasks).
EXECUTION = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # no call-site capture per Column call: it doubles the time to build a plan from Python
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def use_ledger_semantics(spark: SparkSession) -> SparkSession:
    """Set the run-time options that change results; leaves sizing options alone."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "ledgerloom", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTICS, **EXECUTION, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, as in tests, may do without the setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return os.path.join(shared, "ledgerloom", f"{label}-{uuid.uuid4().hex}")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"ledgerloom-{label}-")
