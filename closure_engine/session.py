"""Session helpers.

The library never creates a global session: every function takes DataFrames.
``build_session`` is a convenience for tests, the bench and scripts; it only
fills in settings the caller (or the cluster) left unset.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults applied only when the key is unset.  AQE re-plans joins at runtime:
# it turns a join into a broadcast only when the measured shuffle output is
# below the threshold (a checked size), coalesces small partitions and splits
# skewed join partitions (hub vertices).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "closure_engine", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    ``spark.checkpoint.dir`` names a folder that all executors share and is
    used as is.  Where it is unset, a local session (tests) gets a fresh
    temporary folder that is removed when the process ends; on a cluster that
    is an error, as a temporary folder is on one machine only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="closure-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, the session's ``name`` is ``value``."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes a query's shuffle files when the query ends, not when the driver happens to collect its garbage."""
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield
