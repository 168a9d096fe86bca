"""Session helpers: a local session for tests and bench, and shared scratch paths."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for local runs. On a cluster the deployment supplies its own configuration.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT methods over 8000 bytes of bytecode; above this limit Spark
    # falls back from whole-stage codegen to per-operator code with split methods, which
    # stays compiled (recommended for HotSpot in the Spark configuration docs).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "salesmart",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("SALESMART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is read, never replaced.
    Only when it is unset (a bare local test session) is a private folder created.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


#: MB of stored rows that a task reads at most where it sorts them: in memory they are more than twenty times as long.
SPLIT_MB = 16
_BYTES = {"": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40, "p": 2**50}


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


@contextmanager
def small_splits(spark: SparkSession, times: int = 1) -> Iterator[None]:
    """While stored rows are read to be sorted: splits of ``SPLIT_MB``, or smaller ones if the session asks
    for them, so that a task sorts in memory and spills nothing. ``times`` as large where few rows are sorted."""
    name = "spark.sql.files.maxPartitionBytes"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    with _setting(spark, name, f"{times * min(SPLIT_MB * 2**20, int(number) * _BYTES[unit])}b"):
        yield


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While a table is written: Spark removes the write's shuffle files as it ends. Otherwise they stay until
    the driver happens to collect garbage, and those of all steps of a query lie on the disks together."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (safe on any executor)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/salesmart/{name}-{uuid.uuid4().hex[:12]}"
