"""Spark session helpers.

The library never creates a session behind the caller's back: operators take
DataFrames. ``build_session`` is for scripts and tests; ``shared_dir`` resolves
the cluster-shared folder for lineage cuts and streaming checkpoints.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run should have: UTC so DATE/TIMESTAMP arithmetic never depends
# on the machine zone, AQE for runtime coalescing / skew-join splitting / join
# demotion, and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "aisle", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``, the folder that all executors share. Only a
    local master may leave it unset (as in tests) and gets a private folder."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="aisle-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


ROWS_PER_TASK = 500_000
BYTES_PER_TASK = "16m"       # of compressed columns or shuffled rows


@contextmanager
def sized_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """SQL settings for an action over ``rows`` input rows: partitions in proportion to
    them (at least the session's number), no task that reads more than
    ``BYTES_PER_TASK`` because AQE joins partitions or a scan joins files, and shuffle
    files that go when the action ends, not when the driver next collects garbage: the
    action must leave nothing that reads them. The session's own settings come back
    afterwards."""
    partitions = "spark.sql.shuffle.partitions"
    wanted = {partitions: str(max(int(spark.conf.get(partitions)), -(-rows // ROWS_PER_TASK))),
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": BYTES_PER_TASK,
              "spark.sql.files.maxPartitionBytes": BYTES_PER_TASK,
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
