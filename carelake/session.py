"""Session defaults shared by every job in the package."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime-settable options only, so that they also apply to a session made by
# somebody else.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Before a job runs, Spark takes the size of a side from its file size and the share of
# the columns read.  Few columns of nested Parquet files, exploded, are hundreds of times that,
# and were built as broadcasts in the driver's memory.  So only sides of tiny files are broadcast
# by estimate; all others once their measured size is below the session's threshold, else
# they are sort-merged, where AQE splits hot keys.
ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
TINY = "64k"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time options to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    allowed = spark.conf.get(ESTIMATED)
    if allowed not in (TINY, "-1"):
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, allowed)
        spark.conf.set(ESTIMATED, TINY)
    return spark


def _bytes(size: str) -> int:
    number, unit = re.match(r"(-?[0-9]+)\s*([kmgt]?)i?b?$", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


@contextmanager
def shared_broadcasts(spark: SparkSession, plans: int) -> Iterator[None]:
    """Plans that run at the same time share what one may broadcast: the driver holds the sides of all of them."""
    before = spark.conf.get(MEASURED, None)
    allowed = _bytes(before or spark.conf.get(ESTIMATED))
    if allowed > 0:
        spark.conf.set(MEASURED, str(allowed // max(plans, 1)))
    try:
        yield
    finally:
        if before is not None:
            spark.conf.set(MEASURED, before)
        elif allowed > 0:
            spark.conf.unset(MEASURED)


def local_session(cores: str = "8", shuffle_partitions: str = "8") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("carelake")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", os.environ.get("CARELAKE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` wins.  Only a local master (tests) may fall back to
    a folder of this machine; on a cluster the setting is required.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="carelake-")
    return _local_folder
