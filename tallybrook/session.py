"""Session settings the jobs rely on, and the shared folder they may write scratch tables to."""

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Cluster size, memory and shuffle width belong to spark-submit; these are about right answers and
# about letting the adaptive planner split or merge partitions once it has seen their sizes.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python call site of every column expression slows plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Window state on local disk with change logs in the checkpoint, rather than on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and timestamp text are taken in UTC, whatever zone the session was opened in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tallybrook-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only where none is named and all tasks run on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (named or _own_folder()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_folder(spark)}/tallybrook/{name}-{uuid.uuid4().hex}"
