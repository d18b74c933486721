"""Session settings, the UTC guard and the shared scratch folder."""

from __future__ import annotations

import functools
import math
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ZONE_KEY = "spark.sql.session.timeZone"
CHECKPOINT_KEY = "spark.checkpoint.dir"
PARTITIONS_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT_KEY = "spark.sql.files.maxPartitionBytes"

LEAST_SPLIT_BYTES = 128 << 20
MOST_SPLIT_BYTES = 1 << 30
MOST_SCAN_TASKS = 100_000
SHUFFLE_BYTES = 128 << 20
MOST_PARTITIONS = 131_072

SETTINGS = {
    ZONE_KEY: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "faremill", **settings: str) -> SparkSession:
    """A session with the engine's settings; the master comes from the submit command."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def utc(spark: SparkSession):
    """Analyze plans under UTC, then give the caller's zone back.

    The zone is fixed in a time expression when its plan is analyzed, so a plan built
    inside this block keeps UTC whatever the session does later.
    """
    before = spark.conf.get(ZONE_KEY)
    spark.conf.set(ZONE_KEY, "UTC")
    try:
        yield
    finally:
        spark.conf.set(ZONE_KEY, before)


def in_utc(operator):
    """Run an operator whose first argument is a DataFrame inside `utc`."""

    @functools.wraps(operator)
    def wrapped(df: DataFrame, *args, **kwargs):
        with utc(df.sparkSession):
            return operator(df, *args, **kwargs)

    return wrapped


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share, under that of the application.

    The cluster names the shared folder in spark.checkpoint.dir. A local session without one
    gets a temporary folder; on a cluster that would not be shared, so it is an error.
    """
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has in the scratch folder; DataFrames that read it are void then."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _scratch_folder(spark: SparkSession) -> str:
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        base = _local_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/faremill/{spark.sparkContext.applicationId}"


@functools.cache
def _local_folder(_application: str) -> str:
    return tempfile.mkdtemp(prefix="faremill-")


@contextmanager
def sized(spark: SparkSession, input_bytes: int, most_partitions: int = MOST_PARTITIONS, shuffle_bytes: int | None = None):
    """Size scans and shuffles for an input, for the jobs run inside this block.

    Adaptive execution merges shuffle partitions but never adds any, so the first number
    must fit the input, or `shuffle_bytes` where rows are wider in a shuffle than in files. Both
    numbers are bounded: their product is the number of blocks the shuffle has to serve.
    """
    split = min(max(input_bytes // MOST_SCAN_TASKS, LEAST_SPLIT_BYTES), MOST_SPLIT_BYTES)
    cores = spark.sparkContext.defaultParallelism
    partitions = min(max(math.ceil((shuffle_bytes or input_bytes) / SHUFFLE_BYTES), cores), max(most_partitions, cores))
    wanted = {SPLIT_KEY: str(split), PARTITIONS_KEY: str(partitions)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield partitions
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
