"""Forcing a stage to run, for timing and checking it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.units import finite_text
from faremill.schemas import FEATURE_COLUMNS


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a table in memory and on disk, and drop it afterwards."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist(blocking=True)


def feature_stage(df: DataFrame) -> DataFrame:
    """The three columns whose cost the stage measures."""
    return df.select(*FEATURE_COLUMNS)


def speed_check(df: DataFrame) -> DataFrame:
    """Rows and speed sum of a table; the sum is text where it is not finite."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("average_speed_mph").alias("speed_sum")
    ).withColumn("speed_sum_text", finite_text(F.col("speed_sum")))
