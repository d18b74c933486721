"""What several operators share: written tables, batch size, texts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import scratch_path

BATCH_BYTES = 8 << 20


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows from a Parquet table in the shared folder, written with these options.

    This cuts the lineage: a lost executor costs no earlier stage, and what is read later
    is what was decided here.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of Python stages by bytes; a row count does not bound long texts.

    The setting is read when a job starts, so it stays set.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for mapInArrow that gives freed memory back at the end of its task.

    The worker lives on, and what it keeps counts beside what the next stages take.
    """

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it, and keeps what is freed without it
        if trim is not None:
            trim(0)

    return released


def text_of(column: str | Column = "text") -> Column:
    """A text, null as the empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
