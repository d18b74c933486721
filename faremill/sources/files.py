"""Facts about files: listing, bytes, digests. Facts from footers are in `footers`.

Listings open no file: a binary scan without its content column only lists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.schemas import OUTPUT_COLUMNS, require_columns
from faremill.sources.stores import open_store

PARQUET = "*.parquet"
FILES_AT_ONCE = 4
_CHUNK_BYTES = 4 << 20


def list_files(spark: SparkSession, path: str | list[str], pattern: str = PARQUET) -> DataFrame:
    """file_path, file_name, bytes, modified of every file under a path.

    The scan would plan a task per large file, though it opens none; the tasks are merged.
    """
    return _binary(spark, path, pattern).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    ).coalesce(spark.sparkContext.defaultParallelism)


def sorted_paths(spark: SparkSession, path: str | list[str], pattern: str = PARQUET) -> DataFrame:
    return list_files(spark, path, pattern).select("file_path", "file_name").orderBy("file_path")


def first_path(spark: SparkSession, path: str | list[str], pattern: str = PARQUET) -> str:
    """The first file by name."""
    return list_files(spark, path, pattern).agg(F.min("file_path")).first()[0]


def total_bytes(spark: SparkSession, path: str | list[str], pattern: str = PARQUET) -> int:
    return list_files(spark, path, pattern).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]


def file_digests(spark: SparkSession, path: str | list[str], pattern: str = "*",
                 options: Mapping[str, object] | None = None) -> DataFrame:
    """file_path, file_name, bytes, sha256 of every file under a path.

    A file of any size is read as a stream in a task. `options` are those of its store.
    """
    return listed_digests(list_files(spark, path, pattern), options)


def listed_digests(files: DataFrame, options: Mapping[str, object] | None = None) -> DataFrame:
    """The same of the files of a listing."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            yield files.assign(sha256=[_digest(path, options) for path in files["file_path"]])

    listed = dealt(files.select("file_path", "file_name", "bytes"))
    return listed.mapInPandas(digests, "file_path string, file_name string, bytes long, sha256 string")


def read_output(spark: SparkSession, path: str | list[str], columns: list[str] = OUTPUT_COLUMNS) -> DataFrame:
    """An exported table; raises unless its columns are exactly the expected ones."""
    table = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", PARQUET).parquet(*_paths(path))
    )
    require_columns(table.columns, columns)
    return table.select(*columns)


def _paths(path) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _binary(spark: SparkSession, path, pattern: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(_paths(path))
    )


def dealt(files: DataFrame) -> DataFrame:
    """A listing dealt out again: its tasks now open the files."""
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism * FILES_AT_ONCE, "file_path")


def _digest(path: str, options: Mapping[str, object] | None) -> str:
    system, name = open_store(path, options)
    digest = hashlib.sha256()
    with system.open_input_stream(name, compression=None) as stream:
        while chunk := stream.read(_CHUNK_BYTES):
            digest.update(chunk)
    return digest.hexdigest()
