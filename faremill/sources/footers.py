"""An index of Parquet footers: rows, bytes, schema and state of every file, kept in a table.

A footer is opened once in the life of a file. The index is a table of facts keyed by path,
size and time of change; files whose three are in the table are not opened again, others are
opened in tasks and appended. Facts are never changed in place, so a run that dies while it
appends leaves at most rows that are true, and facts of files that are gone match no listing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import scratch_path
from faremill.sources.files import dealt, list_files
from faremill.sources.stores import open_store

STATE = ["file_path", "bytes", "modified"]
FACTS = ("file_path string, file_name string, bytes long, modified timestamp, rows long, columns array<string>, schema string")


def read_footers(files: DataFrame, options: Mapping[str, object] | None = None) -> DataFrame:
    """The facts of the files of a listing, each from its footer, opened in a task."""

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for listed in batches:
            found = [_footer(path, options) for path in listed["file_path"]]
            yield listed.assign(
                rows=[rows for rows, _ in found], columns=[[name for name, _ in fields] for _, fields in found],
                schema=["\n".join(f"{name}: {kind}" for name, kind in fields) for _, fields in found])

    # Python would turn the time of change into local time and back, which has no one answer
    # in the hour that a zone repeats; as a number it stays what it is.
    found = dealt(numbered(files).select("file_path", "file_name", "bytes", "modified")).mapInPandas(
        opened, FACTS.replace("modified timestamp", "modified long"))
    return timed(found)


def numbered(files: DataFrame) -> DataFrame:
    """A listing with the time of change in microseconds, to pass through Python."""
    return files.withColumn("modified", F.unix_micros("modified"))


def timed(files: DataFrame) -> DataFrame:
    """The reverse of `numbered`."""
    return files.withColumn("modified", F.timestamp_micros("modified"))


def indexed_footers(files: DataFrame, index_path: str | None = None, options: Mapping[str, object] | None = None) -> DataFrame:
    """The facts of the files of a listing, from the index; only what it lacks is opened.

    Without a path the index is a scratch table, which still makes one pass of whatever is
    asked of the footers afterwards.
    """
    spark = files.sparkSession
    if index_path is None:
        path = scratch_path(spark, "footers")
        read_footers(files, options).write.parquet(path)
        return spark.read.schema(FACTS).parquet(path)
    known = _known(spark, index_path)
    new = files.join(known.select(*STATE), STATE, "left_anti")
    read_footers(new, options).write.mode("append").parquet(index_path)
    # Runs that overlap may both have opened a file; their facts are the same.
    facts = _known(spark, index_path)
    return facts.join(files.select(*STATE), STATE, "left_semi").dropDuplicates(STATE)


def path_footers(spark: SparkSession, path: str | list[str], index_path: str | None = None,
                 options: Mapping[str, object] | None = None) -> DataFrame:
    """The facts of every Parquet file under a path."""
    return indexed_footers(list_files(spark, path), index_path, options)


def compact_index(spark: SparkSession, path: str | list[str], index_path: str, into: str) -> DataFrame:
    """Write an index without the facts of files that are gone or changed, in few files."""
    facts = _known(spark, index_path).join(list_files(spark, path).select(*STATE), STATE, "left_semi").dropDuplicates(STATE)
    facts.hint("rebalance").write.mode("errorifexists").parquet(into)
    return spark.read.schema(FACTS).parquet(into)


def file_rows(spark: SparkSession, path: str | list[str], index_path: str | None = None) -> DataFrame:
    """file_path, rows of every Parquet file, from its footer."""
    return path_footers(spark, path, index_path).select("file_path", "rows")


def profile_files(spark: SparkSession, path: str | list[str], index_path: str | None = None) -> DataFrame:
    """file_path, file_name, bytes, rows of every Parquet file, empty ones included."""
    return path_footers(spark, path, index_path).select("file_path", "file_name", "bytes", "rows")


def file_schemas(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                 index_path: str | None = None) -> DataFrame:
    """file_path, columns, schema of every Parquet file; of `columns` only, if given."""
    facts = path_footers(spark, path, index_path)
    if columns is None:
        return facts.select("file_path", "columns", "schema")
    return facts.select("file_path", F.filter("columns", lambda c: c.isin(columns)).alias("columns"), kind_of(columns).alias("schema"))


def kind_of(columns: list[str]) -> Column:
    """The lines of `schema` that are about some columns."""
    lines = F.split("schema", "\n")
    return F.array_join(F.filter(lines, lambda line: F.substring_index(line, ": ", 1).isin(columns)), "\n")


def _known(spark: SparkSession, index_path: str) -> DataFrame:
    try:
        return spark.read.schema(FACTS).parquet(index_path)
    except AnalysisException as error:  # the first refresh makes the folder
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FACTS)


def _footer(path: str, options: Mapping[str, object] | None) -> tuple[int, list[tuple[str, str]]]:
    system, name = open_store(path, options)
    with system.open_input_file(name) as file:
        parquet = pq.ParquetFile(file)
        return parquet.metadata.num_rows, [(f.name, str(f.type)) for f in parquet.schema_arrow]
