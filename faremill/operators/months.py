"""Which months are there, which are done, which are left."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.text import MONTH_FORM, month_of
from faremill.schemas import LEDGER, MONTH, SchemaError
from faremill.sources.files import PARQUET, list_files


def delivered_months(spark: SparkSession, path: str, pattern: str = PARQUET) -> DataFrame:
    """Months with trip files, from the listing alone: files, bytes, and the state of the files.

    The state changes with any name, size or time of change. A file that names no month is an
    error: its rows would belong nowhere.
    """
    listed = list_files(spark, path, pattern).withColumn(MONTH, month_of(F.col("file_name"), F.col("file_path")))
    require_months(listed)
    return listed.groupBy(MONTH).agg(*file_state())


def file_state() -> list[Column]:
    """files, bytes and state of a group of listed files."""
    return [F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"),
            F.bit_xor(F.xxhash64("file_path", "bytes", "modified")).alias("state")]


def require_months(files: DataFrame) -> None:
    """Raise with the names of files that name no month."""
    foreign = files.filter(~F.coalesce(F.col(MONTH).rlike(MONTH_FORM), F.lit(False)))
    shown = foreign.orderBy("file_name").limit(20).collect()
    if shown:
        raise SchemaError(f"{foreign.count()} trip files name no month: " + ", ".join(r["file_name"] for r in shown))


def written_months(spark: SparkSession, path: str) -> DataFrame:
    """Months in an export: rows, output_bytes, parquet_files, and the state of its files."""
    listed = list_files(spark, path).withColumn(MONTH, F.regexp_extract("file_path", rf"/{MONTH}=([^/]+)/", 1))
    return listed.groupBy(MONTH).agg(
        F.sum("bytes").alias("output_bytes"), F.count(F.lit(1)).alias("parquet_files"),
        F.bit_xor(F.xxhash64("file_name")).alias("state"))


def found_months(spark: SparkSession, path: str) -> DataFrame:
    """As `written_months`, with no rows before the first export."""
    try:
        return written_months(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{MONTH} string, output_bytes long, parquet_files long, state long")


def committed_months(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger of finished months; empty before the first run."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger_path)
    except AnalysisException as error:  # the folder is made by the first commit
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER])


def pending_months(months: DataFrame, committed: DataFrame) -> DataFrame:
    """Months that are not done: without a ledger row, or with other files than at their last commit.

    A half-written month has no row and is done again.
    """
    return months.join(last_commits(committed), [MONTH, "files", "bytes", "state"], "left_anti")


def withdrawn_months(months: DataFrame, committed: DataFrame) -> DataFrame:
    """Months that were exported and have no trip file any more."""
    return last_commits(committed).filter("files > 0").join(months, MONTH, "left_anti").select(MONTH)


def last_commits(committed: DataFrame) -> DataFrame:
    """The last ledger row of each month."""
    rest = [c for c in LEDGER.names if c != MONTH]
    return committed.groupBy(MONTH).agg(F.max_by(F.struct(*rest), "committed_at").alias("row")).select(MONTH, "row.*")


def commit_months(months: DataFrame, ledger_path: str, run_id: str, seconds: float) -> None:
    """Append months, with what was read and written, to the ledger. Called after their rows are written, never before."""
    (
        months.select(
            MONTH, "files", "bytes", "state", "rows", "output_bytes", "parquet_files", F.lit(run_id).alias("run_id"),
            F.lit(seconds).alias("run_seconds"), F.lit(time.time()).alias("committed_at"))
        .coalesce(1).write.mode("append").parquet(ledger_path)
    )
