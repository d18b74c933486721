"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.schemas import MONTH, RUN_REPORT


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def by_month(df: DataFrame) -> DataFrame:
    """Gather each month in few partitions before a write by month.

    Without it every task would open a file for every month. Adaptive execution splits a
    month that is too large for one partition and merges small ones.
    """
    return df.hint("rebalance", F.col(MONTH))


def write_months(df: DataFrame, path: str) -> None:
    """One folder per month; replaces the months in the table and leaves the others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def write_subset(df: DataFrame, path: str, order: str | None = None) -> None:
    """A subset as one Snappy file. Whoever takes the subset bounds its rows; none is left out here.

    Only the rows of the subset come to the task that writes: what they are taken from is read
    in tasks of its own, which a coalesce would merge into one. Rows stay in their order, or in
    that of the column `order`, which is not written.
    """
    place = order or "_place"
    placed = df if order else df.withColumn(place, F.monotonically_increasing_id())
    (
        placed.repartition(1).sortWithinPartitions(place).drop(place)
        .write.mode("overwrite").option("compression", "snappy").parquet(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """The run report as one CSV file with a header; it has one row per month."""
    (
        report.select(*RUN_REPORT.names).coalesce(1).sortWithinPartitions("month")
        .write.mode("overwrite").option("header", True).csv(path)
    )


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, with the file system that Spark uses for it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_documents(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
