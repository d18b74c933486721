"""Run metrics, resource samples and logs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.schemas import RUN_METRICS, SAMPLES


def read_metrics(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Run metrics: one indented document per file, or one document per line."""
    return spark.read.schema(RUN_METRICS).option("multiLine", whole_files).json(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Resource samples, one JSON line each, with the trace file they come from."""
    return (
        spark.read.schema(SAMPLES).json(path)
        .select(F.regexp_replace("_metadata.file_name", r"\.jsonl?$", "").alias("trace"), "*")
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """file_path, line_at, line of every log line.

    `line_at` orders the lines of a file without a sort: the offset of the split in the
    file, then the position within the split, which one task reads from its start.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("position"),
        ).alias("line_at"),
        F.col("value").alias("line"),
    )
