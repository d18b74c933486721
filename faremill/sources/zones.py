"""The zone lookup: CSV with a header."""

from pyspark.sql import DataFrame, SparkSession

from faremill.schemas import ZONES

# Text that no lookup holds. Naming it as the null text keeps "N/A", "null" and "NaN" as
# they are; only an empty field is null.
NO_NULL_TEXT = "\u0000no-null-text\u0000"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(ZONES)
        .option("header", True)
        .option("nullValue", NO_NULL_TEXT)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
