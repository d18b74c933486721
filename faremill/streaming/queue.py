"""A durable queue of months that a stream has touched.

Each batch puts the files it found, with their month, into a folder of its own number, which
it replaces when it runs again: a batch counts once, however often it runs. The entries of all
batches together list every file of a month, so that a month can be rebuilt whole without
looking at the input folder. Batches whose months are rebuilt are marked as done; months that
were rebuilt but not marked, since the run died between, are rebuilt once more.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.months import file_state, require_months
from faremill.schemas import MONTH

ENTRY = f"{MONTH} string, file_path string, file_name string, bytes long, modified timestamp"


class MonthQueue:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def put(self, files: DataFrame, batch_id: int) -> None:
        """Note the files of a batch (month, file_path, file_name, bytes, modified)."""
        files = files.select(MONTH, "file_path", "file_name", "bytes", "modified").distinct()
        require_months(files)
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/entries/batch={batch_id}")

    def entries(self) -> DataFrame:
        schema = T.StructType([*T.StructType.fromDDL(ENTRY).fields, T.StructField("batch", T.LongType())])
        return self._read(schema, "entries")

    def waiting(self) -> DataFrame:
        """Entries of batches whose months are not rebuilt yet."""
        return self.entries().join(self._done(), "batch", "left_anti")

    def files(self, months: DataFrame) -> DataFrame:
        """Every file of some months, as the last batch saw it."""
        own = self.entries().join(F.broadcast(months.select(MONTH).distinct()), MONTH, "left_semi")
        return own.groupBy(MONTH, "file_path").agg(
            F.max_by(F.struct("file_name", "bytes", "modified"), "batch").alias("last")).select(MONTH, "file_path", "last.*")

    def months(self) -> DataFrame:
        """Waiting months with the files they consist of: files, bytes, state, as `delivered_months` gives them."""
        return self.files(self.waiting()).groupBy(MONTH).agg(*file_state())

    def done(self, batches: list[int]) -> None:
        """Mark batches as done."""
        rows = self.spark.createDataFrame([(b,) for b in batches], "batch long")
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/done")

    def _done(self) -> DataFrame:
        return self._read(T.StructType.fromDDL("batch long"), "done")

    def _read(self, schema: T.StructType, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:  # the first batch makes the folder
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
