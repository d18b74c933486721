"""Trip files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faremill.operators.months import committed_months, pending_months
from faremill.plans.months import Rebuild
from faremill.schemas import MONTH
from faremill.sources.trips import read_trip_files, stream_trip_months
from faremill.streaming.queue import MonthQueue


def stream_months(spark: SparkSession, trips_path: str, zones: DataFrame, output_path: str, ledger_path: str,
                  checkpoint_path: str, files_per_batch: int = 64, unit: str = "fraction", how: str = "native",
                  invalid: str = "nan") -> DataFrame:
    """Process the files that came since the last run, then stop; returns the run report.

    Batches put the files they find into a queue next to the checkpoint; no column is read.
    After them the months that wait in the queue are rebuilt once, whole, from the files that
    the queue has of them: the input folder is not listed again, and finished months are not
    looked at. The ledger is that of `export_months`, so a month it has exported from the same
    files is not done twice. A batch that runs twice is one entry, and a run that dies leaves
    its months waiting. A file of a waiting month that is gone by then is an error with its
    name; `export_months` takes withdrawn files out.
    """
    queue = MonthQueue(spark, f"{checkpoint_path}/queue")
    (
        stream_trip_months(spark, trips_path, files_per_batch)
        .writeStream.foreachBatch(lambda batch, batch_id: queue.put(batch, batch_id))
        .option("checkpointLocation", f"{checkpoint_path}/files")
        .trigger(availableNow=True)
        .start().awaitTermination()
    )
    rebuild = Rebuild(spark, zones, output_path, ledger_path, unit, how, invalid)
    # At most one row per waiting batch and calendar month.
    batches = [row["batch"] for row in queue.waiting().select("batch").distinct().collect()]
    if batches:
        todo = pending_months(queue.months(), committed_months(spark, ledger_path)).collect()
        if todo:
            months = spark.createDataFrame([(row[MONTH],) for row in todo], f"{MONTH} string")
            rebuild.run(todo, [], lambda: read_trip_files(spark, queue.files(months), rebuild.index_path))
        queue.done(batches)
    return rebuild.report()
