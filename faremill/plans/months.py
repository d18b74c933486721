"""Month by month export with restart."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.months import (
    commit_months, committed_months, delivered_months, found_months, pending_months, withdrawn_months)
from faremill.operators.profile import by_written_month, run_report
from faremill.operators.zones import require_unique_keys
from faremill.plans.export import build_output
from faremill.schemas import MONTH, OUTPUT
from faremill.session import sized
from faremill.sources.footers import file_rows
from faremill.sources.sinks import remove_folder, write_months, write_report
from faremill.sources.trips import read_trip_months


class Rebuild:
    """Writes whole months and commits them to a ledger; one object is one run."""

    def __init__(self, spark: SparkSession, zones: DataFrame, output_path: str, ledger_path: str, unit: str = "fraction",
                 how: str = "native", invalid: str = "nan"):
        require_unique_keys(zones)
        self.spark, self.zones, self.output_path, self.ledger_path = spark, zones, output_path, ledger_path
        self.unit, self.how, self.invalid = unit, how, invalid
        self.started, self.run_id = time.monotonic(), uuid.uuid4().hex
        # Footers of trip files are kept next to the ledger, so each is opened once.
        self.index_path = f"{ledger_path.rstrip('/')}-footers"

    def run(self, todo: list, gone: list[str], trips: Callable[[], DataFrame]) -> None:
        """Replace the months of `todo` (month, files, bytes, state) by `trips`; empty those of `gone`.

        Months are committed after their rows are in place. A month that gave no row loses the
        rows of an earlier delivery.
        """
        months = [row[MONTH] for row in todo]
        before = {row[MONTH]: row["state"] for row in found_months(self.spark, self.output_path).collect()}
        if todo:
            table = build_output(trips(), self.zones, MONTH, self.unit, self.how, self.invalid, gather=True)
            with sized(self.spark, sum(row["bytes"] for row in todo)):
                write_months(table, self.output_path)
        after = {row[MONTH]: row for row in found_months(self.spark, self.output_path).collect()}
        emptied = [m for m in months if m in before and after[m]["state"] == before[m]]
        for month in emptied + [m for m in gone if m in after]:
            remove_folder(self.spark, f"{self.output_path}/{MONTH}={month}")
        # The listing is the one from before the read: files that came meanwhile leave their
        # month pending.
        commit_months(self._outcome(todo, gone, {m: r for m, r in after.items() if m not in emptied}),
                      self.ledger_path, self.run_id, time.monotonic() - self.started)

    def report(self, report_path: str | None = None) -> DataFrame:
        report = run_report(committed_months(self.spark, self.ledger_path), self.run_id).orderBy("month")
        if report_path:
            write_report(report, report_path)
        return report

    def _outcome(self, todo: list, gone: list[str], after: dict) -> DataFrame:
        """Ledger rows of a run: what each month read, and what it has in the output now."""
        folders = [f"{self.output_path}/{MONTH}={row[MONTH]}" for row in todo if row[MONTH] in after]
        counts = {}
        if folders:
            counted = by_written_month(file_rows(self.spark, folders)).groupBy(MONTH).agg(F.sum("rows").alias("rows"))
            counts = {row[MONTH]: row["rows"] for row in counted.collect()}
        rows = []
        for row in todo:
            found = after.get(row[MONTH])
            rows.append((row[MONTH], row["files"], row["bytes"], row["state"], counts.get(row[MONTH], 0),
                         found["output_bytes"] if found else 0, found["parquet_files"] if found else 0))
        rows += [(month, 0, 0, 0, 0, 0, 0) for month in gone]
        return self.spark.createDataFrame(
            rows, f"{MONTH} string, files long, bytes long, state long, rows long, output_bytes long, parquet_files long")


def export_months(spark: SparkSession, trips_path: str, zones: DataFrame, output_path: str, ledger_path: str,
                  report_path: str | None = None, unit: str = "fraction", how: str = "native",
                  invalid: str = "nan") -> DataFrame:
    """Export the months that are not committed yet, all in one job, and return the run report.

    Months are replaced whole and committed after their rows are in place. A run that dies
    commits nothing, so the next one writes the same months again over what it left. A month
    that gave no row this time loses the rows of an earlier delivery, and so does a month
    whose files were all withdrawn; both are committed as empty. Only files of pending months
    are opened, and the footer of each file once in its life: a broken file of a finished month
    is not looked at.
    """
    rebuild = Rebuild(spark, zones, output_path, ledger_path, unit, how, invalid)
    committed, delivered = committed_months(spark, ledger_path), delivered_months(spark, trips_path)
    # At most one row per calendar month, here and below; the scan uses the names to leave out other files.
    todo = pending_months(delivered, committed).collect()
    gone = [row[MONTH] for row in withdrawn_months(delivered, committed).collect()]
    if todo or gone:
        months = [row[MONTH] for row in todo]
        rebuild.run(todo, gone, lambda: read_trip_months(spark, trips_path, months, rebuild.index_path))
    return rebuild.report(report_path)


def read_months(spark: SparkSession, output_path: str) -> DataFrame:
    """An export by month, the month as text."""
    schema = T.StructType([*OUTPUT.fields, T.StructField(MONTH, T.StringType())])
    return spark.read.schema(schema).parquet(output_path)
