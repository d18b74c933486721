"""Command line: python -m faremill <command> ..., or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from faremill.operators.metrics import trial_medians
from faremill.operators.profile import by_delivered_month, dataset_totals, file_report, month_report, report_totals
from faremill.operators.runlog import completed_lines, last_per_month, log_events, reconstruct, runtime_totals
from faremill.plans.evidence import (
    check_manifest, prepare_subset, read_manifest, require_completed, validate_export, write_comparison)
from faremill.plans.export import export_trips
from faremill.plans.incremental import export_delivery
from faremill.plans.months import export_months
from faremill.schemas import RUN_REPORT
from faremill.session import clear_scratch, get_session
from faremill.sources.documents import read_log, read_metrics
from faremill.sources.footers import profile_files
from faremill.sources.zones import read_zones
from faremill.streaming.months import stream_months

SHOWN_ROWS = 1000


def export(spark: SparkSession, args) -> None:
    seconds = export_trips(spark, args.trips, args.zones, args.output, args.speed)
    print(f"seconds: {seconds:.6f}")


def months(spark: SparkSession, args) -> None:
    zones = read_zones(spark, args.zones)
    report = export_months(spark, args.trips, zones, args.output, args.ledger, args.report)
    _show(report)
    _show(report_totals(report))


def stream(spark: SparkSession, args) -> None:
    zones = read_zones(spark, args.zones)
    _show(stream_months(spark, args.trips, zones, args.output, args.ledger, args.checkpoint, args.files_per_batch))


def deliver(spark: SparkSession, args) -> None:
    done = export_delivery(spark, args.trips, read_zones(spark, args.zones), args.output, args.seen)
    print(f"deliveries done: {done}")


def prepare(spark: SparkSession, args) -> None:
    _show(prepare_subset(spark, args.trips, args.zones, args.subset, args.manifest, args.rows))


def compare(spark: SparkSession, args) -> None:
    exports = dict(item.split("=", 1) for item in args.export)
    manifest, metrics = None, None
    if args.manifest:
        manifest = read_manifest(spark, args.manifest)
        check_manifest(spark, manifest, [row["file_path"] for row in manifest.select("file_path").collect()])
    if args.metrics:
        metrics = require_completed(read_metrics(spark, args.metrics), list(exports))
        _show(trial_medians(metrics))
    _show(write_comparison(spark, exports, next(iter(exports)), args.summary, metrics, manifest))


def profile(spark: SparkSession, args) -> None:
    found = profile_files(spark, args.path)
    _show(file_report(found).orderBy("file_name"))
    _show(month_report(by_delivered_month(found)).orderBy("month"))
    _show(dataset_totals(found))


def validate(spark: SparkSession, args) -> None:
    _show(validate_export(spark, args.path))


def runlog(spark: SparkSession, args) -> None:
    log = read_log(spark, args.log)
    if args.report:
        report = spark.read.schema(RUN_REPORT).option("header", True).csv(args.report)
        found = reconstruct(log, report)
        _show(found.orderBy("month"))
        _show(runtime_totals(found, "runtime_seconds"))
    else:
        found = last_per_month(completed_lines(log_events(log)))
        _show(found.orderBy("month"))
        _show(runtime_totals(found))


def _show(df: DataFrame) -> None:
    """Print a report, and how many of its rows are left out, if any are."""
    df.show(SHOWN_ROWS, truncate=False)
    if (rows := df.count()) > SHOWN_ROWS:
        print(f"{rows - SHOWN_ROWS} of {rows} rows are not shown")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="faremill", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(function, help_text: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(function.__name__, help=help_text)
        sub.set_defaults(run=function)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        return sub

    sub = command(export, "clean, enrich and export all months in one job", "trips", "zones", "output")
    sub.add_argument("--speed", choices=["native", "try_divide", "udf", "pandas"], default="native")
    sub = command(months, "export the months that are not done yet", "trips", "zones", "output", "ledger")
    sub.add_argument("--report", help="folder for the run report as CSV")
    sub = command(stream, "export files that came since the last run", "trips", "zones", "output", "ledger", "checkpoint")
    sub.add_argument("--files-per-batch", type=int, default=64)
    command(deliver, "export the trips of new files that no earlier file had", "trips", "zones", "output", "seen")
    sub = command(prepare, "write a fixed subset and its manifest", "trips", "zones", "subset", "manifest")
    sub.add_argument("--rows", type=int, default=200_000)
    sub = command(compare, "compare exports row by row", "summary")
    sub.add_argument("export", nargs="+", metavar="NAME=PATH", help="the first one is the base")
    sub.add_argument("--manifest")
    sub.add_argument("--metrics")
    command(profile, "rows and bytes per file and per month", "path")
    command(validate, "files, rows, bytes and schemas of an export", "path")
    sub = command(runlog, "run times from log lines", "log")
    sub.add_argument("--report", help="run report as CSV, to name months by their rows")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(f"faremill-{args.command}")
    try:
        args.run(spark, args)
    finally:
        # Results are printed or written by now; nothing reads scratch tables any more.
        clear_scratch(spark)


if __name__ == "__main__":
    main()
