"""Run times recovered from log lines.

A log is large and is read once: each line is parsed into typed events, which are narrow and
are written by kind. All that follows reads the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremill.functions.text import capture
from faremill.operators.ordered import carry_forward
from faremill.schemas import LOG_EVENTS
from faremill.session import in_utc, scratch_path

# The three line formats.
COMPLETED = r"Completed (\d{4}-\d{2}): ([0-9,]+) rows, ([0-9.]+) seconds"
EXECUTED = r"Dataset (dataset_\S+) execution finished in ([0-9.]+) seconds"
WRITTEN = r"Data sink Parquet finished\. ([0-9]+) rows"
LOGGED_AT = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"
SESSION = r"session_([^/\s]+)/"

RUN = "struct<dataset: string, seconds: double, finished_at: bigint>"

COMPLETED_SCOPE = "month, as logged at its end"
EXECUTED_SCOPE = "run of the dataset that wrote the month"
AMBIGUOUS_SCOPE = "unknown: months and writes of this size cannot be matched"


@in_utc
def log_events(log: DataFrame) -> DataFrame:
    """kind, session, at, line_at, month, rows, seconds, dataset of every line that says something.

    A line is parsed once, whatever it says; one that holds several statements gives an event
    for each. Kinds are completed (month, rows, seconds), executed (dataset, seconds) and
    written (rows). `at` is the logged time in epoch milliseconds.
    """
    line = F.col("line")

    def event(kind: str, pattern: str, month=None, rows=None, seconds=None, dataset=None) -> Column:
        def part(group: int | None) -> Column:
            return F.lit(None).cast("string") if group is None else capture(line, pattern, group)

        return F.when(line.rlike(pattern), F.struct(
            F.lit(kind).alias("kind"), part(month).alias("month"),
            F.regexp_replace(part(rows), ",", "").cast("long").alias("rows"),
            part(seconds).cast("double").alias("seconds"), part(dataset).alias("dataset")))

    said = F.filter(F.array(
        event("completed", COMPLETED, month=1, rows=2, seconds=3),
        event("executed", EXECUTED, dataset=1, seconds=2),
        event("written", WRITTEN, rows=1)), lambda e: e.isNotNull())
    # Most lines say nothing; they go before anything else is taken from them.
    stated = log.filter(line.rlike(f"{COMPLETED}|{EXECUTED}|{WRITTEN}")).select(
        _session().alias("session"), _logged_at().alias("at"), "line_at", F.explode(said).alias("event"))
    return stated.select("event.kind", "session", "at", "line_at", "event.month", "event.rows", "event.seconds", "event.dataset")


def write_events(log: DataFrame, path: str) -> DataFrame:
    """The events of a log as a table, a folder per kind; read it again with `read_events`."""
    log_events(log).write.mode("overwrite").partitionBy("kind").parquet(path)
    return read_events(log.sparkSession, path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_EVENTS).parquet(path)


def completed_lines(events: DataFrame) -> DataFrame:
    """month, rows, seconds, line_at of every completion."""
    return events.filter("kind = 'completed'").select("month", "rows", "seconds", "line_at")


def last_per_month(completed: DataFrame) -> DataFrame:
    """The last completion line of each month wins."""
    last = F.max_by(F.struct("rows", "seconds"), F.col("line_at"))
    return completed.groupBy("month").agg(last.alias("last")).select("month", "last.rows", "last.seconds")


def runtime_totals(months: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Months found, total seconds, total minutes."""
    return months.agg(F.count(F.lit(1)).alias("months"), F.sum(seconds).alias("total_seconds")).withColumn(
        "total_minutes", F.col("total_seconds") / F.lit(60.0))


def executed_lines(events: DataFrame) -> DataFrame:
    """session, dataset, seconds, finished_at (epoch milliseconds) of every dataset execution.

    A dataset logs to its own file and to the shared one; its id makes it one row.
    """
    return events.filter("kind = 'executed'").groupBy("session", "dataset").agg(
        F.max_by("seconds", "at").alias("seconds"), F.max("at").alias("finished_at"))


def written_lines(events: DataFrame) -> DataFrame:
    """session, rows, written_at (epoch milliseconds) of every finished write."""
    return events.filter("kind = 'written'").select("session", "rows", F.col("at").alias("written_at")).distinct()


def pair_writes(executed: DataFrame, written: DataFrame) -> DataFrame:
    """Each write with the execution that finished last before it in the same session."""
    run = F.struct("dataset", "seconds", "finished_at")
    events = executed.select(
        "session", F.col("finished_at").alias("at"), run.alias("run"), F.lit(None).cast("long").alias("rows")
    ).unionAll(written.select(
        "session", F.col("written_at").alias("at"), F.lit(None).cast(RUN).alias("run"), "rows"))
    # At the same instant the execution comes first.
    paired = carry_forward(events, ["session"], "at", "run", "last", [F.col("at"), F.col("rows").isNotNull()])
    return paired.filter(F.col("rows").isNotNull()).select(
        "session", "rows", F.col("at").alias("written_at"), "last.dataset", "last.seconds", "last.finished_at")


def reconstruct(log: DataFrame, report: DataFrame) -> DataFrame:
    """One row per month with its run time and where that comes from; see `reconstruct_events`.

    The log is scanned once, into a table of events in the scratch folder.
    """
    return reconstruct_events(write_events(log, scratch_path(log.sparkSession, "events")), report)


def reconstruct_events(events: DataFrame, report: DataFrame) -> DataFrame:
    """month, runtime_seconds, rows, timing_scope of every month that a log tells something about.

    A completion line counts where there is one. Other months are found by the rows they wrote.
    Months that share a number of rows take the writes of that number in order, the first
    month the first write, if there are as many of both; a single month takes the last write.
    Otherwise the seconds are null, and the scope says so.
    """
    completed = last_per_month(completed_lines(events))
    open_months = report.select("month", "rows").distinct().join(completed.select("month"), "month", "left_anti")
    in_turn = Window.partitionBy("rows").orderBy("at")
    # Months are few, calendar months; writes of one size are not, since runs are tried again.
    wanted = open_months.groupBy("rows").agg(F.count(F.lit(1)).alias("months"))
    finished = pair_writes(executed_lines(events), written_lines(events)).filter(F.col("seconds").isNotNull()).select(
        "rows", "seconds", F.col("finished_at").alias("at"))
    finished = finished.join(wanted.select("rows"), "rows", "left_semi")
    sizes = wanted.join(finished.groupBy("rows").agg(
        F.count(F.lit(1)).alias("writes"), F.max_by("seconds", "at").alias("latest")), "rows")
    # Only where there are as many writes as months are writes put in turn, so a turn is as
    # short as the list of months.
    paired = sizes.filter("months > 1 AND months = writes").select("rows")
    turns = finished.join(paired, "rows", "left_semi").withColumn("turn", F.row_number().over(in_turn)).select(
        "rows", "turn", F.col("seconds").alias("in_turn"))
    months = open_months.withColumn("at", F.col("month")).withColumn("turn", F.row_number().over(in_turn)).drop("at")
    matched = months.join(sizes, "rows").join(turns, ["rows", "turn"], "left")
    known = (F.col("months") == 1) | (F.col("months") == F.col("writes"))
    executed = matched.select(
        "month", "rows", F.when(F.col("months") == 1, F.col("latest")).otherwise(F.col("in_turn")).alias("seconds"),
        F.when(known, F.lit(EXECUTED_SCOPE)).otherwise(F.lit(AMBIGUOUS_SCOPE)).alias("timing_scope"))
    columns = [F.col("month"), F.col("seconds").alias("runtime_seconds"), F.col("rows")]
    return (
        completed.select(*columns, F.lit(COMPLETED_SCOPE).alias("timing_scope"))
        .unionAll(executed.select(*columns, "timing_scope"))
    )


def _session() -> Column:
    return F.coalesce(capture(F.col("line"), SESSION), capture(F.col("file_path"), SESSION), F.lit(""))


def _logged_at() -> Column:
    text = capture(F.col("line"), LOGGED_AT)
    return F.unix_millis(F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss,SSS"))
