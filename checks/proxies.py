"""Trip, zone and event tables derived from the driver's tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.schemas import MONTH, TRIP_COLUMNS
from faremill.session import sized, utc
from faremill.sources.files import total_bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips made of line items, with nulls, copies inside a month and copies across months."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")),
                   F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    with utc(spark):
        month = F.date_format("o_orderdate", "yyyy-MM")
        line = F.col("l_linenumber")
        months = (
            F.when(line == 3, F.array(month, month))
            .when(line == 4, F.array(month, F.lit("1990-01")))
            .otherwise(F.array(month))
        )
        return joined.select(
            line.alias("VendorID"),
            F.when(F.col("l_orderkey") % 97 != 0, F.col("o_orderdate")).alias("tpep_pickup_datetime"),
            F.col("l_shipdate").alias("tpep_dropoff_datetime"),
            F.when(F.col("l_orderkey") % 11 != 0, line.cast("long")).alias("passenger_count"),
            (F.col("l_quantity") - 5.0).alias("trip_distance"),
            F.col("c_nationkey").alias("PULocationID"),
            F.col("s_nationkey").alias("DOLocationID"),
            F.col("l_extendedprice").alias("fare_amount"),
            F.col("o_totalprice").alias("total_amount"),
            F.explode(months).alias(MONTH),
        )


# Trips are joined from fewer bytes in the files of their tables than they take in a shuffle.
TRIP_EXPANSION = 8


@contextmanager
def sized_trips(spark: SparkSession, sf_dir: str):
    """Size the jobs run inside this block for the trips."""
    tables = [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "customer", "supplier")]
    size = total_bytes(spark, tables)
    with sized(spark, size, shuffle_bytes=TRIP_EXPANSION * size) as partitions:
        yield partitions


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone lookup made of nations, with a missing borough, literal N/A and two absent ids."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter(key < 23)
        .select(
            key.alias("LocationID"),
            F.when(key % 9 != 0, F.col("r_name")).alias("Borough"),
            F.when(key == 7, F.lit("N/A")).otherwise(F.col("n_name")).alias("Zone"),
            F.when(key % 2 == 0, F.lit("Boro Zone")).otherwise(F.lit("Yellow Zone")).alias("service_zone"),
        )
    )


def short_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a few seconds or less, with microseconds, made of events."""
    millis = F.floor(F.col("value") * 10).cast("int")
    with utc(spark):
        return table(spark, sf_dir, "events").select(
            "event_id",
            F.col("ts").alias("tpep_pickup_datetime"),
            F.timestamp_add("MILLISECOND", millis, F.col("ts")).alias("tpep_dropoff_datetime"),
            F.col("value").alias("trip_distance"),
        )


def write_month_files(df: DataFrame, path: str) -> None:
    """Deliver trips by month: a folder per month, named like a monthly file."""
    (
        df.select(*TRIP_COLUMNS, F.concat(F.lit("yellow_tripdata_"), F.col(MONTH), F.lit(".parquet")).alias("file"))
        .hint("rebalance", F.col("file"))
        .write.mode("overwrite").partitionBy("file").parquet(path)
    )


def write_zone_file(df: DataFrame, path: str) -> None:
    """The lookup as CSV, a missing attribute as an empty field."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CPU and memory counters of one trace per user and event type, made of events.

    They grow with the event, but not always: some pairs of samples do not advance.
    """
    event, value = F.col("event_id"), F.floor("value").cast("long")
    with utc(spark):
        return table(spark, sf_dir, "events").select(
            F.col("user_id").cast("string").alias("trace"),
            F.col("event_type").alias("phase"),
            (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("monotonic_seconds"),
            (event * 2 - value * 40).alias("user"), F.lit(5).cast("long").alias("nice"), event.alias("system"),
            (event * 3).alias("idle"), value.alias("iowait"), F.lit(0).cast("long").alias("irq"),
            (event % 7).alias("softirq"), F.lit(0).cast("long").alias("steal"),
            (F.lit(4_000_000) + event % 1024).alias("mem_total_kib"), (value * 1000).alias("mem_available_kib"),
            F.lit(2_000_000).cast("long").alias("swap_total_kib"), (event % 9973).alias("swap_free_kib"),
        )


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested metrics document per event: an event is a run, its type a variant."""
    value, event = F.col("value"), F.col("event_id")
    trials = F.when(event % 2 == 0, F.array(value, value * 3, value * 2)).otherwise(
        F.array(value * 4, value, value * 3, value * 2))
    checks = F.array(*[
        F.struct(event.alias("rows"), text.alias("speed_sum"))
        for text in (F.when(event % 10 == 0, F.lit("nan")).otherwise(event.cast("string")), F.lit(None).cast("string"))
    ])
    return table(spark, sf_dir, "events").select(
        event.cast("string").alias("run_id"), F.col("event_type").alias("variant"),
        F.lit("completed").alias("status"), event.alias("input_rows"), (value / 4).alias("pipeline_seconds"),
        F.struct(
            (value * 5).alias("warmup_seconds_not_in_median"), trials.alias("timed_runs_seconds"),
            checks.alias("execution_checks"),
        ).alias("feature_stage"),
    )


def variant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics document per user and event type, with whole hundredths as seconds."""
    hundredths = F.sum(F.floor(F.col("value") * 100).cast("long"))
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(
        (hundredths / F.lit(100.0)).alias("pipeline_seconds")
    ).select(F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("variant"), "pipeline_seconds")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundredths = F.floor("o_totalprice").cast("long")
    with utc(spark):
        number = F.year("o_orderdate") * 12 + F.month("o_orderdate")
        return table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("key"),
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            F.month("o_orderdate").alias("month_of_year"),
            number.cast("long").alias("rows"),
            F.concat((F.floor(hundredths / 100)).cast("string"), F.lit("."),
                     F.lpad((hundredths % 100).cast("string"), 2, "0")).alias("seconds"),
        )


def _write_lines(runs: DataFrame, lines, path: str) -> None:
    # Part files follow each other in key order, and so do the lines in each.
    (
        runs.repartitionByRange("key").sortWithinPartitions("key")
        .select(F.explode(lines).alias("value")).write.mode("overwrite").text(path)
    )


def _completed_line():
    return F.format_string("Completed %s: %s rows, %s seconds", "month", F.format_number("rows", 0), "seconds")


def write_completion_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A completion line per order, with other lines between them."""
    noise = F.concat(F.lit("Processing "), F.col("month"))
    _write_lines(_runs(spark, sf_dir), F.array(noise, _completed_line()), path)


def _attempt(spark: SparkSession):
    """The lines of a run: its execution, in its own file and the shared one, and its write."""
    with utc(spark):
        started = F.timestamp_seconds(F.lit(1_790_000_000) + F.col("key") * 2)
        at = lambda millis: F.date_format(F.timestamp_add("MILLISECOND", F.lit(millis), started),
                                          "yyyy-MM-dd HH:mm:ss,SSS")
        session = F.concat(F.lit("/logs/session_"), (F.col("key") % 5).cast("string"), F.lit("/data/"))
        executed = F.concat(F.lit(":"), at(0), F.lit(" INFO -- Dataset dataset_"), F.col("key").cast("string"),
                            F.lit("_0 execution finished in "), F.col("seconds"), F.lit(" seconds"))
        written = F.concat(session, F.lit("shared.log:"), at(700), F.lit(" INFO -- Data sink Parquet finished. "),
                           F.col("rows").cast("string"), F.lit(" rows and 7.5MiB data written."))
        return F.array(
            F.concat(session, F.lit("dataset_"), F.col("key").cast("string"), F.lit("_0.log"), executed),
            F.concat(session, F.lit("shared.log"), executed), written)


def write_attempt_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Completion lines in the first half of a year; executions, twice each, and writes in the second."""
    lines = F.when(F.col("month_of_year") <= 6, F.array(_completed_line())).otherwise(_attempt(spark))
    with utc(spark):
        _write_lines(_runs(spark, sf_dir), lines, path)


def _equal_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the second half of each year; months 7 to 9 share a number of rows, and so do 10 to 12.

    In odd years only the last run of a month counts, so that there are as many writes as
    months; in even years every run does.
    """
    with utc(spark):
        runs = _runs(spark, sf_dir).filter("month_of_year > 6")
        half = F.when(F.col("month_of_year") <= 9, F.lit(0)).otherwise(F.lit(1))
        year = F.substring("month", 1, 4).cast("long")
        last = runs.groupBy("month").agg(F.max("key").alias("last_key"))
        runs = runs.withColumn("rows", year * 2 + half).join(last, "month")
        return runs.filter((year % 2 == 0) | (F.col("key") == F.col("last_key"))).drop("last_key")


def write_equal_sizes_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """An execution and a write per run, where months share their number of rows."""
    with utc(spark):
        _write_lines(_equal_sizes(spark, sf_dir), _attempt(spark), path)


def equal_size_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _equal_sizes(spark, sf_dir).select("month", "rows").distinct()


def write_month_texts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The keys of the orders of each month, a line each, as one text file per month."""
    with utc(spark):
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("string").alias("value"),
            F.concat(F.lit("yellow_tripdata_"), F.date_format("o_orderdate", "yyyy-MM"), F.lit(".txt")).alias("file"))
        orders.repartition("file").write.mode("overwrite").partitionBy("file").text(path)


def write_type_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One indented metrics document per event type, each a file."""
    documents = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    text = F.to_json(F.struct(
        F.col("event_type").alias("run_id"), F.lit("all").alias("variant"), F.lit("completed").alias("status"), F.col("n").alias("input_rows"),
        F.col("high").alias("pipeline_seconds"),
        F.struct(F.col("low").alias("warmup_seconds_not_in_median"), F.array("high", "low", "high").alias("timed_runs_seconds")).alias("feature_stage"),
    ), {"pretty": "true"})
    documents.select(text.alias("value"), F.col("event_type").alias("name")).repartition("name").write.mode("overwrite").partitionBy("name").text(path)


def month_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month of the runs in the attempt log."""
    return _runs(spark, sf_dir).select("month", "rows").distinct()
