"""The registered queries: one per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import proxies as P
from faremill.functions.canonical import canonical_record, kinds_of
from faremill.functions.clock import timestamp_text
from faremill.functions.units import finite_text, gib, kib_to_mib, used_mib
from faremill.operators.batches import map_batches
from faremill.operators.clean import (
    add_speed, add_time_features, count_cleaning, drop_copies, drop_missing, keep_valid)
from faremill.operators.compare import diff_examples, diff_multiset, row_multiplicity
from faremill.operators.metrics import busy_percent, execution_checks, phase_maxima, trial_medians, variant_ratios
from faremill.operators.months import commit_months, committed_months, delivered_months, pending_months
from faremill.operators.profile import (
    by_delivered_month, by_written_month, dataset_totals, file_report, manifest_changes, month_report, report_totals)
from faremill.operators.runlog import completed_lines, last_per_month, log_events, reconstruct, runtime_totals
from faremill.operators.stage import cached, feature_stage, speed_check
from faremill.operators.zones import duplicate_keys, join_zone, unmatched_zones, zone_side
from faremill.plans.evidence import prepare_subset, validate_export, write_comparison
from faremill.plans.export import build_output, export_trips, joined_trips
from faremill.plans.incremental import export_delivery
from faremill.plans.months import export_months, read_months
from faremill.schemas import MONTH, OUTPUT_COLUMNS, RUN_REPORT, TRIP_COLUMNS
from faremill.session import scratch_path, utc
from faremill.sources.documents import read_log, read_metrics, read_samples
from faremill.sources.files import file_digests, list_files, read_output, sorted_paths
from faremill.sources.footers import path_footers, profile_files
from faremill.sources.sinks import write_documents, write_report, write_subset, write_table
from faremill.sources.trips import first_rows, read_trip_months, read_trips
from faremill.sources.zones import read_zones
from faremill.streaming.months import stream_months

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The month files come in two deliveries, cut here.
SECOND_DELIVERY = "1996-01"
SUBSET_ROWS = 5_000
EMPTIED = "1990-01"
VARIANTS = ["click", "error", "purchase", "signup", "view"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _as_text(df: DataFrame) -> DataFrame:
    """Both source timestamps as text."""
    with utc(df.sparkSession):
        return df.withColumns({c: timestamp_text(F.col(c)) for c in df.columns if c.startswith("tpep_")})


def _delivered(spark: SparkSession, sf_dir: str) -> str:
    """Month files in the shared folder."""
    path = scratch_path(spark, "trips")
    P.write_month_files(P.trips(spark, sf_dir), path)
    return path


def _lookup_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "zones")
    P.write_zone_file(P.zones(spark, sf_dir), path)
    return path


# --- the whole job -------------------------------------------------------------------


@query
def clean_enrich_export(spark, sf_dir):
    return build_output(P.trips(spark, sf_dir), P.zones(spark, sf_dir))


@query
def clean_enrich_udf(spark, sf_dir):
    return build_output(P.trips(spark, sf_dir), P.zones(spark, sf_dir), how="udf")


@query
def clean_enrich_pandas(spark, sf_dir):
    return build_output(P.trips(spark, sf_dir), P.zones(spark, sf_dir), how="pandas")


@query
def clean_enrich_month_scope(spark, sf_dir):
    return build_output(P.trips(spark, sf_dir), P.zones(spark, sf_dir), scope=MONTH, unit="fraction", invalid="nan")


@query
def export_roundtrip(spark, sf_dir):
    """Month files and CSV lookup in, Parquet out, columns checked, read back."""
    output = scratch_path(spark, "export")
    export_trips(spark, _delivered(spark, sf_dir), _lookup_file(spark, sf_dir), output)
    return read_output(spark, output)


# --- sources -------------------------------------------------------------------------


@query
def project_trip_columns(spark, sf_dir):
    return _as_text(P.trips(spark, sf_dir).select(*TRIP_COLUMNS))


@query
def trip_files_scan(spark, sf_dir):
    return _as_text(read_trips(spark, _delivered(spark, sf_dir)))


@query
def trip_months_scan(spark, sf_dir):
    return _as_text(read_trip_months(spark, _delivered(spark, sf_dir)))


@query
def mixed_types_scan(spark, sf_dir):
    """Months with narrow and with wide keys, read as one table."""
    path, trips = scratch_path(spark, "trips"), P.trips(spark, sf_dir)
    wide = {name: F.col(name).cast("long") for name in ("VendorID", "PULocationID", "DOLocationID")}
    early = F.col(MONTH) < SECOND_DELIVERY
    P.write_month_files(trips.filter(early), f"{path}/narrow")
    P.write_month_files(trips.filter(~early).withColumns(wide), f"{path}/wide")
    return _as_text(read_trips(spark, path))


@query
def one_month_scan(spark, sf_dir):
    return _as_text(read_trip_months(spark, _delivered(spark, sf_dir), ["1990-01"]))


@query
def month_from_file_name(spark, sf_dir):
    trips = read_trip_months(spark, _delivered(spark, sf_dir))
    return trips.groupBy(MONTH).agg(F.count(F.lit(1)).alias("trips"))


@query
def lookup_csv_roundtrip(spark, sf_dir):
    return read_zones(spark, _lookup_file(spark, sf_dir))


@query
def fixed_subset(spark, sf_dir):
    rows = first_rows(spark, f"{sf_dir}/events.parquet", SUBSET_ROWS,
                      ["event_id", "user_id", "event_type", "value"])
    subset = scratch_path(spark, "subset")
    write_table(rows, subset)
    return spark.read.parquet(subset)


@query
def subset_file(spark, sf_dir):
    """The same subset as one Snappy file."""
    rows = first_rows(spark, f"{sf_dir}/events.parquet", SUBSET_ROWS,
                      ["event_id", "user_id", "event_type", "value"])
    subset = scratch_path(spark, "subset")
    write_subset(rows, subset)
    return spark.read.parquet(subset)


@query
def file_listing(spark, sf_dir):
    return list_files(spark, sf_dir).select("file_name")


@query
def file_rows(spark, sf_dir):
    return profile_files(spark, sf_dir).select("file_name", "rows")


@query
def ordered_listing(spark, sf_dir):
    """Names in the order in which the listing gives them; the listing is of files, not of rows."""
    names = [row["file_name"] for row in sorted_paths(spark, sf_dir).collect()]
    return spark.createDataFrame(list(enumerate(names, 1)), "place long, file_name string")


@query
def delivered_month_bytes(spark, sf_dir):
    """Bytes and files per month, from a listing of text files whose content SQL knows."""
    path = scratch_path(spark, "texts")
    P.write_month_texts(spark, sf_dir, path)
    return delivered_months(spark, path, "*.txt").select(F.col(MONTH).alias("month"), "files", "bytes")


@query
def indexed_file_rows(spark, sf_dir):
    """Rows per file from an index of footers that was made before and is asked again."""
    index = scratch_path(spark, "index")
    path_footers(spark, [f"{sf_dir}/orders.parquet", f"{sf_dir}/nation.parquet"], index).count()
    return path_footers(spark, sf_dir, index).select("file_name", "rows", F.size("columns").alias("columns"))


@query
def subset_manifest(spark, sf_dir):
    """The manifest of a fixed subset of one month: rows asked for, there and taken, and the schema.

    The month is a folder of part files, as many as tasks write it; they share these columns.
    """
    trips, subset, manifest = (scratch_path(spark, name) for name in ("trips", "subset", "manifest"))
    month = P.trips(spark, sf_dir).filter(F.col(MONTH) == EMPTIED).drop(MONTH)
    with P.sized_trips(spark, sf_dir):
        month.write.parquet(f"{trips}/yellow_tripdata_{EMPTIED}.parquet")
    found = prepare_subset(spark, trips, _lookup_file(spark, sf_dir), subset, manifest, 1000)
    shown = found.select("role", "requested_rows", "source_file_rows", "input_rows", "subset_schema")
    return shown.filter("role <> 'lookup'").distinct()


# --- cleaning and features -----------------------------------------------------------


@query
def required_not_null(spark, sf_dir):
    return _as_text(drop_missing(P.trips(spark, sf_dir)))


@query
def distinct_global(spark, sf_dir):
    return _as_text(drop_copies(P.trips(spark, sf_dir)))


@query
def distinct_by_month(spark, sf_dir):
    return _as_text(drop_copies(P.trips(spark, sf_dir), MONTH))


@query
def valid_trips(spark, sf_dir):
    return _as_text(keep_valid(P.trips(spark, sf_dir)))


@query
def timestamp_texts(spark, sf_dir):
    return add_time_features(P.short_trips(spark, sf_dir)).select("event_id", "pickup_timestamp", "dropoff_timestamp")


@query
def duration_seconds(spark, sf_dir):
    return add_time_features(P.short_trips(spark, sf_dir)).select("event_id", "trip_duration_hours")


@query
def duration_fraction(spark, sf_dir):
    return add_time_features(P.short_trips(spark, sf_dir), "fraction").select("event_id", "trip_duration_hours")


def _speed(spark, sf_dir, how, invalid="null"):
    timed = add_time_features(P.short_trips(spark, sf_dir))
    return add_speed(timed, how, invalid).select("event_id", "average_speed_mph")


@query
def speed_guarded(spark, sf_dir):
    return _speed(spark, sf_dir, "native")


@query
def speed_try_divide(spark, sf_dir):
    return _speed(spark, sf_dir, "try_divide")


@query
def speed_unguarded_negative(spark, sf_dir):
    """The unguarded quotient over durations of which some are below zero."""
    timed = add_time_features(P.short_trips(spark, sf_dir))
    hours = F.when(F.col("event_id") % 5 == 0, -F.col("trip_duration_hours")).otherwise(F.col("trip_duration_hours"))
    return add_speed(timed.withColumn("trip_duration_hours", hours), "try_divide").select("event_id", "average_speed_mph")


@query
def speed_udf_nan(spark, sf_dir):
    return _speed(spark, sf_dir, "udf", "nan")


@query
def speed_pandas_nan(spark, sf_dir):
    return _speed(spark, sf_dir, "pandas", "nan")


@query
def speed_nan(spark, sf_dir):
    return _speed(spark, sf_dir, "native", "nan")


@query
def speed_udf(spark, sf_dir):
    return _speed(spark, sf_dir, "udf")


@query
def speed_pandas(spark, sf_dir):
    return _speed(spark, sf_dir, "pandas")


@query
def speed_map_batches(spark, sf_dir):
    """The batch hook: filter, rename and arithmetic on frames."""
    timed = add_time_features(P.short_trips(spark, sf_dir), "fraction").select(
        "event_id", "trip_distance", "trip_duration_hours")

    def features(batch: pd.DataFrame) -> pd.DataFrame:
        moving = batch[batch["trip_duration_hours"] > 0]
        return moving.assign(average_speed_mph=moving["trip_distance"] / moving["trip_duration_hours"])

    schema = T.StructType([*timed.schema.fields, T.StructField("average_speed_mph", T.DoubleType())])
    return map_batches(timed, features, schema)


@query
def speed_check_sum(spark, sf_dir):
    output = build_output(P.trips(spark, sf_dir), P.zones(spark, sf_dir))
    return speed_check(output).select("rows", F.round("speed_sum", 4).alias("speed_sum"))


@query
def speed_sum_not_finite(spark, sf_dir):
    """The sum over speeds with NaN is not a number, and is written as text."""
    return speed_check(speed_nan(spark, sf_dir)).select("rows", "speed_sum_text")


@query
def feature_columns(spark, sf_dir):
    return feature_stage(add_speed(joined_trips(P.trips(spark, sf_dir), P.zones(spark, sf_dir))))


@query
def cached_stage(spark, sf_dir):
    """The feature stage over a cached table, with what the cache says before, inside and after."""
    table = feature_stage(add_speed(joined_trips(P.trips(spark, sf_dir), P.zones(spark, sf_dir))))
    before = table.is_cached
    with cached(table) as held:
        inside, row = held.is_cached, speed_check(held).first()
    return spark.createDataFrame([(row["rows"], round(row["speed_sum"], 4), before, inside, held.is_cached)],
                                 "rows long, speed_sum double, before boolean, inside boolean, after boolean")


@query
def export_seconds(spark, sf_dir):
    """The seconds that an export reports, and the rows that it wrote meanwhile."""
    output = scratch_path(spark, "export")
    seconds = export_trips(spark, _delivered(spark, sf_dir), _lookup_file(spark, sf_dir), output)
    return read_output(spark, output).agg(F.count(F.lit(1)).alias("rows")).withColumn("measured", F.lit(seconds > 0))


@query
def cleaning_counts(spark, sf_dir):
    return count_cleaning(P.trips(spark, sf_dir))


# --- zones ---------------------------------------------------------------------------


@query
def lookup_empty_text(spark, sf_dir):
    """Empty text in the lookup becomes the default, as missing text does."""
    zones = P.zones(spark, sf_dir)
    emptied = zones.withColumn("Borough", F.when(F.col("LocationID") % 4 == 1, F.lit("")).otherwise(F.col("Borough")))
    return zone_side(emptied, "PULocationID", "pickup")


@query
def zone_defaults(spark, sf_dir):
    return zone_side(P.zones(spark, sf_dir), "PULocationID", "pickup")


@query
def join_pickup(spark, sf_dir):
    return _as_text(join_zone(P.trips(spark, sf_dir), P.zones(spark, sf_dir), "PULocationID", "pickup"))


@query
def join_dropoff(spark, sf_dir):
    return _as_text(join_zone(P.trips(spark, sf_dir), P.zones(spark, sf_dir), "DOLocationID", "dropoff"))


@query
def join_pickup_shuffled(spark, sf_dir):
    """The same join as for a lookup that is too large to broadcast."""
    trips, zones = P.trips(spark, sf_dir), P.zones(spark, sf_dir)
    return _as_text(join_zone(trips, zones, "PULocationID", "pickup", small=False))


@query
def unmatched_pickup_zones(spark, sf_dir):
    return unmatched_zones(P.trips(spark, sf_dir), P.zones(spark, sf_dir))


@query
def zone_key_check(spark, sf_dir):
    zones = P.zones(spark, sf_dir)
    return duplicate_keys(zones.unionAll(zones.filter("LocationID = 5")))


# --- profiles and reports ------------------------------------------------------------


@query
def file_profile(spark, sf_dir):
    return file_report(profile_files(spark, sf_dir))


@query
def file_totals(spark, sf_dir):
    return dataset_totals(profile_files(spark, sf_dir)).select("files", "rows")


@query
def output_validation(spark, sf_dir):
    output = scratch_path(spark, "export")
    write_table(clean_enrich_export(spark, sf_dir), output)
    return validate_export(spark, output).select("rows", "schemas")


@query
def delivered_month_report(spark, sf_dir):
    profile = by_delivered_month(profile_files(spark, _delivered(spark, sf_dir)))
    return month_report(profile).select("month", "rows")


def _exported(spark, sf_dir):
    output = scratch_path(spark, "months")
    report = export_months(spark, _delivered(spark, sf_dir), P.zones(spark, sf_dir), output,
                           scratch_path(spark, "ledger"))
    return output, report


@query
def month_report_rows(spark, sf_dir):
    _, report = _exported(spark, sf_dir)
    return report.select("month", "rows")


@query
def report_csv(spark, sf_dir):
    """The run report as CSV, read back."""
    _, report = _exported(spark, sf_dir)
    path = scratch_path(spark, "report")
    write_report(report, path)
    return spark.read.schema(RUN_REPORT).option("header", True).csv(path).select("month", "rows")


@query
def report_in_order(spark, sf_dir):
    """Months in the order in which the run report gives them."""
    _, report = _exported(spark, sf_dir)
    months = [(place, row["month"]) for place, row in enumerate(report.select("month").collect(), 1)]
    return spark.createDataFrame(months, "place long, month string")


@query
def gib_totals(spark, sf_dir):
    return P.table(spark, sf_dir, "customer").select("c_custkey", gib(F.col("c_custkey") * F.lit(3 << 20)).alias("gib"))


@query
def month_report_bytes(spark, sf_dir):
    _, report = _exported(spark, sf_dir)
    return report


@query
def month_totals(spark, sf_dir):
    _, report = _exported(spark, sf_dir)
    return report_totals(report).select("months", "rows")


@query
def written_month_rows(spark, sf_dir):
    output, _ = _exported(spark, sf_dir)
    return month_report(by_written_month(profile_files(spark, output))).select("month", "rows")


@query
def file_manifest(spark, sf_dir):
    return file_digests(spark, sf_dir, "*.parquet").select("file_name", "bytes", "sha256")


@query
def digests_any_size(spark, sf_dir):
    """Digest and bytes of one text file per nation."""
    path = scratch_path(spark, "texts")
    P.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").repartition("n_nationkey").write.partitionBy(
        "n_nationkey").text(path)
    digests = file_digests(spark, path, "*.txt")
    return digests.select(F.regexp_extract("file_path", r"n_nationkey=(\d+)", 1).cast("int").alias("n_nationkey"), "bytes", "sha256")


@query
def file_manifest_changes(spark, sf_dir):
    """A stored manifest with one other digest, one file less and one file more."""
    present = file_digests(spark, sf_dir, "*.parquet")
    name = F.col("file_name")
    stored = present.filter(name != "region.parquet").select(
        F.when(name == "nation.parquet", F.lit("gone.parquet")).otherwise(name).alias("file_name"),
        F.when(name == "orders.parquet", F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"))
    return manifest_changes(stored, present).select("file_name", "change")


# --- comparison ----------------------------------------------------------------------


def _scopes(spark, sf_dir):
    trips, zones = P.trips(spark, sf_dir), P.zones(spark, sf_dir)
    return {
        "whole": build_output(trips, zones),
        "month": build_output(trips, zones, scope=MONTH).select(*OUTPUT_COLUMNS),
    }


@query
def trip_multiplicity(spark, sf_dir):
    return row_multiplicity(_as_text(P.trips(spark, sf_dir).select(*TRIP_COLUMNS)))


@query
def canonical_records(spark, sf_dir):
    timed = add_speed(add_time_features(P.short_trips(spark, sf_dir)))
    columns = ["event_id", "pickup_timestamp", "trip_distance", "trip_duration_hours", "average_speed_mph"]
    return timed.select("event_id", canonical_record(kinds_of(timed, columns)).alias("record"))


@query
def multiset_diff(spark, sf_dir):
    return diff_multiset(_scopes(spark, sf_dir))


@query
def multiset_equal(spark, sf_dir):
    """Three forms of the speed over one table, compared in one go."""
    trips, zones = P.trips(spark, sf_dir), P.zones(spark, sf_dir)
    return diff_multiset({how: build_output(trips, zones, how=how) for how in ("udf", "native", "pandas")})


@query
def mismatch_examples(spark, sf_dir):
    scopes = _scopes(spark, sf_dir)
    return diff_examples(scopes["whole"], scopes["month"], names=("whole", "month"))


@query
def speed_forms_compared(spark, sf_dir):
    """Forms of the speed over very short trips: two agree, the third has NaN where they have null."""
    forms = {"udf": _speed(spark, sf_dir, "udf"), "native": _speed(spark, sf_dir, "native"),
             "pandas_nan": _speed(spark, sf_dir, "pandas", "nan")}
    return diff_multiset(forms)


@query
def comparison_tables(spark, sf_dir):
    """The summary of a comparison of three exports, read back: pairs next to the rows and schemas of both sides."""
    exports = {name: scratch_path(spark, f"export-{name}") for name in ("whole", "month", "again")}
    scopes = _scopes(spark, sf_dir)
    with P.sized_trips(spark, sf_dir):
        for name, path in exports.items():
            write_table(scopes["month" if name == "month" else "whole"], path)
    path = scratch_path(spark, "summary")
    write_comparison(spark, exports, "whole", path)
    summary = spark.read.json(f"{path}/summary")
    sides = summary.select(F.inline("datasets")).select("name", "rows", "schemas")
    examples = summary.select(F.inline("mismatch_examples")).groupBy("left", "right").agg(F.count(F.lit(1)).alias("examples"))
    pairs = summary.select(F.inline("comparisons")).join(examples, ["left", "right"], "left").fillna(0, ["examples"])
    for side in ("left", "right"):
        pairs = pairs.join(sides.select(F.col("name").alias(side), F.col("rows").alias(f"{side}_rows"), F.col("schemas").alias(f"{side}_schemas")), side)
    return pairs


# --- incremental ---------------------------------------------------------------------


@query
def months_pending(spark, sf_dir):
    delivered, ledger = delivered_months(spark, _delivered(spark, sf_dir)), scratch_path(spark, "ledger")
    nothing = {name: F.lit(0) for name in ("rows", "output_bytes", "parquet_files")}
    commit_months(delivered.filter(F.col(MONTH) < SECOND_DELIVERY).withColumns(nothing), ledger, "first", 1.0)
    return pending_months(delivered, committed_months(spark, ledger)).select(MONTH)


@query
def incremental_months(spark, sf_dir):
    """Two deliveries into one folder, an export after each: the second does the new months only."""
    trips, zones = scratch_path(spark, "trips"), P.zones(spark, sf_dir)
    output, ledger = scratch_path(spark, "months"), scratch_path(spark, "ledger")
    early = F.col(MONTH) < SECOND_DELIVERY
    for number, wanted in enumerate((early, ~early)):
        P.write_month_files(P.trips(spark, sf_dir).filter(wanted), f"{trips}/{number}")
        export_months(spark, trips, zones, output, ledger)
    return read_months(spark, output)


@query
def incremental_global(spark, sf_dir):
    """Two deliveries with copies across them, an export after each: the whole is the export of both at once."""
    trips, zones = scratch_path(spark, "trips"), P.zones(spark, sf_dir)
    output, seen = scratch_path(spark, "deliveries"), scratch_path(spark, "seen")
    early = F.col(MONTH) < SECOND_DELIVERY
    for number, wanted in enumerate((early, ~early)):
        P.write_month_files(P.trips(spark, sf_dir).filter(wanted), f"{trips}/{number}")
        export_delivery(spark, trips, zones, output, seen)
    return read_output(spark, output)


@query
def streamed_months(spark, sf_dir):
    """As above with the stream; lines 1 and 2 of the later months come first, in files of their own."""
    trips, zones = scratch_path(spark, "trips"), P.zones(spark, sf_dir)
    output, ledger, checkpoint = (scratch_path(spark, name) for name in ("months", "ledger", "stream"))
    early = (F.col(MONTH) < SECOND_DELIVERY) | (F.col("VendorID") <= 2)
    for number, wanted in enumerate((early, ~early)):
        P.write_month_files(P.trips(spark, sf_dir).filter(wanted), f"{trips}/{number}")
        stream_months(spark, trips, zones, output, ledger, checkpoint)
    return read_months(spark, output)


def _delivered_twice(spark, sf_dir, first, second):
    """An export after each of two deliveries under the same names."""
    trips, zones = scratch_path(spark, "trips"), P.zones(spark, sf_dir)
    output, ledger = scratch_path(spark, "months"), scratch_path(spark, "ledger")
    for delivery in (first, second):
        P.write_month_files(delivery, trips)
        export_months(spark, trips, zones, output, ledger)
    return read_months(spark, output)


@query
def redelivered_months(spark, sf_dir):
    """Months that come again with other rows are done again."""
    trips = P.trips(spark, sf_dir)
    return _delivered_twice(spark, sf_dir, trips.withColumn("VendorID", F.col("VendorID") + 1), trips)


@query
def emptied_month(spark, sf_dir):
    """A month that comes again without a valid trip has no rows left."""
    trips = P.trips(spark, sf_dir)
    invalid = F.when(F.col(MONTH) != EMPTIED, F.col("trip_distance")).otherwise(-1.0)
    return _delivered_twice(spark, sf_dir, trips, trips.withColumn("trip_distance", invalid))


@query
def withdrawn_month(spark, sf_dir):
    """A month whose files are gone has no rows left."""
    trips = P.trips(spark, sf_dir)
    return _delivered_twice(spark, sf_dir, trips, trips.filter(F.col(MONTH) != EMPTIED))


# --- metrics and logs ----------------------------------------------------------------


def _samples(spark, sf_dir):
    counted = busy_percent(P.counters(spark, sf_dir), ["trace", "phase"])
    return counted.select(
        "trace", "phase", "monotonic_seconds",
        kib_to_mib(F.col("mem_total_kib")).alias("host_ram_total_mib"),
        used_mib(F.col("mem_total_kib"), F.col("mem_available_kib")).alias("host_ram_used_mib"),
        used_mib(F.col("swap_total_kib"), F.col("swap_free_kib")).alias("host_swap_used_mib"),
        "host_cpu_busy_percent",
    )


@query
def counter_rate(spark, sf_dir):
    return _samples(spark, sf_dir)


@query
def resource_maxima(spark, sf_dir):
    maxima = phase_maxima(_samples(spark, sf_dir), ["trace", "phase"])
    return maxima.select(
        "*", F.col("baseline.host_ram_used_mib").alias("baseline_ram_used_mib"),
        F.col("baseline.monotonic_seconds").alias("baseline_seconds")).drop("baseline")


def _documents(spark, frame):
    path = scratch_path(spark, "metrics")
    write_documents(frame, path)
    return read_metrics(spark, path, whole_files=False)


@query
def trial_median(spark, sf_dir):
    return trial_medians(_documents(spark, P.run_documents(spark, sf_dir)))


@query
def metrics_indented(spark, sf_dir):
    """Indented documents, one to a file."""
    path = scratch_path(spark, "metrics")
    P.write_type_documents(spark, sf_dir, path)
    return trial_medians(read_metrics(spark, path))


@query
def samples_jsonl(spark, sf_dir):
    """Resource samples as JSON lines, read back."""
    path = scratch_path(spark, "samples")
    write_documents(_samples(spark, sf_dir).drop("trace"), path)
    return read_samples(spark, path).select(
        "phase", "monotonic_seconds", "host_ram_total_mib", "host_ram_used_mib", "host_swap_used_mib", "host_cpu_busy_percent")


@query
def trial_checks(spark, sf_dir):
    return execution_checks(_documents(spark, P.run_documents(spark, sf_dir)))


@query
def variant_ratio(spark, sf_dir):
    return variant_ratios(_documents(spark, P.variant_documents(spark, sf_dir)), VARIANTS, "view")


@query
def finite_texts(spark, sf_dir):
    speeds = _speed(spark, sf_dir, "native", "nan")
    return speeds.select("event_id", F.isnan("average_speed_mph").alias("nan"),
                         (finite_text(F.col("average_speed_mph")) == "nan").alias("nan_text"))


@query
def finite_text_values(spark, sf_dir):
    """Texts of finite and other doubles."""
    event = F.col("event_id")
    value = F.when(event % 4 == 0, F.lit(float("nan"))).when(event % 4 == 1, F.lit(float("inf"))).when(
        event % 4 == 2, F.lit(float("-inf"))).otherwise(event.cast("double"))
    return P.table(spark, sf_dir, "events").select("event_id", finite_text(value).alias("text"))


@query
def runlog_months(spark, sf_dir):
    path = scratch_path(spark, "log")
    P.write_completion_log(spark, sf_dir, path)
    return last_per_month(completed_lines(log_events(read_log(spark, path))))


@query
def runlog_totals(spark, sf_dir):
    totals = runtime_totals(runlog_months(spark, sf_dir))
    return totals.select("months", F.round("total_seconds", 2).alias("total_seconds"),
                         F.round("total_minutes", 3).alias("total_minutes"))


@query
def runlog_reconstruct(spark, sf_dir):
    path = scratch_path(spark, "log")
    P.write_attempt_log(spark, sf_dir, path)
    return reconstruct(read_log(spark, path), P.month_rows(spark, sf_dir))


@query
def runlog_equal_sizes(spark, sf_dir):
    """Months that share a number of rows, with as many writes as months, or more."""
    path = scratch_path(spark, "log")
    P.write_equal_sizes_log(spark, sf_dir, path)
    return reconstruct(read_log(spark, path), P.equal_size_rows(spark, sf_dir))
