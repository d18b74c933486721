"""Declared schemas and column lists of every table the engine reads or writes."""

from pyspark.sql import types as T

# The trip columns that are read, in order.
TRIPS = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])
TRIP_COLUMNS = TRIPS.names

# A trip without one of these is dropped.
REQUIRED_COLUMNS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
]

# The zone lookup and its three attributes.
ZONES = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
ZONE_ATTRIBUTES = {"Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}

# The exported table, in order.
OUTPUT = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("pickup_timestamp", T.StringType()),
    T.StructField("dropoff_timestamp", T.StringType()),
    T.StructField("trip_duration_hours", T.DoubleType()),
    T.StructField("average_speed_mph", T.DoubleType()),
    T.StructField("pickup_borough", T.StringType()),
    T.StructField("pickup_zone", T.StringType()),
    T.StructField("pickup_service_zone", T.StringType()),
    T.StructField("dropoff_borough", T.StringType()),
    T.StructField("dropoff_zone", T.StringType()),
    T.StructField("dropoff_service_zone", T.StringType()),
])
OUTPUT_COLUMNS = OUTPUT.names

# The month a trip was delivered in; taken from the file, not from the pickup time.
MONTH = "source_month"

FEATURE_COLUMNS = ["trip_distance", "trip_duration_hours", "average_speed_mph"]

# One row per exported month. All months of a run share a job; what one took is estimated.
RUN_REPORT = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_seconds", T.DoubleType()),
    T.StructField("estimated_seconds", T.DoubleType()),
    T.StructField("rows", T.LongType()),
    T.StructField("output_bytes", T.LongType()),
    T.StructField("parquet_files", T.LongType()),
])

# Committed months: a month counts as done only once it has a row here that names its input,
# by files, bytes, and a hash over names, sizes and times of change.
LEDGER = T.StructType([
    T.StructField(MONTH, T.StringType()),
    T.StructField("files", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("state", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("output_bytes", T.LongType()),
    T.StructField("parquet_files", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_seconds", T.DoubleType()),
    T.StructField("committed_at", T.DoubleType()),
])

# One JSON line per resource sample.
SAMPLES = T.StructType([
    T.StructField("utc", T.StringType()),
    T.StructField("monotonic_seconds", T.DoubleType()),
    T.StructField("phase", T.StringType()),
    T.StructField("host_ram_total_mib", T.DoubleType()),
    T.StructField("host_ram_used_mib", T.DoubleType()),
    T.StructField("host_swap_used_mib", T.DoubleType()),
    T.StructField("host_cpu_busy_percent", T.DoubleType()),
])

_RESOURCES = T.StructType([
    T.StructField("scope", T.StringType()),
    T.StructField("phase", T.StringType()),
    T.StructField("sampling_interval_seconds", T.DoubleType()),
    T.StructField("samples", T.LongType()),
    T.StructField("max_observed_cpu_busy_percent", T.DoubleType()),
    T.StructField("max_observed_ram_used_mib", T.DoubleType()),
    T.StructField("max_observed_swap_used_mib", T.DoubleType()),
    T.StructField("baseline", SAMPLES),
])

# One JSON document per run. speed_sum may be a number, "nan" or null, so it is text.
RUN_METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("variant", T.StringType()),
    T.StructField("scope", T.StringType()),
    T.StructField("input_rows", T.LongType()),
    T.StructField("source_sha256", T.StringType()),
    T.StructField("environment", T.StructType([
        T.StructField("python", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("package_versions", T.MapType(T.StringType(), T.StringType())),
    ])),
    T.StructField("status", T.StringType()),
    T.StructField("cluster", T.MapType(T.StringType(), T.StringType())),
    T.StructField("pipeline_seconds", T.DoubleType()),
    T.StructField("pipeline_timer_scope", T.StringType()),
    T.StructField("pipeline_resources", _RESOURCES),
    T.StructField("feature_stage", T.StructType([
        T.StructField("warmup_seconds_not_in_median", T.DoubleType()),
        T.StructField("timed_runs_seconds", T.ArrayType(T.DoubleType())),
        T.StructField("median_seconds", T.DoubleType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("execution_checks", T.ArrayType(T.StructType([
            T.StructField("rows", T.LongType()),
            T.StructField("speed_sum", T.StringType()),
        ]))),
        T.StructField("resource_samples", T.ArrayType(_RESOURCES)),
        T.StructField("scope", T.StringType()),
        T.StructField("repetitions", T.StringType()),
        T.StructField("cached_joined_rows", T.LongType()),
        T.StructField("execution_sink", T.StringType()),
    ])),
])


# What log lines say, parsed. The kind is the folder of an event.
LOG_EVENTS = T.StructType([
    T.StructField("session", T.StringType()),
    T.StructField("at", T.LongType()),
    T.StructField("line_at", T.StructType([
        T.StructField("file_path", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("position", T.LongType()),
    ])),
    T.StructField("month", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("kind", T.StringType()),
])


class SchemaError(ValueError):
    """An input does not have the declared columns or types."""


_UPCASTS = {
    # Some months come with wide keys; a value that does not fit fails the cast.
    T.IntegerType(): (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    T.LongType(): (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    T.DoubleType(): (T.FloatType(), T.DoubleType(), T.ByteType(), T.ShortType(), T.IntegerType()),
    T.TimestampNTZType(): (T.TimestampNTZType(),),
    T.StringType(): (T.StringType(),),
}


def require_schema(actual: T.StructType, declared: T.StructType) -> None:
    """Raise unless every declared column is there with a type that widens to the declared one."""
    have = {field.name: field.dataType for field in actual}
    missing = [name for name in declared.names if name not in have]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    for field in declared:
        found = have[field.name]
        if isinstance(found, T.TimestampType):
            raise SchemaError(f"{field.name} carries a time zone; trips need wall-clock timestamps without one")
        if found not in _UPCASTS[field.dataType]:
            raise SchemaError(f"{field.name} is {found.simpleString()}, declared {field.dataType.simpleString()}")


def require_columns(names: list[str], expected: list[str] = OUTPUT_COLUMNS) -> None:
    """Raise unless the two sets of names are equal; order does not matter."""
    extra, missing = set(names) - set(expected), set(expected) - set(names)
    if extra or missing:
        raise SchemaError(f"unexpected columns {sorted(extra)}, missing columns {sorted(missing)}")
