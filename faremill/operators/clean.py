"""Cleaning: required values, exact copies, impossible trips; and the derived features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.clock import hours_by_fraction, hours_by_second, timestamp_text
from faremill.functions.speed import SPEEDS
from faremill.schemas import MONTH, REQUIRED_COLUMNS, TRIP_COLUMNS
from faremill.session import in_utc

DURATIONS = {"second": hours_by_second, "fraction": hours_by_fraction}
SCOPES = ("global", MONTH)


def has_required(df: DataFrame, columns: list[str] = REQUIRED_COLUMNS) -> Column:
    """Whether no required column is null or NaN.

    Written as separate null tests, which the Parquet scan can use; `dropna` is one opaque
    test over all columns.
    """
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    tests = [F.col(c).isNotNull() for c in columns] + [~F.isnan(c) for c in columns if c in floats]
    return reduce(lambda a, b: a & b, tests)


def is_valid() -> Column:
    """Whether a trip has a positive distance and ends after it starts."""
    return (F.col("trip_distance") > 0) & (F.col("tpep_dropoff_datetime") > F.col("tpep_pickup_datetime"))


def drop_missing(df: DataFrame, columns: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows where a required column is null or NaN."""
    return df.filter(has_required(df, columns))


def drop_copies(df: DataFrame, scope: str = "global") -> DataFrame:
    """Keep one row of each group of equal trips; null equals null.

    Copies are merged in the map tasks first, so a trip repeated without end costs one row
    per task in the shuffle. The shuffle is keyed by all columns, never by the month alone.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope is one of {SCOPES}")
    if scope == "global":
        return df.select(*TRIP_COLUMNS).dropDuplicates()
    return df.dropDuplicates(TRIP_COLUMNS + [MONTH])


def keep_valid(df: DataFrame) -> DataFrame:
    """Keep trips with a positive distance that end after they start."""
    return df.filter(is_valid())


def count_cleaning(df: DataFrame) -> DataFrame:
    """source_month, rows_in, without_required, copies, invalid, rows_out: what each step takes away per month.

    The steps are counted in their order: missing values, copies inside the month, impossible
    trips. All come from one shuffle of distinct trips with their numbers, the one that drops
    copies, and then a row per month and task. Counts are part of the rows' own job and not
    counters beside it, so work that is done again after a lost executor counts once.
    """
    trips = df.groupBy(*TRIP_COLUMNS, MONTH).agg(F.count(F.lit(1)).alias("n"))
    whole = has_required(trips)
    valid = F.coalesce(is_valid(), F.lit(False))

    def total(value: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    one, n = F.lit(1), F.col("n")
    return trips.groupBy(MONTH).agg(
        F.sum(n).alias("rows_in"), total(n, ~whole).alias("without_required"), total(n - 1, whole).alias("copies"),
        total(one, whole & ~valid).alias("invalid"), total(one, whole & valid).alias("rows_out"))


def clean_trips(df: DataFrame, scope: str = "global") -> DataFrame:
    """All cleaning steps. The filters run first, so the shuffle carries valid trips only."""
    return drop_copies(keep_valid(drop_missing(df)), scope)


@in_utc
def add_time_features(df: DataFrame, unit: str = "second") -> DataFrame:
    """Add both timestamps as text and the duration in hours."""
    start, end = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return df.withColumns({
        "pickup_timestamp": timestamp_text(start),
        "dropoff_timestamp": timestamp_text(end),
        "trip_duration_hours": DURATIONS[unit](start, end),
    })


def add_speed(df: DataFrame, how: str = "native", invalid: str = "null") -> DataFrame:
    """Add the average speed.

    `how` is native, try_divide, udf or pandas; `invalid` is what a trip without a positive
    duration gets: null or nan.
    """
    try:
        speed = SPEEDS[how, invalid]
    except KeyError:
        raise ValueError(f"no speed for how={how!r}, invalid={invalid!r}") from None
    return df.withColumn("average_speed_mph", speed(F.col("trip_distance"), F.col("trip_duration_hours")))
