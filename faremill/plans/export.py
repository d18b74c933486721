"""Clean, derive, enrich, export."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from faremill.operators.clean import add_speed, add_time_features, clean_trips
from faremill.operators.zones import join_zones, require_unique_keys
from faremill.schemas import MONTH, OUTPUT_COLUMNS
from faremill.session import sized
from faremill.sources.files import total_bytes
from faremill.sources.sinks import by_month, write_table
from faremill.sources.trips import read_trips
from faremill.sources.zones import read_zones


def joined_trips(trips: DataFrame, zones: DataFrame, scope: str = "global", unit: str = "second",
                 gather: bool = False) -> DataFrame:
    """Cleaned trips with time features and both zones, before the speed.

    `gather` brings each month together for a write by month. It happens while the rows are
    narrow: the joins and features that follow stay in the same tasks as the write.
    """
    cleaned = clean_trips(trips, scope)
    if gather:
        cleaned = by_month(cleaned)
    return join_zones(add_time_features(cleaned, unit), zones)


def build_output(trips: DataFrame, zones: DataFrame, scope: str = "global", unit: str = "second",
                 how: str = "native", invalid: str = "null", gather: bool = False) -> DataFrame:
    """The 17-column table, and the month as an 18th column when copies are dropped by month."""
    table = add_speed(joined_trips(trips, zones, scope, unit, gather), how, invalid)
    return table.select(*OUTPUT_COLUMNS, *([MONTH] if scope == MONTH else []))


def export_trips(spark: SparkSession, trips_path: str, zones_path: str, output_path: str,
                 how: str = "native") -> float:
    """Read, clean, enrich and export all months in one job; returns the seconds it took."""
    started = time.monotonic()
    zones = read_zones(spark, zones_path)
    require_unique_keys(zones)
    table = build_output(read_trips(spark, trips_path), zones, how=how)
    with sized(spark, total_bytes(spark, trips_path)):
        write_table(table, output_path)
    return time.monotonic() - started
