"""Hand-made trips and zones, and files of them."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os

import pyarrow as pa
import pyarrow.parquet as pq

from faremill.schemas import MONTH, TRIPS, ZONES

ARROW_TRIPS = pa.schema([
    ("VendorID", pa.int32()), ("tpep_pickup_datetime", pa.timestamp("us")),
    ("tpep_dropoff_datetime", pa.timestamp("us")), ("passenger_count", pa.int64()),
    ("trip_distance", pa.float64()), ("PULocationID", pa.int32()), ("DOLocationID", pa.int32()),
    ("fare_amount", pa.float64()), ("total_amount", pa.float64()),
])
START = dt.datetime(2024, 5, 1, 12, 0, 0)


def trip(vendor=1, start=START, end=START + dt.timedelta(minutes=30), passengers=2, distance=6.0, pickup=1, dropoff=2,
         fare=10.0, total=12.5):
    return (vendor, start, end, passengers, distance, pickup, dropoff, fare, total)


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), TRIPS)


def month_trips(spark, *rows):
    """Rows of (month, trip)."""
    schema = TRIPS.simpleString()[len("struct<"):-1]
    return spark.createDataFrame([(*row, month) for month, row in rows], f"{schema},{MONTH}:string")


def zones(spark, *rows):
    return spark.createDataFrame(list(rows), ZONES)


def write_trip_file(folder, month, rows, row_group=1000, schema=ARROW_TRIPS, part=""):
    """A flat monthly file."""
    os.makedirs(folder, exist_ok=True)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    table = pa.table([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
    path = os.path.join(str(folder), f"yellow_tripdata_{month}{part}.parquet")
    pq.write_table(table, path, row_group_size=row_group)
    return path


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
