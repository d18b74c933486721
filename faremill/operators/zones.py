"""The zone lookup: defaults, key check and the two left joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.text import known
from faremill.schemas import ZONE_ATTRIBUTES

# A lookup goes to every task only below both limits; they are checked, not assumed.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20
SALTS = 32


def zone_side(zones: DataFrame, key: str, prefix: str) -> DataFrame:
    """The lookup under the names of one end of a trip, with defaults for missing text."""
    return zones.select(
        F.col("LocationID").alias(key),
        *[known(F.col(source)).alias(f"{prefix}_{name}") for source, name in ZONE_ATTRIBUTES.items()],
    )


def join_zone(df: DataFrame, zones: DataFrame, key: str, prefix: str, small: bool | None = None) -> DataFrame:
    """Left join one end of the trips with the lookup; an unknown id gets nulls."""
    side = zone_side(zones, key, prefix)
    if fits_broadcast(zones) if small is None else small:
        return df.join(F.broadcast(side), key, "left")
    return salted_left_join(df, side, key)


def join_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Both ends of the trips."""
    small = fits_broadcast(zones)
    picked = join_zone(df, zones, "PULocationID", "pickup", small)
    return join_zone(picked, zones, "DOLocationID", "dropoff", small)


def fits_broadcast(zones: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a lookup is within the broadcast limits; looks at one row beyond the limit at most."""
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ZONE_ATTRIBUTES]
    found = (
        zones.select(sum(widths, F.lit(16)).alias("width")).limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("width"), F.lit(0)).alias("bytes")).first()
    )
    return found["rows"] <= rows and found["bytes"] <= size


def duplicate_keys(zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """Keys that would multiply rows in a left join, with their number of rows."""
    return zones.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def require_unique_keys(zones: DataFrame, key: str = "LocationID") -> None:
    """Raise when an id occurs twice in the lookup: a join would multiply the trips of that id."""
    doubled = duplicate_keys(zones, key)
    shown = doubled.orderBy(key).limit(20).collect()
    if shown:
        raise ValueError(f"{doubled.count()} ids occur more than once in the lookup: " + ", ".join(str(r[key]) for r in shown))


def unmatched_zones(df: DataFrame, zones: DataFrame, key: str = "PULocationID") -> DataFrame:
    """Ids that the lookup lacks, with their number of trips.

    Trips are counted by id before the join, so a hot id joins as one row.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
    return counts.join(zones.select(F.col("LocationID").alias(key)), key, "left_anti")


def salted_left_join(df: DataFrame, side: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Left join with a table too large to broadcast, without a hot id going to one task.

    The table is repeated once per salt and the rows of an id spread over all salts; what is
    still uneven, adaptive execution splits. The salt is a hash of the row, so a task that
    runs again sends its rows to the same place.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Without the hint Spark might broadcast the table, now `salts` times as large.
    return salted.join(repeated.hint("shuffle_hash"), [key, "_salt"], "left").drop("_salt")
