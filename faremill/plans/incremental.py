"""Export of deliveries as they come, with copies dropped over all data.

A trip that was exported once must not come again, in whatever later file it is repeated.
Keys of exported trips, 128 bits of a hash of all nine columns, are kept in a table by bucket,
with a Bloom filter per bucket. Keys of a delivery are asked of the filters first; what these
deny is new for certain, and only the rest is joined with the stored keys. The trips that were
exported before are not read again.

A delivery is a numbered folder of the output and one of the keys, both replaced when it is
done again, and a row per file in the ledger, which comes last: a run that dies is done again
under the same number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators.clean import add_speed, add_time_features, clean_trips
from faremill.operators.zones import join_zones, require_unique_keys
from faremill.schemas import OUTPUT_COLUMNS, TRIP_COLUMNS
from faremill.session import scratch_path, sized
from faremill.sources.files import list_files
from faremill.sources.footers import STATE
from faremill.sources.sinks import write_table
from faremill.sources.trips import read_trip_files

# A bucket's filter is FILTER_BITS long and good for about a tenth as many keys; beyond that it
# skips less, and the result is the same.
BUCKETS = 256
FILTER_BITS = 1 << 20
_PROBES = 7

KEYS = "bucket int, low long, high long"
FILTERS = "bucket int, bits binary"
LEDGER = "delivery int, file_path string, bytes long, modified timestamp"


def trip_keys(buckets: int) -> list[Column]:
    """bucket, low and high: the key of a trip. Hashes take -0.0 and 0.0 for one value, as grouping does."""
    low, high = F.xxhash64(*TRIP_COLUMNS), F.xxhash64(F.lit(1), *TRIP_COLUMNS)
    return [F.pmod(high, F.lit(buckets)).cast("int").alias("bucket"), low.alias("low"), high.alias("high")]


def places(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The bits of keys in a filter, a column per probe."""
    step = (high.view(np.uint64) >> np.uint64(16)) | np.uint64(1)
    return (low.view(np.uint64)[:, None] + step[:, None] * np.arange(_PROBES, dtype=np.uint64)) % np.uint64(FILTER_BITS)


def may_hold(bits: bytes | None, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(low), bool)
    at = places(low, high)
    held = np.frombuffer(bits, np.uint8)
    return ((held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def with_keys(bits: bytes | None, low: np.ndarray, high: np.ndarray) -> bytes:
    held = np.zeros(FILTER_BITS // 8, np.uint8) if bits is None else np.frombuffer(bits, np.uint8).copy()
    at = places(low, high).ravel()
    np.bitwise_or.at(held, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    return held.tobytes()


class SeenTrips:
    """The keys of exported trips, by delivery; only deliveries of the ledger count."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def ledger(self) -> DataFrame:
        return self._read("ledger", LEDGER)

    def last(self) -> int:
        """The number of the last delivery that is done, 0 before the first."""
        return self.ledger().agg(F.coalesce(F.max("delivery"), F.lit(0))).first()[0]

    def keys(self, last: int) -> DataFrame:
        return self._read("keys", f"{KEYS}, delivery int").filter(F.col("delivery") <= last).drop("delivery")

    def filters(self, last: int) -> DataFrame:
        return self._read(f"filters/{last}", FILTERS)

    def known(self, keys: DataFrame, last: int) -> DataFrame:
        """Those of some keys that were exported before."""
        def ask(asked: pa.Table, own: pa.Table) -> pa.Table:
            bits = own["bits"][0].as_py() if own.num_rows else None
            return asked.filter(pa.array(may_hold(bits, asked["low"].to_numpy(), asked["high"].to_numpy())))

        maybe = keys.groupBy("bucket").cogroup(self.filters(last).groupBy("bucket")).applyInArrow(ask, KEYS)
        return maybe.join(self.keys(last).hint("shuffle_hash"), ["bucket", "low", "high"], "left_semi")

    def add(self, keys: DataFrame, delivery: int) -> None:
        """Store the keys of a delivery and the filters that hold them too."""
        def change(key, own: pa.Table, new: pa.Table) -> pa.Table:
            bits = own["bits"][0].as_py() if own.num_rows else None
            bits = with_keys(bits, new["low"].to_numpy(), new["high"].to_numpy())
            return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})

        folder = f"{self.path}/keys/delivery={delivery}"
        write_table(keys.hint("rebalance", F.col("bucket")), folder)
        new = self.spark.read.schema(KEYS).parquet(folder)
        write_table(self.filters(delivery - 1).groupBy("bucket").cogroup(new.groupBy("bucket")).applyInArrow(change, FILTERS),
                    f"{self.path}/filters/{delivery}")

    def commit(self, files: DataFrame, delivery: int) -> None:
        files.select(F.lit(delivery).alias("delivery"), *STATE).write.mode("append").parquet(f"{self.path}/ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:  # the first delivery makes the folders
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def export_delivery(spark: SparkSession, trips_path: str, zones: DataFrame, output_path: str, seen_path: str, how: str = "native",
                    buckets: int = BUCKETS) -> int:
    """Export the trips of new files that no earlier file had; returns the number of the last delivery.

    The output of all deliveries together equals an export of all files at once. A file that
    was exported and has changed since is an error: its trips cannot be told from others any
    more. Without new files nothing is done.
    """
    require_unique_keys(zones)
    seen = SeenTrips(spark, seen_path, buckets)
    listed, ledger, last = list_files(spark, trips_path), seen.ledger(), seen.last()
    changed = ledger.join(listed.select("file_path", F.col("bytes").alias("now"), F.col("modified").alias("since")), "file_path").filter(
        "bytes <> now OR modified <> since")
    if (row := changed.select("file_path").first()) is not None:
        raise ValueError(f"a file was exported and has changed since: {row['file_path']}")
    files = listed.join(ledger.select("file_path"), "file_path", "left_anti").select(*STATE, "file_name")
    size = files.agg(F.sum("bytes")).first()[0]
    if size is None:
        return last
    # What is exported is what the ledger will name, whatever arrives meanwhile.
    listing = scratch_path(spark, "delivery")
    write_table(files, listing)
    files, delivery = spark.read.parquet(listing), last + 1
    with sized(spark, size):
        path = scratch_path(spark, "delivered-trips")
        write_table(clean_trips(read_trip_files(spark, files, f"{seen_path.rstrip('/')}/footers")).select("*", *trip_keys(buckets)), path)
        fresh = spark.read.parquet(path)
        if last:
            known = seen.known(fresh.select("bucket", "low", "high"), last)
            fresh = fresh.join(known.hint("shuffle_hash"), ["bucket", "low", "high"], "left_anti")
        kept = scratch_path(spark, "new-trips")
        write_table(fresh, kept)
        fresh = spark.read.parquet(kept)
        table = add_speed(join_zones(add_time_features(fresh.select(*TRIP_COLUMNS)), zones), how)
        write_table(table.select(*OUTPUT_COLUMNS), f"{output_path.rstrip('/')}/delivery={delivery}")
        seen.add(fresh.select("bucket", "low", "high"), delivery)
    seen.commit(files, delivery)
    return delivery
