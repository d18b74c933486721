"""Trip files: Parquet, one file (or one folder of part files) per month.

Spark takes the schema of a scan from one footer, and gives nulls for a column that another
file lacks. So the footers of the files to be read are looked at first, in one pass over an
index: a file without a trip column is an error, and files whose types differ are read in
groups of equal types, each cast to the declared ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremill.functions.text import delivery_of, month_of
from faremill.schemas import MONTH, TRIP_COLUMNS, TRIPS, SchemaError, require_schema
from faremill.sources.files import first_path, list_files
from faremill.sources.footers import indexed_footers, kind_of, numbered, timed
from faremill.sources.stores import readable


def read_trips(spark: SparkSession, path: str | list[str], index_path: str | None = None) -> DataFrame:
    """All months under a path as one table of the nine trip columns."""
    return _union([_declared(scan) for scan in _scans(spark, path, list_files(spark, path), index_path)])


def read_trip_months(spark: SparkSession, path: str | list[str], months: list[str] | None = None,
                     index_path: str | None = None) -> DataFrame:
    """As `read_trips`, with the month taken from the name of the file.

    Naming months drops the other files when the scan is planned, since the filter looks only
    at the file's metadata; their footers are not opened either.
    """
    month, files = _month(), list_files(spark, path)
    if months is not None:
        files = files.filter(month_of(F.col("file_name"), F.col("file_path")).isin(months))
    scans = _scans(spark, path, files, index_path)
    if months is not None:
        scans = [scan.filter(month.isin(months)) for scan in scans]
    return _union([_declared(scan, month.alias(MONTH)) for scan in scans])


def read_trip_files(spark: SparkSession, files: DataFrame, index_path: str | None = None) -> DataFrame:
    """As `read_trip_months`, of the files of a listing, which must name few enough to be planned one by one."""
    rows = numbered(files).select("file_path", "file_name", "bytes", "modified").collect()
    files = timed(spark.createDataFrame(rows, "file_path string, file_name string, bytes long, modified long"))
    scans = _scans(spark, [readable(row["file_path"]) for row in rows], files, index_path)
    return _union([_declared(scan, _month().alias(MONTH)) for scan in scans])


def first_rows(spark: SparkSession, path: str, rows: int, columns: list[str] | None = None) -> DataFrame:
    """The first rows, in stored order, of the first file by name.

    The position of a row in its file comes from the scan, so nothing is sorted and the
    other files are not opened.
    """
    if rows < 1:
        raise ValueError("rows must be positive")
    kept = _scan(spark, readable(first_path(spark, path))).filter(F.col("_metadata.row_index") < rows)
    return kept.select(*columns) if columns else _declared(kept)


def first_delivery(spark: SparkSession, path: str) -> DataFrame:
    """The listing of the first month by name: its file, or the part files of its folder."""
    files = list_files(spark, path).withColumn("delivery", delivery_of(F.col("file_name"), F.col("file_path")))
    first = files.agg(F.min_by("delivery", "file_path")).first()[0]
    if first is None:
        raise FileNotFoundError(f"no trip file under {path}")
    return files.filter(F.col("delivery") == first).drop("delivery")


def first_trips(spark: SparkSession, facts: DataFrame, rows: int, place: str = "place") -> DataFrame:
    """The first rows of the files of which these are the facts: by name, then in stored order, which is in `place`.

    The footers tell how many rows lie before a file, so only files that hold some of the rows
    are opened, `rows` at most and empty ones between them.
    """
    if rows < 1:
        raise ValueError("rows must be positive")
    before = F.sum("rows").over(Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    wanted = facts.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < rows)
    paths = [readable(row["file_path"]) for row in wanted.select("file_path").collect()]
    row_of = (F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    scans = _union([_declared(scan, *row_of) for scan in _scans(spark, paths, wanted, None)])
    placed = scans.join(F.broadcast(wanted.select("file_path", "before")), "file_path")
    return placed.withColumn(place, F.col("before") + F.col("row_index")).filter(F.col(place) < rows).select(*TRIP_COLUMNS, place)


def stream_trip_months(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    """The month, path, name, size and time of new trip files, as a stream; no column is read."""
    return (
        spark.readStream.schema(TRIPS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
        .select(_month().alias(MONTH), F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                F.col("_metadata.file_size").alias("bytes"), F.col("_metadata.file_modification_time").alias("modified"))
    )


def _scans(spark: SparkSession, path: str | list[str], files: DataFrame, index_path: str | None) -> list[DataFrame]:
    """A scan of a path for each set of types that the files of a listing of it have."""
    facts = indexed_footers(files, index_path).select("file_path", kind_of(TRIP_COLUMNS).alias("kind"))
    # A row per set of types, with one of the files that have it.
    kinds = facts.groupBy("kind").agg(F.count(F.lit(1)).alias("files"), F.min("file_path").alias("sample")).orderBy("kind").collect()
    lacking = [row for row in kinds if len(_columns(row["kind"])) < len(TRIP_COLUMNS)]
    if lacking:
        named = facts.filter(F.col("kind").isin([row["kind"] for row in lacking])).orderBy("file_path").limit(20).collect()
        names = ", ".join(f"{r['file_path']} ({', '.join(c for c in TRIP_COLUMNS if c not in _columns(r['kind']))})" for r in named)
        raise SchemaError(f"{sum(row['files'] for row in lacking)} trip files lack columns: {names}")
    if len(kinds) <= 1:
        sample = [readable(row["sample"]) for row in kinds]
        return [_scan(spark, path, spark.read.parquet(*sample).schema if sample else None)]
    # File names come to the driver only where types differ.
    return [_scan(spark, [readable(r["file_path"]) for r in facts.filter(F.col("kind") == row["kind"]).select("file_path").collect()],
                  spark.read.parquet(readable(row["sample"])).schema) for row in kinds]


def _columns(kind: str) -> list[str]:
    return [line.partition(": ")[0] for line in kind.split("\n") if line]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _scan(spark: SparkSession, path, schema=None) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return (
        reader.option("mergeSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )


def _month() -> Column:
    return month_of(F.col("_metadata.file_name"), F.col("_metadata.file_path"))


def _declared(raw: DataFrame, *more) -> DataFrame:
    require_schema(raw.schema, TRIPS)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRIPS], *more)
