"""Fixed subsets, comparison of exports, and the reports around them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators.compare import counted_bytes, differing_rows, pair_examples, unmatched_rows
from faremill.operators.metrics import trial_medians
from faremill.operators.profile import dataset_totals, distinct_schemas, manifest_changes
from faremill.schemas import OUTPUT_COLUMNS, SchemaError
from faremill.session import scratch_path, sized
from faremill.sources.files import file_digests, list_files, listed_digests, read_output
from faremill.sources.footers import indexed_footers, path_footers
from faremill.sources.sinks import write_documents, write_subset, write_table
from faremill.sources.stores import readable
from faremill.sources.trips import first_delivery, first_trips

# A fixed subset is for checks; more rows are refused.
MAX_SUBSET_ROWS = 200_000


def prepare_subset(spark: SparkSession, trips_path: str, zones_path: str, subset_path: str, manifest_path: str,
                   rows: int = MAX_SUBSET_ROWS) -> DataFrame:
    """Write the first rows of the first month, and a manifest of what went in and out.

    The month is the first file by name, or the folder of part files that it lies in. A row per
    file: its role, digest and bytes; and the rows asked for, those of the source, with all its
    part files, those that the subset has, and the schema of the subset, from the footers.
    """
    if not 1 <= rows <= MAX_SUBSET_ROWS:
        raise ValueError(f"rows must be between 1 and {MAX_SUBSET_ROWS}")
    source = indexed_footers(first_delivery(spark, trips_path))
    write_subset(first_trips(spark, source, rows, "place"), subset_path, "place")
    roles = {"source": source, "subset": list_files(spark, subset_path), "lookup": list_files(spark, zones_path, "*")}
    files = _union([listed_digests(listed).withColumn("role", F.lit(role)) for role, listed in roles.items()])
    found = path_footers(spark, subset_path).first()
    manifest = files.withColumns({
        "requested_rows": F.lit(rows), "source_file_rows": F.lit(source.agg(F.sum("rows")).first()[0]),
        "input_rows": F.lit(found["rows"]), "subset_schema": F.lit(found["schema"])})
    write_documents(manifest, manifest_path)
    return read_manifest(spark, manifest_path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "role string, file_path string, file_name string, bytes long, sha256 string, requested_rows long, "
        "source_file_rows long, input_rows long, subset_schema string").json(path)


def check_manifest(spark: SparkSession, manifest: DataFrame, paths: list[str]) -> None:
    """Raise when a file differs from its digest in the manifest."""
    present = file_digests(spark, [readable(path) for path in paths]).withColumn("file_path", _plain("file_path"))
    changes = manifest_changes(manifest.withColumn("file_path", _plain("file_path")), present, "file_path")
    changed = changes.filter("change <> 'added'")
    shown = changed.orderBy("file_path").limit(20).collect()
    if shown:
        names = ", ".join(r["file_path"] for r in shown)
        raise ValueError(f"{changed.count()} files changed since the manifest was written: {names}")


def check_columns(spark: SparkSession, path: str, columns: list[str] = OUTPUT_COLUMNS) -> DataFrame:
    """The distinct schemas of the files of an export; raises when one has other columns."""
    return check_facts(path_footers(spark, path), path, columns)


def check_facts(facts: DataFrame, path: str, columns: list[str] = OUTPUT_COLUMNS) -> DataFrame:
    schemas = distinct_schemas(facts, columns)
    bad = schemas.filter(~F.col("columns_as_expected")).agg(F.sum("files")).first()[0]
    if bad:
        raise SchemaError(f"{bad} files under {path} have unexpected columns")
    return schemas


class Comparison:
    """Exports compared with one of them: one pass over their footers, one wide shuffle for all pairs.

    Rows that differ in some pair are counted once and written; sums and examples come from
    there.
    """

    def __init__(self, spark: SparkSession, exports: dict[str, str], base: str):
        self.spark = spark
        self.pairs = [(base, name) for name in exports if name != base]
        self.facts = {name: path_footers(spark, path) for name, path in exports.items()}
        self.schemas = {name: check_facts(facts, exports[name]) for name, facts in self.facts.items()}
        self.tables = {name: read_output(spark, path) for name, path in exports.items()}
        sums = [facts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "rows")]).first() for facts in self.facts.values()]
        size, rows = (sum(row[c] for row in sums) for c in ("bytes", "rows"))
        path = scratch_path(spark, "differing-rows")
        # The shuffle starts with partitions for all rows of all exports together.
        with sized(spark, size, shuffle_bytes=max(size, counted_bytes(self.tables, rows, OUTPUT_COLUMNS))):
            write_table(differing_rows(self.tables, self.pairs, OUTPUT_COLUMNS), path)
        self.differing = spark.read.parquet(path)

    def comparisons(self) -> DataFrame:
        return unmatched_rows(self.differing, self.pairs)

    def examples(self, examples: int = 3) -> DataFrame:
        """Mismatched rows of each pair, a few per side."""
        return pair_examples(self.differing, self.tables, self.pairs, examples, OUTPUT_COLUMNS)

    def datasets(self) -> DataFrame:
        """name, files, rows, bytes, gib, schemas of each export."""
        return _union([
            dataset_totals(facts).select(F.lit(name).alias("name"), "*", F.lit(self.schemas[name].count()).alias("schemas"))
            for name, facts in self.facts.items()])

    def inspected_file_schemas(self) -> DataFrame:
        """name, schema and the files that have it."""
        return _union([schemas.select(F.lit(name).alias("name"), "schema", "files") for name, schemas in self.schemas.items()])


def compare_exports(spark: SparkSession, exports: dict[str, str], base: str) -> DataFrame:
    """Compare every export with the base one, all in one shuffle."""
    return Comparison(spark, exports, base).comparisons()


def comparison_examples(spark: SparkSession, exports: dict[str, str], base: str, examples: int = 3) -> DataFrame:
    """Mismatched rows of each pair, a few per side."""
    return Comparison(spark, exports, base).examples(examples)


def write_comparison(spark: SparkSession, exports: dict[str, str], base: str, path: str, metrics: DataFrame | None = None,
                     manifest: DataFrame | None = None) -> DataFrame:
    """Write JSON tables of a comparison and one summary of them; returns the comparisons.

    datasets, comparisons, mismatch_examples and inspected_file_schemas are tables; `summary`
    is one document with all of them (they have a few rows per export), the input rows by the
    manifest and the benchmarks of the metrics, if these are given.
    """
    compared = Comparison(spark, exports, base)
    parts = {"datasets": compared.datasets(), "comparisons": compared.comparisons(), "mismatch_examples": compared.examples(),
             "inspected_file_schemas": compared.inspected_file_schemas()}
    for name, part in parts.items():
        write_documents(part, f"{path}/{name}")
    if metrics is not None:
        parts["benchmarks"] = benchmarks(metrics)
    columns = [part.agg(F.collect_list(F.struct(*part.columns)).alias(name)) for name, part in parts.items()]
    rows = spark.createDataFrame([(None,)], "input_rows long") if manifest is None else manifest.filter("role = 'subset'").agg(
        F.max("input_rows").alias("input_rows"))
    # One row each.
    write_documents(reduce(DataFrame.join, columns, rows.hint("broadcast")).coalesce(1), f"{path}/summary")
    return spark.read.json(f"{path}/comparisons")


def benchmarks(metrics: DataFrame) -> DataFrame:
    """run_id, variant, pipeline_seconds, the median of the timed trials and their number."""
    medians = trial_medians(metrics).select("run_id", "variant", "median_seconds", "trials", "warmup_seconds")
    return metrics.select("run_id", "variant", "pipeline_seconds", "input_rows").join(medians, ["run_id", "variant"])


def require_completed(metrics: DataFrame, variants: list[str]) -> DataFrame:
    """The metrics of the variants; raises when one has not completed."""
    own = metrics.filter(F.col("variant").isin(variants))
    done = {row["variant"] for row in own.filter("status = 'completed'").select("variant").distinct().collect()}
    if missing := sorted(set(variants) - done):
        raise ValueError(f"not completed: {', '.join(missing)}")
    return own


def validate_export(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows, bytes of an export, with its number of distinct schemas; footers are read once."""
    facts = path_footers(spark, path)
    return dataset_totals(facts).withColumn("schemas", F.lit(check_facts(facts, path).count()))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _plain(column: str):
    return F.regexp_replace(column, "^file:/+", "/")
