import hashlib
import os

import pyarrow as pa
import pytest

from faremill.operators.profile import (
    by_delivered_month, dataset_totals, distinct_schemas, file_report, manifest_changes, month_report)
from faremill.plans.evidence import check_columns, check_manifest, prepare_subset, validate_export
from faremill.plans.export import build_output
from faremill.schemas import OUTPUT_COLUMNS, TRIP_COLUMNS, SchemaError
from faremill.sources.files import file_digests, list_files, read_output, sorted_paths, total_bytes
from faremill.sources.footers import file_rows, file_schemas, profile_files
from faremill.sources.stores import open_store
from faremill.sources.sinks import write_subset, write_table
from faremill.sources.trips import first_delivery, first_rows, read_trip_months, read_trips
from helpers import ARROW_TRIPS, plan_of, trip, trips, write_trip_file, zones


@pytest.fixture()
def folder(tmp_path):
    write_trip_file(tmp_path / "in", "2024-02", [trip(vendor=i) for i in range(10)], row_group=4)
    write_trip_file(tmp_path / "in", "2024-01", [trip(vendor=i) for i in range(25)], row_group=4)
    write_trip_file(tmp_path / "in", "2024-03", [])
    return str(tmp_path / "in")


def test_listing_rows_and_totals(spark, folder):
    names = [r.file_name for r in sorted_paths(spark, folder).collect()]
    assert names == [f"yellow_tripdata_2024-0{i}.parquet" for i in (1, 2, 3)]
    sizes = {r.file_name: r.bytes for r in list_files(spark, folder).collect()}
    assert sizes == {n: os.path.getsize(f"{folder}/{n}") for n in names}
    assert total_bytes(spark, folder) == sum(sizes.values())
    assert sorted(r.rows for r in file_rows(spark, folder).collect()) == [0, 10, 25]
    profile = profile_files(spark, folder)
    assert {r.file_name[16:23]: r.rows for r in profile.collect()} == {"2024-01": 25, "2024-02": 10, "2024-03": 0}
    report = {r.file_name: r for r in file_report(profile).collect()}
    assert (report["total"].files, report["total"].rows, report["total"].bytes) == (3, 35, sum(sizes.values()))
    assert report[names[0]].mib == sizes[names[0]] / 1024**2
    totals = dataset_totals(profile).first()
    assert (totals.files, totals.rows, totals.gib) == (3, 35, sum(sizes.values()) / 1024**3)
    months = {r.month: (r.rows, r.parquet_files) for r in month_report(by_delivered_month(profile)).collect()}
    assert months == {"2024-01": (25, 1), "2024-02": (10, 1), "2024-03": (0, 1)}


def test_trips_and_months(spark, folder):
    assert read_trips(spark, folder).columns == TRIP_COLUMNS
    assert read_trips(spark, folder).count() == 35
    by_month = {r.source_month: r["count"] for r in read_trip_months(spark, folder).groupBy("source_month").count().collect()}
    assert by_month == {"2024-01": 25, "2024-02": 10}
    assert read_trip_months(spark, folder, ["2024-02"]).count() == 10
    # The month is that of the file, whatever the pickup time.
    assert read_trip_months(spark, folder).first().tpep_pickup_datetime.year == 2024


def test_first_rows_keep_the_stored_order(spark, folder):
    for n in (1, 3, 4, 17, 25, 100):
        assert sorted(r.VendorID for r in first_rows(spark, folder, n).collect()) == list(range(min(n, 25)))
    with pytest.raises(ValueError):
        first_rows(spark, folder, 0)


def test_filters_reach_the_scan(spark, folder):
    from faremill.operators.clean import clean_trips
    plan = plan_of(clean_trips(read_trips(spark, folder)))
    for test in ("IsNotNull(PULocationID)", "IsNotNull(tpep_pickup_datetime)", "GreaterThan(trip_distance,0.0)"):
        assert test in plan
    assert plan.index("HashAggregate") < plan.index("Filter") and plan.count("+- Exchange") == 1


def test_zoned_timestamps_and_missing_columns_are_refused(spark, tmp_path):
    zoned = pa.schema([pa.field(f.name, pa.timestamp("us", tz="UTC")) if f.name.startswith("tpep") else f for f in ARROW_TRIPS])
    write_trip_file(tmp_path / "z", "2024-01", [trip()], schema=zoned)
    with pytest.raises(SchemaError, match="time zone"):
        read_trips(spark, str(tmp_path / "z"))
    write_trip_file(tmp_path / "m", "2024-01", [trip()[:-1]], schema=pa.schema(list(ARROW_TRIPS)[:-1]))
    with pytest.raises(SchemaError, match="total_amount"):
        read_trips(spark, str(tmp_path / "m"))
    text = pa.schema([pa.field(f.name, pa.string()) if f.name == "trip_distance" else f for f in ARROW_TRIPS])
    write_trip_file(tmp_path / "t", "2024-01", [tuple(str(v) if i == 4 else v for i, v in enumerate(trip()))], schema=text)
    with pytest.raises(SchemaError, match="trip_distance"):
        read_trips(spark, str(tmp_path / "t"))


def test_extra_columns_are_not_read(spark, tmp_path):
    wide = pa.schema([*ARROW_TRIPS, pa.field("tolls_amount", pa.string())])
    write_trip_file(tmp_path, "2024-01", [(*trip(), "x")], schema=wide)
    plan = plan_of(read_trips(spark, str(tmp_path)))
    assert "tolls_amount" not in plan


def test_digests(spark, folder):
    with open(f"{folder}/large.gz", "wb") as large:  # longer than what is read at once, and not unpacked
        large.write(os.urandom(9 << 20))
    expected = {n: hashlib.sha256(open(f"{folder}/{n}", "rb").read()).hexdigest() for n in os.listdir(folder)}
    assert {r.file_name: r.sha256 for r in file_digests(spark, folder).collect()} == expected


def test_stores():
    assert open_store("/a b/c")[1] == open_store("file:/a%20b/c")[1] == open_store("file:///a%20b/c")[1] == "/a b/c"
    with pytest.raises(ValueError, match="no file system for scheme 'viewfs'"):
        open_store("viewfs://a/b")


def test_listing_has_few_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.bin").write_bytes(bytes(1000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        listed = list_files(spark, str(tmp_path), "*.bin")
        assert listed.count() == 40 and listed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_manifest_changes(spark):
    schema = "file_name string, sha256 string"
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], schema)
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], schema)
    assert {r.file_name: r.change for r in manifest_changes(old, new).collect()} == {
        "b": "changed", "c": "missing", "d": "added"}


def test_subset_and_manifest(spark, folder, tmp_path):
    lookup = tmp_path / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone,service_zone\n1,a,b,c\n")
    subset, manifest = str(tmp_path / "subset"), str(tmp_path / "manifest")
    found = prepare_subset(spark, folder, str(lookup), subset, manifest, rows=7)
    assert {r.role for r in found.collect()} == {"source", "subset", "lookup"}
    assert found.filter("role = 'source'").first().file_name == "yellow_tripdata_2024-01.parquet"
    parts = [n for n in os.listdir(subset) if n.endswith(".parquet")]
    assert len(parts) == 1 and "snappy" in parts[0]
    assert sorted(r.VendorID for r in read_trips(spark, subset).collect()) == list(range(7))
    fields = {(r.requested_rows, r.source_file_rows, r.input_rows, r.subset_schema) for r in found.collect()}
    assert fields == {(7, 25, 7, "\n".join(f"{f.name}: {f.type}" for f in ARROW_TRIPS))}
    paths = [r.file_path for r in found.collect()]
    check_manifest(spark, found, paths)
    lookup.write_text("LocationID,Borough,Zone,service_zone\n1,a,b,d\n")
    with pytest.raises(ValueError, match="zones.csv"):
        check_manifest(spark, found, paths)
    for rows in (0, 200_001):
        with pytest.raises(ValueError):
            prepare_subset(spark, folder, str(lookup), subset, manifest, rows)


def test_subset_of_a_month_in_part_files(spark, tmp_path):
    lookup = tmp_path / "zones.csv"
    lookup.write_text("LocationID,Borough,Zone,service_zone\n1,a,b,c\n")
    month = tmp_path / "in [1]" / "file=yellow_tripdata_2024-01.parquet"
    wide = pa.schema([pa.field(f.name, pa.int64()) if f.name == "VendorID" else f for f in ARROW_TRIPS])
    first = 0
    for part, (rows, schema) in enumerate([(6, ARROW_TRIPS), (0, ARROW_TRIPS), (9, wide), (5, ARROW_TRIPS)]):
        write_trip_file(month, "x", [trip(vendor=first + i) for i in range(rows)], row_group=4, schema=schema)
        os.rename(month / "yellow_tripdata_x.parquet", month / f"part-{part}.parquet")
        first += rows
    write_trip_file(tmp_path / "in [1]", "2024-02", [trip(vendor=99)])
    path = str(tmp_path / "in \\[1\\]")
    assert {r.file_name for r in first_delivery(spark, path).collect()} == {f"part-{i}.parquet" for i in range(4)}
    for rows in (1, 6, 7, 15, 17, 100):
        subset, manifest = str(tmp_path / f"subset{rows}"), str(tmp_path / f"manifest{rows}")
        found = prepare_subset(spark, path, str(lookup), subset, manifest, rows)
        # One file, in the order of the parts and of their rows.
        assert [r.VendorID for r in spark.read.parquet(subset).collect()] == list(range(min(rows, 20)))
        assert {(r.requested_rows, r.source_file_rows, r.input_rows) for r in found.collect()} == {(rows, 20, min(rows, 20))}
        assert sorted(r.file_name for r in found.filter("role = 'source'").collect()) == [f"part-{i}.parquet" for i in range(4)]
        check_manifest(spark, found, [r.file_path for r in found.collect()])


def test_a_subset_is_not_read_in_the_task_that_writes_it(spark, tmp_path):
    write_trip_file(tmp_path / "in", "2024-01", [trip(vendor=i) for i in range(20_000)], row_group=2000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = first_rows(spark, str(tmp_path / "in"), 9_000)
        assert rows.rdd.getNumPartitions() > 2
        done = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("subset", "subset")
        write_subset(rows, str(tmp_path / "s"))
        stages = [done.getStageInfo(s) for j in done.getJobIdsForGroup("subset") for s in done.getJobInfo(j).stageIds]
        assert max(s.numTasks for s in stages if s) > 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.VendorID for r in spark.read.parquet(str(tmp_path / "s")).collect()] == list(range(9_000))


def test_output_columns_are_checked_in_every_file(spark, tmp_path):
    path = str(tmp_path / "out")
    table = build_output(trips(spark, trip()), zones(spark, (1, "a", "b", "c")))
    write_table(table, f"{path}/one")
    write_table(table.select(*reversed(OUTPUT_COLUMNS)), f"{path}/two")
    assert read_output(spark, path).columns == OUTPUT_COLUMNS
    assert check_columns(spark, path).count() == 2
    assert tuple(validate_export(spark, path).select("files", "rows", "schemas").first()) == (2, 2, 2)
    write_table(table.drop("pickup_zone"), f"{path}/three")
    assert distinct_schemas(file_schemas(spark, path)).filter("not columns_as_expected").count() == 1
    with pytest.raises(SchemaError):
        check_columns(spark, path)
    with pytest.raises(SchemaError):
        read_output(spark, f"{path}/three")


def test_output_types(spark):
    from faremill.schemas import OUTPUT
    table = build_output(trips(spark, trip()), zones(spark, (1, "a", "b", "c")))
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in OUTPUT]


def test_subset_is_written_whole(spark, tmp_path):
    write_subset(spark.range(250_000), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 250_000
