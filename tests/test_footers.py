import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faremill.plans.export import build_output
from faremill.plans.months import export_months, read_months
from faremill.schemas import MONTH, SchemaError
from faremill.sources import footers
from faremill.sources.files import list_files
from faremill.sources.footers import compact_index, indexed_footers, path_footers
from faremill.sources.stores import readable
from faremill.sources.trips import first_rows, read_trip_files, read_trip_months, read_trips
from helpers import ARROW_TRIPS, trip, write_trip_file, zones

WIDE = pa.schema([pa.field(f.name, pa.int64()) if f.name == "VendorID" else f for f in ARROW_TRIPS])


@pytest.fixture()
def opened(monkeypatch, tmp_path):
    """Names of the files whose footers are opened, noted by the tasks in a folder of the test."""
    log, read = tmp_path / "opened", footers.read_footers
    log.mkdir()

    def noting(files, options=None):
        # The listing is what goes to the tasks; its rows are the files that they open.
        files.select("file_path").write.mode("append").text(str(log))
        return read(files, options)

    monkeypatch.setattr(footers, "read_footers", noting)

    def names():
        found = [line.rsplit("/", 1)[1].strip() for n in os.listdir(log) if n.endswith(".txt") for line in open(log / n) if line.strip()]
        for n in os.listdir(log):
            os.remove(log / n)
        return sorted(found)

    return names


def test_a_footer_is_opened_once(spark, tmp_path, opened):
    folder, index = str(tmp_path / "in"), str(tmp_path / "index")
    for month in ("2024-01", "2024-02"):
        write_trip_file(folder, month, [trip(), trip(vendor=2)])
    facts = path_footers(spark, folder, index)
    assert [(r.rows, r.bytes == os.path.getsize(readable(r.file_path)[5:])) for r in facts.collect()] == [(2, True)] * 2
    assert len(opened()) == 2
    write_trip_file(folder, "2024-02", [trip()] * 7)
    write_trip_file(folder, "2024-03", [])
    os.remove(f"{folder}/yellow_tripdata_2024-01.parquet")
    got = {r.file_name[16:23]: r.rows for r in path_footers(spark, folder, index).collect()}
    assert got == {"2024-02": 7, "2024-03": 0}
    assert opened() == ["yellow_tripdata_2024-02.parquet", "yellow_tripdata_2024-03.parquet"]
    assert path_footers(spark, folder, index).count() == 2 and opened() == []
    # A delivery that was opened by two runs counts once.
    footers.read_footers(list_files(spark, folder)).write.mode("append").parquet(index)
    opened()
    assert path_footers(spark, folder, index).count() == 2 and opened() == []
    small = str(tmp_path / "small")
    assert compact_index(spark, folder, index, small).count() == 2
    assert indexed_footers(list_files(spark, folder), small).count() == 2 and opened() == []


def test_an_export_opens_the_footers_of_pending_months_only(spark, tmp_path, opened):
    trips, output, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    lookup = zones(spark, (1, "a", "b", "c"), (2, "d", "e", "f"))
    for month in ("2024-01", "2024-02", "2024-03"):
        write_trip_file(trips, month, [trip()])
    export_months(spark, trips, lookup, output, ledger)
    opened()
    write_trip_file(trips, "2024-03", [trip(), trip(vendor=4)])
    report = export_months(spark, trips, lookup, output, ledger)
    assert {r.month: r.rows for r in report.collect()} == {"2024-01": 1, "2024-02": 1, "2024-03": 2}
    # The trip file of the month, and what was just written of it.
    names = opened()
    assert [n for n in names if n.startswith("yellow")] == ["yellow_tripdata_2024-03.parquet"] and len(names) == 2


def test_a_broken_file_of_a_finished_month_blocks_nothing(spark, tmp_path):
    trips, output, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    lookup = zones(spark, (1, "a", "b", "c"))
    path = write_trip_file(trips, "2024-01", [trip()])
    export_months(spark, trips, lookup, output, ledger)
    state = os.stat(path)
    with open(path, "r+b") as file:
        file.write(b"x" * state.st_size)
    os.utime(path, ns=(state.st_atime_ns, state.st_mtime_ns))
    write_trip_file(trips, "2024-02", [trip(), trip(vendor=2)])
    report = export_months(spark, trips, lookup, output, ledger)
    assert {r.month: r.rows for r in report.collect()} == {"2024-01": 1, "2024-02": 2}
    # What is pending itself may not be broken.
    write_trip_file(trips, "2024-03", [trip()[:-1]], schema=pa.schema(list(ARROW_TRIPS)[:-1]))
    with pytest.raises(SchemaError, match="total_amount"):
        export_months(spark, trips, lookup, output, ledger)


@pytest.mark.parametrize("name", ["my data", "50% [a]{b} ü", "a%20b"])
def test_paths_that_need_quoting(spark, tmp_path, name):
    write_trip_file(tmp_path / name, "2024-01", [trip(vendor=i) for i in range(4)])
    write_trip_file(tmp_path / name, "2024-02", [trip(vendor=i) for i in range(3)], schema=WIDE)
    # Spark takes a path as a pattern, so whoever names one escapes the signs of a pattern.
    trips = re.sub(r"([\[\]{}])", r"\\\1", str(tmp_path / name))
    output, ledger = str(tmp_path / "out put"), str(tmp_path / "led ger")
    assert read_trips(spark, trips).count() == 7
    assert sorted(r.VendorID for r in first_rows(spark, trips, 3).collect()) == [0, 1, 2]
    assert read_trip_months(spark, trips, ["2024-02"]).count() == 3
    lookup = zones(spark, (1, "a", "b", "c"))
    export_months(spark, trips, lookup, output, ledger)
    expected = build_output(read_trip_months(spark, trips), lookup, MONTH, "fraction", invalid="nan")
    assert sorted(map(str, read_months(spark, output).collect())) == sorted(map(str, expected.collect()))
    assert read_months(spark, output).count() == 7


def test_types_that_differ_are_read_in_groups(spark, tmp_path):
    write_trip_file(tmp_path, "2024-01", [trip(vendor=1)])
    write_trip_file(tmp_path, "2024-02", [trip(vendor=2)], schema=WIDE)
    write_trip_file(tmp_path, "2024-03", [trip(vendor=3)], schema=WIDE)
    got = read_trip_months(spark, str(tmp_path)).groupBy(MONTH).agg(F.sum("VendorID").alias("v")).collect()
    assert {r[MONTH]: r.v for r in got} == {"2024-01": 1, "2024-02": 2, "2024-03": 3}


def test_a_file_changed_in_the_hour_that_a_zone_repeats(spark, tmp_path):
    folder, index = str(tmp_path / "in"), str(tmp_path / "index")
    # 2024-11-03 05:30 and 06:30 UTC are both 01:30 in New York, the zone of these tests.
    for month, at in (("2024-01", 1_730_611_800), ("2024-02", 1_730_615_400)):
        os.utime(write_trip_file(folder, month, [trip()]), (at, at))
    for _ in range(2):
        assert path_footers(spark, folder, index).count() == 2
    assert spark.read.parquet(index).count() == 2
    assert read_trip_files(spark, list_files(spark, folder), index).count() == 2
    assert spark.read.parquet(index).count() == 2
