import collections
import os

import pytest
from pyspark.sql import functions as F

from faremill.operators.months import commit_months, committed_months, delivered_months, pending_months
from faremill.operators.profile import report_totals
from faremill.plans import months as plan
from faremill.plans.export import build_output, export_trips
from faremill.plans.months import export_months, read_months
from faremill.schemas import MONTH, OUTPUT_COLUMNS, RUN_REPORT, SchemaError
from faremill.session import sized
from faremill.sources.files import read_output
from faremill.sources.trips import read_trip_months
from faremill.streaming.months import stream_months
from helpers import ARROW_TRIPS, trip, write_trip_file, zones


@pytest.fixture()
def lookup(spark):
    return zones(spark, (1, "Queens", "N/A", None), (2, None, "Astoria", "Boro Zone"))


class Job:
    def __init__(self, spark, tmp_path, lookup):
        self.spark, self.lookup = spark, lookup
        self.trips, self.output, self.ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
        self.checkpoint = str(tmp_path / "stream")

    def deliver(self, month, rows, part=""):
        write_trip_file(self.trips, month, rows, part=part)

    def run(self, **options):
        report = export_months(self.spark, self.trips, self.lookup, self.output, self.ledger, **options)
        return {r.month: r for r in report.collect()}

    def stream(self, files_per_batch=1):
        stream_months(self.spark, self.trips, self.lookup, self.output, self.ledger, self.checkpoint, files_per_batch)

    def rows(self):
        return rows_of(read_months(self.spark, self.output))

    def expected(self):
        return rows_of(build_output(read_trip_months(self.spark, self.trips), self.lookup, MONTH, "fraction", invalid="nan"))


def rows_of(df):
    return collections.Counter(map(str, df.select(*OUTPUT_COLUMNS, MONTH).collect()))


@pytest.fixture()
def job(spark, tmp_path, lookup):
    return Job(spark, tmp_path, lookup)


def test_finished_months_are_left_alone(job):
    job.deliver("2024-01", [trip(), trip(), trip(vendor=2)])
    job.deliver("2024-02", [trip(), trip(distance=0.0)])
    first = job.run()
    assert {m: (r.rows, r.parquet_files) for m, r in first.items()} == {"2024-01": (2, 1), "2024-02": (1, 1)}
    assert all(r.estimated_seconds > 0 and r.output_bytes > 0 for r in first.values())
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, files in os.walk(job.output) for f in files if f.startswith("part")}
    job.deliver("2024-03", [trip(vendor=3)])
    second = job.run()
    after = {f: os.path.getmtime(os.path.join(d, f)) for d, _, files in os.walk(job.output) for f in files if f.startswith("part")}
    assert {m: r.estimated_seconds > 0 for m, r in second.items()} == {"2024-01": False, "2024-02": False, "2024-03": True}
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert job.rows() == job.expected()
    assert job.run().keys() == second.keys() and job.rows() == job.expected()


def test_the_seconds_of_a_run_add_up(job, monkeypatch):
    for month, n in (("2024-01", 3), ("2024-02", 1), ("2024-03", 0)):
        job.deliver(month, [trip(vendor=i) for i in range(n)])
    seconds = {}
    commit = plan.commit_months
    monkeypatch.setattr(plan, "commit_months", lambda *args: (seconds.update(run=args[3]), commit(*args)))
    report = job.run()
    assert sum(r.estimated_seconds for r in report.values()) == pytest.approx(seconds["run"])
    assert report["2024-01"].estimated_seconds == pytest.approx(0.75 * seconds["run"])
    # A month without a valid trip is finished too.
    assert (report["2024-03"].rows, report["2024-03"].parquet_files) == (0, 0)


def test_a_run_that_dies_is_done_again(job, monkeypatch):
    job.deliver("2024-01", [trip()])
    job.deliver("2024-02", [trip(), trip(vendor=2)])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(plan, "commit_months", die)
        with pytest.raises(RuntimeError):
            job.run()
    # What the lost run left must not count, nor double anything.
    assert committed_months(job.spark, job.ledger).count() == 0
    assert job.run().keys() == {"2024-01", "2024-02"}
    assert job.rows() == job.expected()


def test_ledger(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert committed_months(spark, ledger).count() == 0
    schema = f"{MONTH} string, files long, bytes long, state long, rows long, output_bytes long, parquet_files long"
    months = spark.createDataFrame([("2024-01", 1, 10, 7, 1, 1, 1), ("2024-02", 1, 10, 7, 1, 1, 1)], schema)
    commit_months(months.filter(F.col(MONTH) == "2024-01"), ledger, "a", 1.0)
    commit_months(months.filter(F.col(MONTH) == "2024-01"), ledger, "b", 1.0)
    left = pending_months(months, committed_months(spark, ledger))
    assert [r[MONTH] for r in left.collect()] == ["2024-02"]
    # Another file of a finished month makes it pending again, until that is committed.
    more = spark.createDataFrame([("2024-01", 2, 15, 8, 1, 1, 1)], schema)
    assert pending_months(more, committed_months(spark, ledger)).count() == 1
    commit_months(more, ledger, "c", 1.0)
    assert pending_months(more, committed_months(spark, ledger)).count() == 0


def test_a_month_in_two_files_is_one_month(job):
    job.deliver("2024-01", [trip(), trip(vendor=2)], part="_a")
    job.deliver("2024-01", [trip(), trip(vendor=3)], part="_b")
    assert [r[MONTH] for r in delivered_months(job.spark, job.trips).collect()] == ["2024-01"]
    assert job.run()["2024-01"].rows == 3


def test_a_late_file_of_a_finished_month(job):
    job.deliver("2024-01", [trip(), trip(vendor=2)])
    job.deliver("2024-02", [trip()])
    job.run()
    job.deliver("2024-01", [trip(), trip(vendor=3)], part="_late")
    report = job.run()
    assert report["2024-01"].rows == 3 and report["2024-02"].estimated_seconds == 0
    assert job.rows() == job.expected()


def test_files_that_name_no_month_are_refused(job):
    job.deliver("2024-01", [trip()])
    job.deliver("latest1", [trip(vendor=2)])
    os.rename(write_trip_file(job.trips, "x", [trip(vendor=3)]), f"{job.trips}/other.parquet")
    with pytest.raises(SchemaError, match=r"2 trip files name no month: other\.parquet, yellow_tripdata_latest1\.parquet"):
        job.run()
    with pytest.raises(Exception, match="name no month"):
        job.stream()
    months = {r.VendorID: r[MONTH] for r in read_trip_months(job.spark, job.trips).collect()}
    assert months[1] == "2024-01" and months[3] is None


def test_a_redelivered_month_of_the_same_size(job):
    path = write_trip_file(job.trips, "2024-01", [trip(vendor=1)])
    job.run()
    size = os.path.getsize(path)
    write_trip_file(job.trips, "2024-01", [trip(vendor=7)])
    assert os.path.getsize(path) == size
    job.run()
    assert job.rows() == job.expected() and [r.VendorID for r in read_months(job.spark, job.output).collect()] == [7]


def test_a_month_that_becomes_empty_and_one_that_is_withdrawn(job):
    for month in ("2024-01", "2024-02", "2024-03"):
        job.deliver(month, [trip(), trip(vendor=2)])
    job.run()
    job.deliver("2024-01", [trip(distance=0.0)] * 5)
    os.remove(f"{job.trips}/yellow_tripdata_2024-02.parquet")
    report = job.run()
    assert {m: r.rows for m, r in report.items()} == {"2024-01": 0, "2024-03": 2}
    assert job.rows() == job.expected() and sum(job.rows().values()) == 2
    assert job.run() .keys() == report.keys()
    job.deliver("2024-02", [trip(vendor=5)])
    assert job.run()["2024-02"].rows == 1 and job.rows() == job.expected()


def test_a_file_without_a_column_is_refused(job):
    job.deliver("2024-01", [trip()])
    schema = ARROW_TRIPS.remove(4)
    rows = [tuple(v for i, v in enumerate(trip()) if i != 4)]
    write_trip_file(job.trips, "2024-02", rows, schema=schema)
    with pytest.raises(SchemaError, match=r"1 trip files lack columns: .*2024-02\.parquet \(trip_distance\)"):
        read_trip_months(job.spark, job.trips)


def test_doubled_zones_are_refused(job, spark):
    job.deliver("2024-01", [trip()])
    job.lookup = job.lookup.unionAll(job.lookup)
    with pytest.raises(ValueError, match="2 ids occur more than once in the lookup: 1, 2"):
        job.run()


def test_a_month_in_many_files_is_written_once(job, monkeypatch):
    for part in "abcde":
        job.deliver("2024-01", [trip(vendor=ord(part))], part=f"_{part}")
    writes, write = [], plan.write_months
    monkeypatch.setattr(plan, "write_months", lambda df, path: (writes.append(path), write(df, path)))
    job.stream(files_per_batch=1)
    assert len(writes) == 1 and job.rows() == job.expected()


def test_report_file_and_totals(job, tmp_path):
    job.deliver("2024-02", [trip()])
    job.deliver("2024-01", [trip()])
    path = str(tmp_path / "report")
    job.run(report_path=path)
    table = job.spark.read.schema(RUN_REPORT).option("header", True).option("enforceSchema", False).csv(path)
    assert [r.month for r in table.collect()] == ["2024-01", "2024-02"]
    totals = report_totals(table).first()
    assert (totals.months, totals.rows, totals.output_gib) == (2, 2, totals.output_bytes / 1024**3)


def test_stream_keeps_a_month_that_comes_in_parts(job):
    job.deliver("2024-01", [trip(), trip(vendor=2)], part="_a")
    job.deliver("2024-01", [trip(), trip(vendor=3)], part="_b")
    job.deliver("2024-02", [trip()])
    job.stream(files_per_batch=1)
    assert job.rows() == job.expected() and sum(job.rows().values()) == 4
    job.stream()
    assert job.rows() == job.expected()
    job.deliver("2024-01", [trip(vendor=4)], part="_c")
    job.deliver("2024-03", [trip(), trip()])
    job.stream(files_per_batch=10)
    assert job.rows() == job.expected() and sum(job.rows().values()) == 6


def test_a_batch_that_fails_is_done_again(job, monkeypatch):
    job.deliver("2024-01", [trip(), trip(vendor=2)])
    write = plan.write_months

    def write_and_die(*args):
        write(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(plan, "write_months", write_and_die)
        with pytest.raises(Exception, match="lost"):
            job.stream()
    job.stream()
    assert job.rows() == job.expected()


def test_stream_is_the_batch(job, spark, tmp_path):
    for month in ("2024-01", "2024-02", "2024-03"):
        job.deliver(month, [trip(vendor=i % 5, pickup=i % 3) for i in range(20)])
    job.stream(files_per_batch=2)
    streamed = job.rows()
    job.output, job.ledger = str(tmp_path / "batch"), str(tmp_path / "batch-ledger")
    job.run()
    assert job.rows() == streamed


def test_a_hot_month_is_written_by_many_tasks(spark, lookup, tmp_path):
    from faremill.sources.sinks import by_month, write_months
    hot = spark.range(0, 400_000, 1, 16).select(
        F.when(F.col("id") % 3 < 2, "2024-01").otherwise(F.concat(F.lit("2023-"), F.lpad((F.col("id") % 9 + 1).cast("string"), 2, "0"))).alias(MONTH),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    path = str(tmp_path / "hot")
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "2m")
    try:
        write_months(by_month(hot), path)
    finally:
        spark.conf.set(advisory, before)
    files = {d.split("=")[1]: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")])
             for d in os.listdir(path) if "=" in d}
    assert files.pop("2024-01") > max(files.values()) and min(files.values()) >= 1
    assert spark.read.parquet(path).count() == 400_000


def test_whole_export(spark, lookup, tmp_path):
    write_trip_file(tmp_path / "in", "2024-01", [trip(), trip()])
    write_trip_file(tmp_path / "in", "2024-02", [trip(), trip(vendor=9, dropoff=7)])
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n1,Queens,N/A,\n2,,Astoria,Boro Zone\n")
    outputs = {}
    for how in ("native", "udf", "pandas"):
        path = str(tmp_path / how)
        assert export_trips(spark, str(tmp_path / "in"), str(csv), path, how) > 0
        outputs[how] = sorted(map(str, read_output(spark, path).collect()))
    assert len(outputs["native"]) == 2 and outputs["native"] == outputs["udf"] == outputs["pandas"]


def test_sizes_are_bounded_and_given_back(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    before = [spark.conf.get(k, None) for k in keys]
    with sized(spark, 100) as partitions:
        assert partitions == spark.sparkContext.defaultParallelism
    with sized(spark, 10 << 30) as partitions:
        assert partitions == 80 and spark.conf.get(keys[1]) == "80"
    with sized(spark, 100 << 40) as partitions:
        assert partitions == 131_072 and int(spark.conf.get(keys[0])) == 1 << 30
    assert [spark.conf.get(k, None) for k in keys] == before
