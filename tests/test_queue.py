import os

import pytest

from faremill.operators import months as months_operators
from faremill.operators.months import delivered_months
from faremill.plans import months as plan
from faremill.schemas import MONTH, SchemaError
from faremill.sources import trips as trips_source
from faremill.sources.files import list_files
from faremill.streaming import months as streaming
from faremill.streaming.queue import MonthQueue
from helpers import trip, write_trip_file
from test_months import Job, lookup  # noqa: F401


@pytest.fixture()
def job(spark, tmp_path, lookup):  # noqa: F811
    return Job(spark, tmp_path, lookup)


def entries(spark, rows):
    return spark.createDataFrame(rows, f"{MONTH} string, file_path string, file_name string, bytes long, modified timestamp")


def test_a_batch_that_runs_twice_counts_once(spark, tmp_path):
    queue = MonthQueue(spark, str(tmp_path / "q"))
    assert queue.waiting().count() == 0 and queue.months().count() == 0
    rows = [("2024-01", "/a", "a", 1, None), ("2024-01", "/b", "b", 2, None), ("2024-02", "/c", "c", 3, None)]
    for _ in range(2):
        queue.put(entries(spark, rows + rows), 0)
    queue.put(entries(spark, [("2024-01", "/d", "d", 4, None), ("2024-01", "/a", "a", 9, None)]), 1)
    assert {r[MONTH]: (r.files, r.bytes) for r in queue.months().collect()} == {"2024-01": (3, 15), "2024-02": (1, 3)}
    queue.done([0])
    # A month that waits is whole: its files of finished batches belong to it.
    assert {r[MONTH]: (r.files, r.bytes) for r in queue.months().collect()} == {"2024-01": (3, 15)}
    queue.done([0, 1])
    assert queue.months().count() == 0 and queue.entries().count() == 5
    with pytest.raises(SchemaError, match="name no month: x"):
        queue.put(entries(spark, [(None, "/x", "x", 1, None)]), 2)


def test_the_rebuild_reads_the_queue_and_lists_no_finished_month(job, monkeypatch):
    job.deliver("2024-01", [trip()])
    job.deliver("2024-02", [trip(), trip(vendor=2)], part="_a")
    job.stream()
    built = []
    read = streaming.read_trip_files

    def noting(spark, files, index):
        built.append(sorted((r[MONTH], r.file_name) for r in files.collect()))
        return read(spark, files, index)

    def refuse(*_, **__):
        raise AssertionError("the input folder was listed")

    monkeypatch.setattr(streaming, "read_trip_files", noting)
    monkeypatch.setattr(plan, "delivered_months", refuse)
    monkeypatch.setattr(trips_source, "list_files", refuse)
    # Finished months are not looked at: their files may even be gone.
    os.remove(f"{job.trips}/yellow_tripdata_2024-01.parquet")
    write_trip_file(job.trips, "2024-02", [trip(vendor=3)], part="_b")
    job.stream()
    assert built == [[("2024-02", "yellow_tripdata_2024-02_a.parquet"), ("2024-02", "yellow_tripdata_2024-02_b.parquet")]]
    rows = plan.read_months(job.spark, job.output).groupBy(MONTH).count().collect()
    assert {r[MONTH]: r["count"] for r in rows} == {"2024-01": 1, "2024-02": 3}
    built.clear()
    job.stream()
    assert built == []


def test_months_of_a_run_that_died_wait_on(job, monkeypatch):
    job.deliver("2024-01", [trip()])
    with monkeypatch.context() as broken:
        broken.setattr(MonthQueue, "done", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            job.stream()
    queue = MonthQueue(job.spark, f"{job.checkpoint}/queue")
    assert queue.waiting().count() == 1
    writes, write = [], plan.write_months
    monkeypatch.setattr(plan, "write_months", lambda df, path: (writes.append(path), write(df, path)))
    job.stream()
    # The month was committed from these files, so only the mark was missing.
    assert queue.waiting().count() == 0 and writes == [] and job.rows() == job.expected()


def test_stream_and_batch_share_a_ledger(job):
    job.deliver("2024-01", [trip(), trip(vendor=2)])
    job.deliver("2024-02", [trip()])
    job.stream()
    report = job.run()
    assert all(r.estimated_seconds == 0 for r in report.values()) and report["2024-01"].rows == 2
    listed = {r[MONTH]: (r.files, r.bytes, r.state) for r in delivered_months(job.spark, job.trips).collect()}
    queue = MonthQueue(job.spark, f"{job.checkpoint}/queue")
    seen = queue.files(queue.entries()).groupBy(MONTH).agg(*months_operators.file_state()).collect()
    assert {r[MONTH]: (r.files, r.bytes, r.state) for r in seen} == listed
    assert list_files(job.spark, job.trips).count() == 2
