import os

import numpy as np
import pytest

from faremill.plans import incremental
from faremill.plans.export import build_output
from faremill.plans.incremental import SeenTrips, export_delivery, may_hold, with_keys
from faremill.sources.files import read_output
from faremill.sources.trips import read_trips
from helpers import trip, write_trip_file, zones


@pytest.fixture()
def lookup(spark):
    return zones(spark, (1, "Queens", "N/A", None), (2, None, "Astoria", "Boro Zone"))


class Deliveries:
    def __init__(self, spark, tmp_path, lookup):
        self.spark, self.lookup = spark, lookup
        self.trips, self.output, self.seen = (str(tmp_path / n) for n in ("in", "out", "seen"))

    def run(self):
        return export_delivery(self.spark, self.trips, self.lookup, self.output, self.seen, buckets=4)

    def rows(self):
        return sorted(map(str, read_output(self.spark, self.output).collect()))

    def expected(self):
        return sorted(map(str, build_output(read_trips(self.spark, self.trips), self.lookup).collect()))


@pytest.fixture()
def job(spark, tmp_path, lookup):
    return Deliveries(spark, tmp_path, lookup)


def test_a_filter_denies_no_key_that_it_holds():
    keys = np.random.default_rng(1).integers(-2**62, 2**62, (2, 30_000))
    bits = with_keys(None, *keys[:, :10_000])
    bits = with_keys(bits, *keys[:, 10_000:20_000])
    assert may_hold(bits, *keys[:, :20_000]).all()
    assert may_hold(bits, *keys[:, 20_000:]).mean() < 0.001
    assert not may_hold(None, *keys[:, :5]).any()


def test_copies_across_deliveries_come_once(job):
    write_trip_file(job.trips, "2024-01", [trip(vendor=i % 7, fare=float(i)) for i in range(60)] + [trip(fare=-0.0), trip(passengers=None)])
    assert job.run() == 1 and job.rows() == job.expected()
    write_trip_file(job.trips, "2024-02", [trip(vendor=i % 7, fare=float(i)) for i in range(30, 90)] + [trip(fare=0.0), trip(passengers=None), trip(distance=0.0)])
    write_trip_file(job.trips, "2024-01", [trip(vendor=i % 7, fare=float(i)) for i in range(80, 95)] * 2, part="_late")
    assert job.run() == 2 and len(job.rows()) == len(job.expected()) == 60 + 2 + 35
    # A zero without a sign equals one with it, so either may be the one that is kept.
    assert [r.replace("-0.0", "0.0") for r in job.rows()] == [r.replace("-0.0", "0.0") for r in job.expected()]
    before = sorted(os.listdir(job.output))
    assert job.run() == 2 and sorted(os.listdir(job.output)) == before
    seen = SeenTrips(job.spark, job.seen, 4)
    assert seen.keys(2).count() == seen.keys(2).distinct().count() == 97


def test_a_delivery_without_new_trips(job):
    write_trip_file(job.trips, "2024-01", [trip()])
    job.run()
    write_trip_file(job.trips, "2024-02", [trip(), trip(distance=-1.0)])
    write_trip_file(job.trips, "2024-03", [])
    assert job.run() == 2 and job.rows() == job.expected() and len(job.rows()) == 1


def test_a_delivery_that_died_is_done_again(job, monkeypatch):
    write_trip_file(job.trips, "2024-01", [trip(vendor=i) for i in range(5)])
    job.run()
    write_trip_file(job.trips, "2024-02", [trip(vendor=i) for i in range(3, 9)])
    with monkeypatch.context() as broken:
        broken.setattr(incremental.SeenTrips, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            job.run()
    assert job.run() == 2 and job.rows() == job.expected() and len(job.rows()) == 9


def test_the_exact_keys_decide_where_a_filter_errs(job, monkeypatch):
    monkeypatch.setattr(incremental, "FILTER_BITS", 8)
    for month, first in (("2024-01", 0), ("2024-02", 5), ("2024-03", 0)):
        write_trip_file(job.trips, month, [trip(vendor=i) for i in range(first, first + 9)])
        job.run()
    assert job.rows() == job.expected() and len(job.rows()) == 14


def test_a_changed_file_is_refused(job):
    write_trip_file(job.trips, "2024-01", [trip()])
    job.run()
    write_trip_file(job.trips, "2024-01", [trip(), trip(vendor=2), trip(vendor=3)])
    with pytest.raises(ValueError, match="2024-01"):
        job.run()
    assert len(job.rows()) == 1
