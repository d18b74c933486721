import json
import random
import statistics

from pyspark.sql import functions as F

from faremill.functions.units import finite_text, percent_over, ratio, used_mib
from faremill.operators.metrics import (
    CPU_COUNTERS, array_median, busy_percent, execution_checks, phase_maxima, trial_medians, variant_ratios)
from faremill.operators.stage import cached, feature_stage, speed_check
from faremill.plans.evidence import require_completed
from faremill.sources.documents import read_metrics, read_samples
import pytest


def test_busy_percent_against_a_loop(spark):
    rng, rows = random.Random(3), []
    for trace in ("a", "b", None):
        at, counters = rng.uniform(0, 100), [0] * 8
        for _ in range(60):
            # Steps from half a second to several spans; some samples stand still.
            at += rng.choice([0.5, 700.0, 4000.0, 15000.0])
            counters = [c + rng.choice([0, 0, 5]) for c in counters]
            rows.append((trace, at, *counters))
    schema = "trace string, monotonic_seconds double, " + ", ".join(f"{c} long" for c in CPU_COUNTERS)
    rng.shuffle(rows)
    got = {(r.trace, r.monotonic_seconds): r.host_cpu_busy_percent
           for r in busy_percent(spark.createDataFrame(rows, schema), ["trace"]).collect()}
    expected, previous = {}, {}
    for trace, at, *counters in sorted(rows, key=lambda r: r[1]):
        now = sum(counters), counters[3] + counters[4]
        busy = None
        if trace in previous:
            total, idle = now[0] - previous[trace][0], now[1] - previous[trace][1]
            busy = 100.0 * (total - idle) / total if total > 0 else None
        expected[trace, at], previous[trace] = busy, now
    assert got == expected


def test_samples_and_maxima(spark, tmp_path):
    def line(at, phase, cpu, used):
        return json.dumps({"utc": "2026-01-01T00:00:00+00:00", "monotonic_seconds": at, "phase": phase,
                           "host_ram_total_mib": 100.0, "host_ram_used_mib": used, "host_swap_used_mib": 1.0,
                           "host_cpu_busy_percent": cpu})
    (tmp_path / "one_resources.jsonl").write_text("\n".join([line(2.0, "p", 50.0, 10.0), line(1.0, "p", None, 30.0)]) + "\n")
    (tmp_path / "two_resources.jsonl").write_text(line(5.0, "p", None, 7.0) + "\n")
    got = {r.trace: r for r in phase_maxima(read_samples(spark, str(tmp_path)), ["trace", "phase"]).collect()}
    one, two = got["one_resources"], got["two_resources"]
    assert (one.samples, one.max_observed_cpu_busy_percent, one.max_observed_ram_used_mib) == (2, 50.0, 30.0)
    assert (one.baseline.monotonic_seconds, one.baseline.host_ram_used_mib) == (1.0, 30.0)
    assert (two.samples, two.max_observed_cpu_busy_percent, two.baseline.host_cpu_busy_percent) == (1, None, None)


def document(run, variant, seconds, trials, status="completed"):
    return json.dumps({
        "run_id": run, "variant": variant, "status": status, "pipeline_seconds": seconds,
        "environment": {"python": "3", "package_versions": {"a": "1", "b": None}},
        "feature_stage": {
            "warmup_seconds_not_in_median": 9.0, "timed_runs_seconds": trials, "input_rows": 5,
            "execution_checks": [{"rows": 5, "speed_sum": 1.5}, {"rows": 5, "speed_sum": "nan"}, {"rows": 5, "speed_sum": None}],
        }}, indent=2)


def test_indented_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(document("r", "udf", 22.0, [3.0, 1.0, 2.0]))
    (tmp_path / "b.json").write_text(document("r", "native", 16.0, [4.0, 1.0, 2.0, 3.0]))
    (tmp_path / "c.json").write_text(document("r", "broken", 1.0, [], "running"))
    metrics = read_metrics(spark, str(tmp_path))
    medians = {r.variant: (r.trials, r.median_seconds, r.warmup_seconds) for r in trial_medians(metrics).collect()}
    assert medians == {"udf": (3, 2.0, 9.0), "native": (4, 2.5, 9.0), "broken": (0, None, 9.0)}
    checks = {(r.variant, r.trial): (r.rows, r.speed_sum) for r in execution_checks(metrics).collect()}
    assert checks["udf", 1] == (5, "1.5") and checks["udf", 2] == (5, "nan") and checks["udf", 3] == (5, None)
    row = variant_ratios(metrics, ["udf", "native"], "native").first()
    assert (row.udf_minus_native, row.udf_percent_over_native, row.udf_to_native) == (6.0, 37.5, 1.375)
    assert require_completed(metrics, ["udf", "native"]).count() == 2
    with pytest.raises(ValueError, match="broken"):
        require_completed(metrics, ["udf", "broken"])


def test_median_is_the_textbook_one(spark):
    rng = random.Random(5)
    arrays = [[rng.uniform(-5, 5) for _ in range(n)] for n in range(1, 12)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, a array<double>")
    got = {r.i: r.m for r in df.select("i", array_median(df.a).alias("m")).collect()}
    assert got == {i: statistics.median(a) for i, a in enumerate(arrays)}


def test_units(spark):
    df = spark.createDataFrame([(3.0, 2.0), (1.0, 0.0)], "a double, b double")
    got = [tuple(r) for r in df.select(percent_over(df.a, df.b), ratio(df.a, df.b)).collect()]
    assert got == [(50.0, 1.5), (None, None)]
    texts = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in texts.select(finite_text(texts.x)).collect()] == ["nan", "inf", "-inf", "1.5", None]
    row = spark.range(1).select(used_mib(F.lit(4096), F.lit(1024)).alias("m")).first()
    assert row.m == 3.0


def test_feature_stage(spark):
    df = spark.createDataFrame([(1.0, 0.5, 2.0, "x"), (1.0, 0.0, None, "y")],
                               "trip_distance double, trip_duration_hours double, average_speed_mph double, other string")
    with cached(feature_stage(df)) as held:
        assert held.is_cached and held.columns == ["trip_distance", "trip_duration_hours", "average_speed_mph"]
        assert tuple(speed_check(held).first()) == (2, 2.0, "2.0")
    assert not held.is_cached
