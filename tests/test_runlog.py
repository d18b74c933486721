from faremill.operators.runlog import (
    AMBIGUOUS_SCOPE, COMPLETED_SCOPE, EXECUTED_SCOPE, completed_lines, executed_lines, last_per_month, log_events, pair_writes, reconstruct, reconstruct_events,
    runtime_totals, write_events, written_lines)
from faremill.sources.documents import read_log
from helpers import plan_of

DONE = """starting
Completed 2024-02: 3,303,105 rows, 96.79 seconds
Completed 2024-01: 10 rows, 1.50 seconds
Completed 24-01: 10 rows, 1.50 seconds
Completed 2024-02: 3,303,106 rows, 6.10 seconds
"""


def executed(at, dataset, seconds, prefix=""):
    return f"{prefix}{at}\tINFO executor.py:365 -- ok  Dataset {dataset} execution finished in {seconds} seconds"


def written(at, rows, prefix=""):
    return f"{prefix}{at}\tINFO dataset.py:6680 -- Data sink Parquet finished. {rows} rows and 7.3MiB data written."


def test_the_last_line_of_a_month_wins(spark, tmp_path):
    (tmp_path / "run.log").write_text(DONE)
    months = last_per_month(completed_lines(log_events(read_log(spark, str(tmp_path)))))
    assert {r.month: (r.rows, r.seconds) for r in months.collect()} == {"2024-01": (10, 1.5), "2024-02": (3303106, 6.1)}
    assert tuple(runtime_totals(months).first()) == (2, 7.6, 7.6 / 60)


def test_lines_keep_their_order_when_a_file_is_split(spark, tmp_path):
    lines = [f"Completed 2024-{i % 3 + 1:02d}: {i} rows, {i}.5 seconds" for i in range(20_000)]
    (tmp_path / "run.log").write_text("\n".join(lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "50000")
    try:
        log = read_log(spark, str(tmp_path))
        assert log.select("line_at.block_start").distinct().count() > 5
        months = last_per_month(completed_lines(log_events(log))).collect()
    finally:
        spark.conf.set(key, before)
    assert {r.month: r.rows for r in months} == {"2024-01": 19998, "2024-02": 19999, "2024-03": 19997}


def test_writes_are_paired_with_the_execution_before_them(spark, tmp_path):
    one, two = "/s/session_1/logs/", "/s/session_2/logs/"
    (tmp_path / "grep.txt").write_text("\n".join([
        executed("2026-10-05 00:26:32,764", "dataset_a_0", "74.66", f"{one}dataset_a.log:"),
        executed("2026-10-05 00:26:32,764", "dataset_a_0", "74.66", f"{one}shared.log:"),
        written("2026-10-05 00:26:33,527", 500, f"{one}shared.log:"),
        executed("2026-10-05 00:31:02,244", "dataset_b_0", "73.44", f"{one}shared.log:"),
        written("2026-10-05 00:31:02,244", 500, f"{one}shared.log:"),
        # Written more than an hour after its execution, while another session runs.
        executed("2026-10-05 02:00:00,000", "dataset_c_0", "9.00", f"{two}shared.log:"),
        executed("2026-10-05 03:59:00,000", "dataset_d_0", "8.00", f"{one}shared.log:"),
        written("2026-10-05 03:59:59,000", 700, f"{two}shared.log:"),
        # Nothing finished before this one in its session.
        written("2026-10-05 01:00:00,000", 900, f"{two}shared.log:"),
        "Completed 2024-03: 700 rows, 4.25 seconds",
    ]))
    log = read_log(spark, str(tmp_path))
    assert executed_lines(log_events(log)).count() == 4
    pairs = {(r.session, r.written_at % 10**7, r.rows): (r.dataset, r.seconds)
             for r in pair_writes(executed_lines(log_events(log)), written_lines(log_events(log))).collect()}
    assert sorted(str(v) for v in pairs.values()) == [
        "('dataset_a_0', 74.66)", "('dataset_b_0', 73.44)", "('dataset_c_0', 9.0)", "(None, None)"]
    report = spark.createDataFrame([("2024-01", 500), ("2024-03", 700), ("2024-04", 900), ("2024-05", 1)], "month string, rows long")
    got = {r.month: (r.runtime_seconds, r.rows, r.timing_scope) for r in reconstruct(log, report).collect()}
    assert got == {"2024-01": (73.44, 500, EXECUTED_SCOPE), "2024-03": (4.25, 700, COMPLETED_SCOPE)}


def test_months_of_one_size(spark, tmp_path):
    shared = "/s/session_1/logs/shared.log:"
    lines = []
    for i, (rows, seconds) in enumerate([(10, "5.00"), (10, "9.00"), (20, "1.00"), (20, "2.00"), (20, "3.00"), (30, "7.00")]):
        lines += [executed(f"2026-10-05 00:{i:02d}:00,000", f"dataset_{i}_0", seconds, shared), written(f"2026-10-05 00:{i:02d}:01,000", rows, shared)]
    (tmp_path / "grep.txt").write_text("\n".join(lines))
    report = spark.createDataFrame([("2024-01", 10), ("2024-02", 10), ("2024-03", 20), ("2024-04", 20), ("2024-05", 30)], "month string, rows long")
    got = {r.month: (r.runtime_seconds, r.timing_scope) for r in reconstruct(read_log(spark, str(tmp_path)), report).collect()}
    assert got == {"2024-01": (5.0, EXECUTED_SCOPE), "2024-02": (9.0, EXECUTED_SCOPE), "2024-03": (None, AMBIGUOUS_SCOPE),
                   "2024-04": (None, AMBIGUOUS_SCOPE), "2024-05": (7.0, EXECUTED_SCOPE)}


def test_a_log_is_scanned_once(spark, tmp_path):
    lines = [executed("2026-10-05 00:00:00,000", "dataset_a_0", "5.00"), written("2026-10-05 00:00:01,000", 10), "noise", "Completed 2024-02: 3 rows, 1.00 seconds"]
    (tmp_path / "run.log").write_text("\n".join(lines))
    log = read_log(spark, str(tmp_path / "run.log"))
    assert plan_of(log_events(log), "simple").count("FileScan text") == 1
    events = write_events(log, str(tmp_path / "events"))
    assert sorted(r.kind for r in events.collect()) == ["completed", "executed", "written"]
    report = spark.createDataFrame([("2024-01", 10), ("2024-02", 3)], "month string, rows long")
    for found in (reconstruct(log, report), reconstruct_events(events, report)):
        assert "FileScan text" not in plan_of(found, "simple")
        assert {r.month: r.runtime_seconds for r in found.collect()} == {"2024-01": 5.0, "2024-02": 1.0}


def test_a_line_may_say_several_things(spark, tmp_path):
    line = "Completed 2024-02: 3 rows, 1.00 seconds; " + executed("2026-10-05 00:00:00,000", "dataset_a_0", "5.00")
    (tmp_path / "run.log").write_text(f"{line}\n\n")
    got = {r.kind: (r.month, r.rows, r.seconds, r.dataset) for r in log_events(read_log(spark, str(tmp_path))).collect()}
    assert got == {"completed": ("2024-02", 3, 1.0, None), "executed": (None, None, 5.0, "dataset_a_0")}


def test_many_tries_of_one_size_are_not_put_in_turn(spark, tmp_path):
    shared = "/s/session_1/logs/shared.log:"
    lines = []
    for i in range(300):
        lines += [executed(f"2026-10-05 {i // 60:02d}:{i % 60:02d}:00,000", f"dataset_{i}_0", f"{i}.50", shared),
                  written(f"2026-10-05 {i // 60:02d}:{i % 60:02d}:01,000", 10, shared)]
    (tmp_path / "grep.txt").write_text("\n".join(lines))
    log = read_log(spark, str(tmp_path))
    one = spark.createDataFrame([("2024-01", 10)], "month string, rows long")
    assert reconstruct(log, one).first().runtime_seconds == 299.5
    two = spark.createDataFrame([("2024-01", 10), ("2024-02", 10)], "month string, rows long")
    assert {(r.runtime_seconds, r.timing_scope) for r in reconstruct(log, two).collect()} == {(None, AMBIGUOUS_SCOPE)}
