import os

import pytest

from faremill.__main__ import main
from faremill.session import scratch_path
from faremill.sources.files import read_output
from helpers import trip, write_trip_file
from test_metrics import document


@pytest.fixture()
def paths(tmp_path):
    write_trip_file(tmp_path / "in", "2024-01", [trip(), trip(), trip(vendor=2)])
    write_trip_file(tmp_path / "in", "2024-02", [trip(vendor=3)])
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,N/A,\n2,,Astoria,Boro Zone\n")
    return {name: str(tmp_path / name) for name in (
        "in", "zones.csv", "native", "udf", "months", "ledger", "report", "stream", "stream-ledger", "checkpoint", "subset", "manifest",
        "summary", "metrics", "run.log")} | {"glob": str(tmp_path / "in" / "*.parquet")}


def test_export_compare_and_validate(spark, paths, tmp_path, capsys):
    source = ["--trips", paths["in"], "--zones", paths["zones.csv"]]
    main(["export", *source, "--output", paths["native"]])
    # A glob of files is a path as well.
    main(["export", "--trips", paths["glob"], *source[2:], "--output", paths["udf"], "--speed", "udf"])
    assert "seconds: " in capsys.readouterr().out
    assert read_output(spark, paths["native"]).count() == 3
    main(["prepare", *source, "--subset", paths["subset"], "--manifest", paths["manifest"], "--rows", "2"])
    (tmp_path / "metrics").mkdir()
    for variant in ("udf", "native"):
        (tmp_path / "metrics" / f"{variant}.json").write_text(document("r", variant, 1.0, [1.0]))
    main(["compare", f"udf={paths['udf']}", f"native={paths['native']}", "--summary", paths["summary"],
          "--manifest", paths["manifest"], "--metrics", paths["metrics"]])
    found = spark.read.json(f"{paths['summary']}/comparisons").first()
    assert found.equal_values_with_multiplicity and (found.left, found.right) == ("udf", "native")
    assert {r["name"]: r["rows"] for r in spark.read.json(f"{paths['summary']}/datasets").collect()} == {"udf": 3, "native": 3}
    summary = spark.read.json(f"{paths['summary']}/summary").collect()
    assert len(summary) == 1 and summary[0]["input_rows"] == 2 and summary[0]["mismatch_examples"] == []
    assert {(b["variant"], b["median_seconds"], b["trials"]) for b in summary[0]["benchmarks"]} == {("udf", 1.0, 1), ("native", 1.0, 1)}
    assert [s["files"] for s in summary[0]["inspected_file_schemas"]] == [1, 1] and len(summary[0]["comparisons"]) == 1
    main(["validate", "--path", paths["native"]])
    main(["profile", "--path", paths["in"]])
    shown = capsys.readouterr().out
    assert "yellow_tripdata_2024-01.parquet" in shown and "2024-02" in shown


def test_months_stream_and_logs(spark, paths, tmp_path, capsys):
    source = ["--trips", paths["in"], "--zones", paths["zones.csv"]]
    main(["months", *source, "--output", paths["months"], "--ledger", paths["ledger"], "--report", paths["report"]])
    main(["stream", *source, "--output", paths["stream"], "--ledger", paths["stream-ledger"], "--checkpoint", paths["checkpoint"]])
    assert spark.read.parquet(paths["months"]).count() == spark.read.parquet(paths["stream"]).count() == 3
    (tmp_path / "run.log").write_text("Completed 2024-01: 2 rows, 4.25 seconds\n")
    main(["runlog", "--log", paths["run.log"]])
    main(["runlog", "--log", paths["run.log"], "--report", paths["report"]])
    assert capsys.readouterr().out.count("4.25") >= 2


def test_unknown_speed_is_refused(paths):
    with pytest.raises(SystemExit):
        main(["export", "--trips", "a", "--zones", "b", "--output", "c", "--speed", "best"])


def test_deliveries_and_scratch(spark, paths, capsys):
    source = ["--trips", paths["in"], "--zones", paths["zones.csv"], "--output", paths["native"], "--seen", paths["ledger"]]
    main(["deliver", *source])
    write_trip_file(paths["in"], "2024-03", [trip(), trip(vendor=9)])
    main(["deliver", *source])
    main(["deliver", *source])
    assert capsys.readouterr().out.split() == ["deliveries", "done:", "1", "deliveries", "done:", "2", "deliveries", "done:", "2"]
    assert read_output(spark, paths["native"]).count() == 4
    assert not os.path.exists(os.path.dirname(scratch_path(spark, "x")))
