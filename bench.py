"""Times of the headline jobs; prints one JSON line.

The trips are delivered as month files first (not timed), so that every export runs from
ingestion to export. The feature stage is the median of three runs over cached input, after
a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import proxies  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from faremill.operators.clean import add_speed  # noqa: E402
from faremill.operators.stage import cached, feature_stage, speed_check  # noqa: E402
from faremill.plans.evidence import compare_exports, validate_export  # noqa: E402
from faremill.plans.export import export_trips, joined_trips  # noqa: E402
from faremill.plans.months import export_months  # noqa: E402
from faremill.session import get_session, scratch_path  # noqa: E402
from faremill.sources.footers import profile_files  # noqa: E402
from faremill.sources.trips import read_trips  # noqa: E402
from faremill.sources.zones import read_zones  # noqa: E402
from faremill.streaming.months import stream_months  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
VARIANTS = ("native", "udf", "pandas")


def timed(function, *args):
    started = time.perf_counter()
    result = function(*args)
    return time.perf_counter() - started, result


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_session("bench", **{
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    trips_path, zones_path = scratch_path(spark, "bench-trips"), scratch_path(spark, "bench-zones")
    proxies.write_month_files(proxies.trips(spark, SF_DIR), trips_path)
    proxies.write_zone_file(proxies.zones(spark, SF_DIR), zones_path)
    input_rows = read_trips(spark, trips_path).count()
    zones = read_zones(spark, zones_path)
    seconds: dict[str, float] = {}

    export_trips(spark, trips_path, zones_path, scratch_path(spark, "bench-warm"))
    outputs = {}
    for how in VARIANTS:
        outputs[how] = scratch_path(spark, f"bench-{how}")
        seconds[f"export_{how}"], _ = timed(export_trips, spark, trips_path, zones_path, outputs[how], how)

    months, ledger = scratch_path(spark, "bench-months"), scratch_path(spark, "bench-ledger")
    for name in ("export_months", "export_months_again"):
        seconds[name], _ = timed(lambda: export_months(spark, trips_path, zones, months, ledger).collect())
    seconds["stream_months"], _ = timed(lambda: stream_months(
        spark, trips_path, zones, scratch_path(spark, "bench-streamed"), scratch_path(spark, "bench-stream-ledger"),
        scratch_path(spark, "bench-stream"), 1000).collect())

    seconds["compare_exports"], pairs = timed(lambda: compare_exports(spark, outputs, "udf").collect())
    if not all(pair["equal_values_with_multiplicity"] for pair in pairs):
        raise RuntimeError(f"the exports differ: {pairs}")
    seconds["validate_export"], found = timed(lambda: validate_export(spark, outputs["native"]).first())
    seconds["profile_files"], _ = timed(lambda: profile_files(spark, trips_path).collect())

    with cached(joined_trips(read_trips(spark, trips_path), zones)) as joined:
        joined.count()
        for how in VARIANTS:
            trials = []
            for _ in range(4):
                with cached(feature_stage(add_speed(joined, how))) as features:
                    spent, _ = timed(features.count)
                    trials.append(spent)
                    speed_check(features).first()
            seconds[f"feature_stage_{how}"] = statistics.median(trials[1:])

    for name in ("distinct_global", "join_pickup", "join_pickup_shuffled", "multiset_diff", "counter_rate",
                 "runlog_reconstruct"):
        seconds[name], _ = timed(lambda: run(QUERIES[name](spark, SF_DIR)))

    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(value, 4) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "input_rows": input_rows, "output_rows": found["rows"],
        "rows_per_second": {how: round(input_rows / seconds[f"export_{how}"]) for how in VARIANTS},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
