"""The same results as SQL over the driver's tables."""

from __future__ import annotations

from checks.queries import EMPTIED, SECOND_DELIVERY, SUBSET_ROWS, VARIANTS
from faremill.schemas import TRIP_COLUMNS

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

TRIP = TRIP_COLUMNS
RAW = ", ".join(TRIP)
TEXT = "'%Y-%m-%d %H:%M:%S'"
SHOWN = ", ".join(f"strftime({c}, {TEXT}) AS {c}" if c.startswith("tpep_") else c for c in TRIP)


def _base(month: str) -> str:
    return f"""SELECT l_linenumber AS VendorID,
      CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS tpep_pickup_datetime,
      l_shipdate AS tpep_dropoff_datetime,
      CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS passenger_count,
      l_quantity - 5.0 AS trip_distance, c_nationkey AS PULocationID, s_nationkey AS DOLocationID,
      l_extendedprice AS fare_amount, o_totalprice AS total_amount, {month} AS source_month
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""


_MONTH = _base("strftime(o_orderdate, '%Y-%m')")
TRIPS = f"""trips AS (SELECT * FROM ({_MONTH})
    UNION ALL SELECT * FROM ({_MONTH}) WHERE VendorID = 3
    UNION ALL SELECT * FROM ({_base("'1990-01'")}) WHERE VendorID = 4)"""
ZONES = """zones AS (SELECT n_nationkey AS LocationID,
      CASE WHEN n_nationkey % 9 = 0 THEN NULL ELSE r_name END AS Borough,
      CASE WHEN n_nationkey = 7 THEN 'N/A' ELSE n_name END AS Zone,
      CASE WHEN n_nationkey % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 23)"""
SHORT = """short AS (SELECT event_id, ts AS p, ts + to_milliseconds(CAST(floor(value * 10) AS BIGINT)) AS d,
      value AS trip_distance FROM events)"""
SECONDS = "CAST(epoch(date_trunc('second', {d})) - epoch(date_trunc('second', {p})) AS BIGINT) / 3600.0::DOUBLE"
FRACTION = "CAST(epoch_us({d}) - epoch_us({p}) AS DOUBLE) / 1e6 / 3600.0::DOUBLE"
_VALID = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance IS NOT NULL
      AND NOT isnan(trip_distance) AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
      AND trip_distance > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime"""


def _default(column: str) -> str:
    return f"coalesce(nullif({column}, ''), 'Unknown')"


def _side(prefix: str, alias: str) -> str:
    return ", ".join(
        f"CASE WHEN {alias}.LocationID IS NULL THEN NULL ELSE {_default(f'{alias}.{c}')} END AS {prefix}_{c.lower()}"
        for c in ("Borough", "Zone", "service_zone"))


def _output(scope: str, unit: str = SECONDS, invalid: str = "NULL") -> str:
    month = ", source_month" if scope == "month" else ""
    hours = unit.format(p="tpep_pickup_datetime", d="tpep_dropoff_datetime")
    return f"""SELECT VendorID, passenger_count, trip_distance, fare_amount, total_amount, PULocationID, DOLocationID,
      strftime(tpep_pickup_datetime, {TEXT}) AS pickup_timestamp,
      strftime(tpep_dropoff_datetime, {TEXT}) AS dropoff_timestamp,
      {hours} AS trip_duration_hours,
      CASE WHEN {hours} > 0 THEN trip_distance / ({hours}) ELSE {invalid} END AS average_speed_mph,
      {_side("pickup", "a")}, {_side("dropoff", "b")}{month}
    FROM (SELECT DISTINCT {RAW}{month} FROM trips WHERE {_VALID}) t
      LEFT JOIN zones a ON PULocationID = a.LocationID LEFT JOIN zones b ON DOLocationID = b.LocationID"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + "\n"


CLEANED = _with(TRIPS, ZONES) + _output("global")
MONTHLY = _with(TRIPS, ZONES) + _output("month", FRACTION, "'nan'::DOUBLE")
BOTH = _with(TRIPS, ZONES, f"whole AS ({_output('global')})",
             f"monthly AS (SELECT * EXCLUDE (source_month) FROM ({_output('month')}))")

# A delivered month without a valid trip is reported with no rows.
MONTH_REPORT = _with(TRIPS) + f"""SELECT source_month AS month, count(*) FILTER (kept IS NOT NULL) AS rows
    FROM (SELECT DISTINCT source_month FROM trips)
      LEFT JOIN (SELECT source_month, 1 AS kept FROM ({MONTHLY})) USING (source_month) GROUP BY source_month"""


def _speed(invalid: str) -> str:
    hours = SECONDS.format(p="p", d="d")
    return _with(SHORT) + f"""SELECT event_id,
      CASE WHEN {hours} > 0 THEN trip_distance / ({hours}) ELSE {invalid} END AS average_speed_mph FROM short"""


def _hex(value: str) -> str:
    text = f"format('{{:a}}', abs({value}))"
    return f"""CASE WHEN {value} = 0 THEN '0x0.0p+0' ELSE
      CASE WHEN {value} < 0 THEN '-' ELSE '' END || '0x1.'
      || rpad(regexp_extract({text}, '0x1\\.?([0-9a-f]*)p', 1), 13, '0') || 'p'
      || regexp_extract({text}, 'p([+-][0-9]+)', 1) END"""


def _tagged(value: str, kind: str) -> str:
    body = _hex(value) if kind == "float" else f"CAST({value} AS VARCHAR)"
    return f"""coalesce('["{kind}","' || {body} || '"]', '["null"]')"""


def _record(kinds: dict[str, str]) -> str:
    return "'[' || " + " || ',' || ".join(_tagged(c, k) for c, k in kinds.items()) + " || ']'"


_OUTPUT_KINDS = {
    "VendorID": "integer", "passenger_count": "integer", "trip_distance": "float", "fare_amount": "float",
    "total_amount": "float", "PULocationID": "integer", "DOLocationID": "integer", "pickup_timestamp": "text",
    "dropoff_timestamp": "text", "trip_duration_hours": "float", "average_speed_mph": "float",
    "pickup_borough": "text", "pickup_zone": "text", "pickup_service_zone": "text", "dropoff_borough": "text",
    "dropoff_zone": "text", "dropoff_service_zone": "text",
}

SAMPLES = """counters AS (SELECT CAST(user_id AS VARCHAR) AS trace, event_type AS phase,
      CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS monotonic_seconds, event_id AS e, CAST(floor(value) AS BIGINT) AS v
    FROM events),
  summed AS (SELECT *, e * 2 - v * 40 + 5 + e + e * 3 + v + e % 7 AS total, e * 3 + v AS idle FROM counters),
  paired AS (SELECT *, lag(total) OVER w AS past_total, lag(idle) OVER w AS past_idle FROM summed
    WINDOW w AS (PARTITION BY trace, phase ORDER BY monotonic_seconds)),
  samples AS (SELECT trace, phase, monotonic_seconds,
      CAST(4000000 + e % 1024 AS DOUBLE) / 1024e0 AS host_ram_total_mib,
      CAST(4000000 + e % 1024 - v * 1000 AS DOUBLE) / 1024e0 AS host_ram_used_mib,
      CAST(2000000 - e % 9973 AS DOUBLE) / 1024e0 AS host_swap_used_mib,
      CASE WHEN total - past_total > 0 THEN 1e2 * CAST((total - past_total) - (idle - past_idle) AS DOUBLE)
        / CAST(total - past_total AS DOUBLE) END AS host_cpu_busy_percent
    FROM paired)"""

RUNS = """runs AS (SELECT o_orderkey AS key, strftime(o_orderdate, '%Y-%m') AS month,
      month(o_orderdate) AS month_of_year, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS rows,
      CAST(floor(o_totalprice) AS DOUBLE) / 1e2 AS seconds FROM orders),
  latest AS (SELECT month, max(rows) AS rows, max(month_of_year) AS month_of_year, arg_max(seconds, key) AS seconds
    FROM runs GROUP BY month)"""


def _variant_columns() -> str:
    parts = [f"max(CASE WHEN event_type = '{v}' THEN s END) AS {v}_seconds" for v in VARIANTS]
    return ", ".join(parts)


def _variant_ratios(base: str) -> str:
    parts = []
    for v in VARIANTS:
        if v != base:
            own, against = f"{v}_seconds", f"{base}_seconds"
            parts += [f"{own} - {against} AS {v}_minus_{base}",
                      f"CASE WHEN {against} <> 0 THEN 1e2 * ({own} - {against}) / {against} END AS {v}_percent_over_{base}",
                      f"CASE WHEN {against} <> 0 THEN {own} / {against} END AS {v}_to_{base}"]
    return ", ".join(parts)


_TRIALS = """CASE WHEN event_id % 2 = 0 THEN [value, value * 3, value * 2]
      ELSE [value * 4, value, value * 3, value * 2] END"""

SUBSET_SCHEMA = "\n".join(f"{name}: {kind}" for name, kind in zip(TRIP_COLUMNS, (
    "int32 timestamp[us] timestamp[us] int64 double int32 int32 double double").split()))


def _names(column: str) -> str:
    return "WITH names AS (" + " UNION ALL ".join(f"SELECT '{t}.parquet' AS {column}" for t in TABLES) + ")"


ORACLES: dict[str, str] = {
    "clean_enrich_export": CLEANED,
    "clean_enrich_udf": CLEANED,
    "clean_enrich_pandas": CLEANED,
    "clean_enrich_month_scope": MONTHLY,
    "export_roundtrip": CLEANED,
    "project_trip_columns": _with(TRIPS) + f"SELECT {SHOWN} FROM trips",
    "trip_files_scan": _with(TRIPS) + f"SELECT {SHOWN} FROM trips",
    "trip_months_scan": _with(TRIPS) + f"SELECT {SHOWN}, source_month FROM trips",
    "one_month_scan": _with(TRIPS) + f"SELECT {SHOWN}, source_month FROM trips WHERE source_month = '1990-01'",
    "month_from_file_name": _with(TRIPS) + "SELECT source_month, count(*) AS trips FROM trips GROUP BY source_month",
    "lookup_csv_roundtrip": _with(ZONES) + "SELECT * FROM zones",
    "fixed_subset": f"SELECT event_id, user_id, event_type, value FROM events WHERE event_id < {SUBSET_ROWS}",
    "file_listing": " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name" for t in TABLES),
    "file_rows": " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS rows FROM {t}" for t in TABLES),
    "required_not_null": _with(TRIPS) + f"""SELECT {SHOWN}, source_month FROM trips
      WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance IS NOT NULL
        AND NOT isnan(trip_distance) AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL""",
    "distinct_global": _with(TRIPS) + f"SELECT {SHOWN} FROM (SELECT DISTINCT {RAW} FROM trips)",
    "distinct_by_month": _with(TRIPS) + f"SELECT {SHOWN}, source_month FROM (SELECT DISTINCT {RAW}, source_month FROM trips)",
    "valid_trips": _with(TRIPS) + f"""SELECT {SHOWN}, source_month FROM trips
      WHERE trip_distance > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime""",
    "timestamp_texts": _with(SHORT) + f"""SELECT event_id, strftime(p, {TEXT}) AS pickup_timestamp,
      strftime(d, {TEXT}) AS dropoff_timestamp FROM short""",
    "duration_seconds": _with(SHORT) + f"SELECT event_id, {SECONDS.format(p='p', d='d')} AS trip_duration_hours FROM short",
    "duration_fraction": _with(SHORT) + f"SELECT event_id, {FRACTION.format(p='p', d='d')} AS trip_duration_hours FROM short",
    "speed_guarded": _speed("NULL"),
    "speed_try_divide": _speed("NULL"),
    "speed_udf": _speed("NULL"),
    "speed_pandas": _speed("NULL"),
    "speed_nan": _speed("'nan'::DOUBLE"),
    "speed_udf_nan": _speed("'nan'::DOUBLE"),
    "speed_pandas_nan": _speed("'nan'::DOUBLE"),
    "speed_unguarded_negative": _with(SHORT, f"""timed AS (SELECT event_id, trip_distance,
      (CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END) * ({SECONDS.format(p='p', d='d')}) AS hours FROM short)""")
    + "SELECT event_id, CASE WHEN hours <> 0 THEN trip_distance / hours END AS average_speed_mph FROM timed",
    "lookup_empty_text": _with(ZONES) + f"""SELECT LocationID AS PULocationID,
      CASE WHEN LocationID % 4 = 1 THEN 'Unknown' ELSE {_default('Borough')} END AS pickup_borough,
      {_default('Zone')} AS pickup_zone, {_default('service_zone')} AS pickup_service_zone FROM zones""",
    "gib_totals": "SELECT c_custkey, c_custkey * 3 / 1024.0::DOUBLE AS gib FROM customer",
    "finite_text_values": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'nan' WHEN 1 THEN 'inf' WHEN 2 THEN '-inf'
      ELSE CAST(CAST(event_id AS DOUBLE) AS VARCHAR) END AS text FROM events""",
    "speed_map_batches": _with(SHORT) + f"""SELECT event_id, trip_distance, {FRACTION.format(p='p', d='d')} AS trip_duration_hours,
      trip_distance / ({FRACTION.format(p='p', d='d')}) AS average_speed_mph FROM short WHERE d > p""",
    "speed_check_sum": f"SELECT count(*) AS rows, round(sum(average_speed_mph), 4) AS speed_sum FROM ({CLEANED})",
    "speed_sum_not_finite": f"""SELECT count(*) AS rows, CASE WHEN isnan(sum(average_speed_mph)) THEN 'nan' END AS speed_sum_text
      FROM ({_speed("'nan'::DOUBLE")})""",
    "feature_columns": f"SELECT trip_distance, trip_duration_hours, average_speed_mph FROM ({CLEANED})",
    "zone_defaults": _with(ZONES) + "SELECT LocationID AS PULocationID, " + ", ".join(
        f"{_default(c)} AS pickup_{c.lower()}" for c in ("Borough", "Zone", "service_zone")) + " FROM zones",
    "join_pickup": _with(TRIPS, ZONES) + f"""SELECT {SHOWN}, source_month, {_side("pickup", "a")}
      FROM trips LEFT JOIN zones a ON PULocationID = a.LocationID""",
    "join_dropoff": _with(TRIPS, ZONES) + f"""SELECT {SHOWN}, source_month, {_side("dropoff", "a")}
      FROM trips LEFT JOIN zones a ON DOLocationID = a.LocationID""",
    "unmatched_pickup_zones": _with(TRIPS, ZONES) + """SELECT PULocationID, count(*) AS trips FROM trips
      WHERE PULocationID NOT IN (SELECT LocationID FROM zones) GROUP BY PULocationID""",
    "zone_key_check": _with(ZONES) + """SELECT LocationID, count(*) AS n
      FROM (SELECT * FROM zones UNION ALL SELECT * FROM zones WHERE LocationID = 5) GROUP BY LocationID HAVING count(*) > 1""",
    "file_totals": "SELECT CAST(count(*) AS BIGINT) AS files, CAST(sum(n) AS BIGINT) AS rows FROM ("
                   + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in TABLES) + ")",
    "output_validation": f"SELECT count(*) AS rows, CAST(1 AS BIGINT) AS schemas FROM ({CLEANED})",
    "delivered_month_report": _with(TRIPS) + "SELECT source_month AS month, count(*) AS rows FROM trips GROUP BY source_month",
    "month_report_rows": MONTH_REPORT,
    "written_month_rows": f"SELECT source_month AS month, count(*) AS rows FROM ({MONTHLY}) GROUP BY source_month",
    "month_totals": f"SELECT count(*) AS months, CAST(sum(rows) AS BIGINT) AS rows FROM ({MONTH_REPORT})",
    "file_manifest_changes": _names("name") + """, stored AS (
        SELECT CASE name WHEN 'nation.parquet' THEN 'gone.parquet' ELSE name END AS name, name = 'orders.parquet' AS other
        FROM names WHERE name <> 'region.parquet')
      SELECT coalesce(n.name, s.name) AS file_name,
        CASE WHEN n.name IS NULL THEN 'missing' WHEN s.name IS NULL THEN 'added' ELSE 'changed' END AS change
      FROM names n FULL JOIN stored s ON n.name = s.name WHERE n.name IS NULL OR s.name IS NULL OR s.other""",
    "trip_multiplicity": _with(TRIPS) + "SELECT CAST(VendorID AS BIGINT) AS VendorID, " + ", ".join(
        f"strftime({c}, {TEXT}) AS {c}" if c.startswith("tpep_")
        else f"CAST({c} AS BIGINT) AS {c}" if c.endswith("LocationID") else c for c in TRIP[1:]
    ) + f", count(*) AS n FROM trips GROUP BY {RAW}",
    "canonical_records": _with(SHORT, f"""timed AS (SELECT event_id, strftime(p, {TEXT}) AS pickup_timestamp,
      trip_distance, {SECONDS.format(p='p', d='d')} AS trip_duration_hours FROM short)""",
                               """fast AS (SELECT *, CASE WHEN trip_duration_hours > 0
      THEN trip_distance / trip_duration_hours END AS average_speed_mph FROM timed)""")
    + "SELECT event_id, " + _record({"event_id": "integer", "pickup_timestamp": "text", "trip_distance": "float",
                                     "trip_duration_hours": "float", "average_speed_mph": "float"}) + " AS record FROM fast",
    "multiset_diff": BOTH + """SELECT 'whole' AS "left", 'month' AS "right",
      (SELECT count(*) FROM (SELECT * FROM whole EXCEPT ALL SELECT * FROM monthly)) = 0
        AND (SELECT count(*) FROM (SELECT * FROM monthly EXCEPT ALL SELECT * FROM whole)) = 0 AS equal_values_with_multiplicity,
      (SELECT count(*) FROM (SELECT * FROM whole EXCEPT ALL SELECT * FROM monthly)) AS left_unmatched_row_instances,
      (SELECT count(*) FROM (SELECT * FROM monthly EXCEPT ALL SELECT * FROM whole)) AS right_unmatched_row_instances""",
    # The second form of the speed is another expression: null unless the quotient is positive.
    "multiset_equal": _with(TRIPS, ZONES, f"whole AS ({_output('global')})", """other AS (SELECT * REPLACE (
        CASE WHEN isfinite(trip_distance / trip_duration_hours) THEN trip_distance / trip_duration_hours END AS average_speed_mph)
        FROM whole)""") + " UNION ALL ".join(f"""SELECT 'udf' AS "left", '{how}' AS "right",
      (SELECT count(*) FROM (SELECT * FROM whole EXCEPT ALL SELECT * FROM {table})) = 0
        AND (SELECT count(*) FROM (SELECT * FROM {table} EXCEPT ALL SELECT * FROM whole)) = 0 AS equal_values_with_multiplicity,
      (SELECT count(*) FROM (SELECT * FROM whole EXCEPT ALL SELECT * FROM {table})) AS left_unmatched_row_instances,
      (SELECT count(*) FROM (SELECT * FROM {table} EXCEPT ALL SELECT * FROM whole)) AS right_unmatched_row_instances"""
      for how, table in (("native", "other"), ("pandas", "other"))),
    "speed_forms_compared": _with(SHORT) + f""", zero AS (SELECT count(*) AS n FROM short WHERE {SECONDS.format(p='p', d='d')} <= 0)
      SELECT 'udf' AS "left", 'native' AS "right", true AS equal_values_with_multiplicity, n - n AS left_unmatched_row_instances,
        n - n AS right_unmatched_row_instances FROM zero
      UNION ALL SELECT 'udf', 'pandas_nan', n = 0, n, n FROM zero""",
    "comparison_tables": BOTH + f""", tables AS ({' UNION ALL '.join(
        f"SELECT '{name}' AS name, * FROM {table}" for name, table in (("whole", "whole"), ("month", "monthly"), ("again", "whole")))}),
      counted AS (SELECT * EXCLUDE (name), count(*) FILTER (name = 'whole') AS w, count(*) FILTER (name = 'month') AS m,
          count(*) FILTER (name = 'again') AS a FROM tables GROUP BY ALL),
      sums AS (SELECT 'month' AS "right", sum(greatest(w - m, 0))::BIGINT AS l, sum(greatest(m - w, 0))::BIGINT AS r,
          least(3, count(*) FILTER (w > m)) + least(3, count(*) FILTER (m > w)) AS examples, sum(w)::BIGINT AS lr, sum(m)::BIGINT AS rr FROM counted
        UNION ALL SELECT 'again', sum(greatest(w - a, 0))::BIGINT, sum(greatest(a - w, 0))::BIGINT,
          least(3, count(*) FILTER (w > a)) + least(3, count(*) FILTER (a > w)), sum(w)::BIGINT, sum(a)::BIGINT FROM counted)
      SELECT 'whole' AS "left", "right", l = 0 AND r = 0 AS equal_values_with_multiplicity, l AS left_unmatched_row_instances,
        r AS right_unmatched_row_instances, examples::BIGINT AS examples, lr AS left_rows, rr AS right_rows,
        1::BIGINT AS left_schemas, 1::BIGINT AS right_schemas FROM sums""",
    "mismatch_examples": BOTH + f""", records AS (
        SELECT {_record(_OUTPUT_KINDS)} AS record, 1 AS l, 0 AS r FROM whole
        UNION ALL SELECT {_record(_OUTPUT_KINDS)}, 0, 1 FROM monthly),
      counted AS (SELECT record, CAST(sum(l) AS BIGINT) AS l, CAST(sum(r) AS BIGINT) AS r FROM records GROUP BY record),
      ranked AS (SELECT CASE WHEN l > r THEN 'whole' ELSE 'month' END AS side, greatest(l, r) AS count_on_side,
          least(l, r) AS count_on_other, record AS encoded_record FROM counted WHERE l <> r)
      SELECT side, count_on_side, count_on_other, encoded_record, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY side ORDER BY encoded_record) AS rank FROM ranked) WHERE rank <= 3""",
    "months_pending": _with(TRIPS) + f"SELECT DISTINCT source_month FROM trips WHERE source_month >= '{SECOND_DELIVERY}'",
    "incremental_global": CLEANED,
    "incremental_months": MONTHLY,
    "streamed_months": MONTHLY,
    "redelivered_months": MONTHLY,
    "emptied_month": f"SELECT * FROM ({MONTHLY}) WHERE source_month <> '{EMPTIED}'",
    "withdrawn_month": f"SELECT * FROM ({MONTHLY}) WHERE source_month <> '{EMPTIED}'",
    "digests_any_size": "SELECT n_nationkey, CAST(strlen(n_name) + 1 AS BIGINT) AS bytes, sha256(n_name || chr(10)) AS sha256 FROM nation",
    "counter_rate": _with(SAMPLES) + "SELECT * FROM samples",
    "resource_maxima": _with(SAMPLES) + """SELECT trace, phase, count(*) AS samples,
      max(host_cpu_busy_percent) AS max_observed_cpu_busy_percent, max(host_ram_used_mib) AS max_observed_ram_used_mib,
      max(host_swap_used_mib) AS max_observed_swap_used_mib,
      arg_min(host_ram_used_mib, monotonic_seconds) AS baseline_ram_used_mib, min(monotonic_seconds) AS baseline_seconds
      FROM samples GROUP BY trace, phase""",
    "trial_median": f"""SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS variant, value * 5 AS warmup_seconds,
      CAST(len({_TRIALS}) AS INTEGER) AS trials, CASE WHEN event_id % 2 = 0 THEN value * 2
      ELSE (list_sort({_TRIALS})[2] + list_sort({_TRIALS})[3]) / 2 END AS median_seconds FROM events""",
    "trial_checks": """SELECT CAST(event_id AS VARCHAR) AS run_id, event_type AS variant, 1 AS trial, event_id AS rows,
      CASE WHEN event_id % 10 = 0 THEN 'nan' ELSE CAST(event_id AS VARCHAR) END AS speed_sum FROM events
      UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, 2, event_id, NULL FROM events""",
    "variant_ratio": f"""WITH sums AS (SELECT user_id, event_type, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS DOUBLE) / 1e2 AS s
        FROM events GROUP BY user_id, event_type),
      wide AS (SELECT CAST(user_id AS VARCHAR) AS run_id, {_variant_columns()} FROM sums GROUP BY user_id)
      SELECT *, {_variant_ratios("view")} FROM wide""",
    "finite_texts": f"""SELECT event_id, isnan(average_speed_mph) AS nan, CAST(average_speed_mph AS VARCHAR) = 'nan' AS nan_text
      FROM ({_speed("'nan'::DOUBLE")})""",
    "runlog_months": _with(RUNS) + "SELECT month, rows, seconds FROM latest",
    "runlog_totals": _with(RUNS) + """SELECT count(*) AS months, round(sum(seconds), 2) AS total_seconds,
      round(sum(seconds) / 6e1, 3) AS total_minutes FROM latest""",
    "runlog_reconstruct": _with(RUNS) + """SELECT month, seconds AS runtime_seconds, rows,
      CASE WHEN month_of_year <= 6 THEN 'month, as logged at its end'
        ELSE 'run of the dataset that wrote the month' END AS timing_scope FROM latest""",
}
ORACLES |= {
    "ordered_listing": _names("name") + " SELECT row_number() OVER (ORDER BY name) AS place, name AS file_name FROM names",
    "report_in_order": f"SELECT row_number() OVER (ORDER BY month) AS place, month FROM ({MONTH_REPORT})",
    "delivered_month_bytes": """SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(1 AS BIGINT) AS files,
      CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM orders GROUP BY ALL""",
    "indexed_file_rows": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, (SELECT count(*) FROM {t}) AS rows, CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns"
        for t in TABLES),
    "subset_manifest": _with(TRIPS, f"there AS (SELECT count(*) AS n FROM trips WHERE source_month = '{EMPTIED}')")
    + f"""SELECT role, 1000 AS requested_rows, n AS source_file_rows, least(n, 1000) AS input_rows,
      '{SUBSET_SCHEMA}' AS subset_schema FROM there, (SELECT unnest(['source', 'subset']) AS role)""",
    "cached_stage": f"""SELECT count(*) AS rows, round(sum(average_speed_mph), 4) AS speed_sum, false AS before, true AS inside,
      false AS after FROM ({CLEANED})""",
    "export_seconds": f"SELECT count(*) AS rows, true AS measured FROM ({CLEANED})",
    "cleaning_counts": _with(TRIPS) + f""", counted AS (SELECT *, count(*) AS n,
        tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance IS NOT NULL
          AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AS whole, coalesce({_VALID}, false) AS valid FROM trips GROUP BY ALL)
      SELECT source_month, sum(n)::BIGINT AS rows_in, coalesce(sum(n) FILTER (NOT whole), 0)::BIGINT AS without_required,
        coalesce(sum(n - 1) FILTER (whole), 0)::BIGINT AS copies, count(*) FILTER (whole AND NOT valid) AS invalid,
        count(*) FILTER (whole AND valid) AS rows_out FROM counted GROUP BY source_month""",
    "metrics_indented": """SELECT event_type AS run_id, 'all' AS variant, min(value) AS warmup_seconds, 3 AS trials,
      max(value) AS median_seconds FROM events GROUP BY event_type""",
    "samples_jsonl": _with(SAMPLES) + "SELECT * EXCLUDE (trace) FROM samples",
    "runlog_equal_sizes": _with(RUNS) + """, halves AS (SELECT *, max(key) OVER (PARTITION BY month) AS last_key,
        CAST(month[1:4] AS BIGINT) AS y, CAST(month[1:4] AS BIGINT) * 2 + CASE WHEN month_of_year <= 9 THEN 0 ELSE 1 END AS size
        FROM runs WHERE month_of_year > 6),
      writes AS (SELECT size, seconds, key, row_number() OVER (PARTITION BY size ORDER BY key) AS turn, count(*) OVER (PARTITION BY size) AS writes
        FROM halves WHERE y % 2 = 0 OR key = last_key),
      months AS (SELECT month, size, row_number() OVER (PARTITION BY size ORDER BY month) AS turn, count(*) OVER (PARTITION BY size) AS months
        FROM (SELECT DISTINCT month, size FROM halves)),
      sizes AS (SELECT size, max(writes) AS writes, arg_max(seconds, key) AS latest FROM writes GROUP BY size)
      SELECT m.month, m.size AS rows, CASE WHEN months = 1 THEN latest WHEN months = s.writes THEN w.seconds END AS runtime_seconds,
        CASE WHEN months = 1 OR months = s.writes THEN 'run of the dataset that wrote the month'
          ELSE 'unknown: months and writes of this size cannot be matched' END AS timing_scope
      FROM months m JOIN sizes s USING (size) LEFT JOIN writes w ON w.size = m.size AND w.turn = m.turn AND months = s.writes""",
}
ORACLES["join_pickup_shuffled"] = ORACLES["join_pickup"]
ORACLES["report_csv"] = ORACLES["month_report_rows"]
ORACLES["subset_file"] = ORACLES["fixed_subset"]
ORACLES["mixed_types_scan"] = ORACLES["trip_files_scan"]
