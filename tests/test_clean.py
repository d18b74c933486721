import datetime as dt
import math

import pytest

from faremill.operators.clean import add_speed, add_time_features, clean_trips, drop_copies, drop_missing, keep_valid
from faremill.schemas import MONTH, REQUIRED_COLUMNS, TRIP_COLUMNS
from helpers import START, month_trips, plan_of, trip, trips


def second(n, micros=0):
    return START + dt.timedelta(seconds=n, microseconds=micros)


def test_missing_required_values_go_and_others_stay(spark):
    holes = [tuple(None if c == gone else v for c, v in zip(TRIP_COLUMNS, trip())) for gone in TRIP_COLUMNS]
    kept = drop_missing(trips(spark, *holes, trip(distance=math.nan), trip())).collect()
    assert len(kept) == 1 + len(TRIP_COLUMNS) - len(REQUIRED_COLUMNS)
    assert all(row[c] is not None for row in kept for c in REQUIRED_COLUMNS)


def test_copies_count_nulls_as_equal(spark):
    df = trips(spark, trip(), trip(), trip(passengers=None), trip(passengers=None), trip(vendor=2))
    assert drop_copies(df).count() == 3


def test_signed_zeros_are_one_fare(spark):
    df = drop_copies(trips(spark, trip(fare=-0.0), trip(fare=0.0)))
    assert [str(row.fare_amount) for row in df.collect()] == ["0.0"]


def test_copies_across_months(spark):
    df = month_trips(spark, ("2024-05", trip()), ("2024-06", trip()), ("2024-06", trip()))
    assert drop_copies(df).count() == 1
    assert sorted(row[MONTH] for row in drop_copies(df, MONTH).collect()) == ["2024-05", "2024-06"]
    with pytest.raises(ValueError):
        drop_copies(df, "year")


@pytest.mark.parametrize("row, kept", [
    (trip(distance=0.0), False), (trip(distance=-1.0), False), (trip(distance=1e-9), True),
    (trip(end=START), False), (trip(end=second(-1)), False), (trip(end=second(0, 800_000)), True),
])
def test_valid_trips(spark, row, kept):
    assert keep_valid(trips(spark, row)).count() == int(kept)


def test_cleaning_twice_is_cleaning_once_in_any_order(spark):
    rows = [trip(), trip(), trip(distance=0.0), trip(pickup=None), trip(vendor=3), trip(end=START)]
    once = clean_trips(trips(spark, *rows))
    expected = sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, clean_trips(once).collect())) == expected
    assert sorted(map(tuple, clean_trips(trips(spark, *reversed(rows))).collect())) == expected


def test_global_rows_are_among_the_rows_by_month(spark):
    df = month_trips(spark, ("2024-05", trip()), ("2024-06", trip()), ("2024-06", trip(vendor=2)))
    whole = set(map(tuple, clean_trips(df).collect()))
    by_month = {tuple(row)[:-1] for row in clean_trips(df, MONTH).collect()}
    assert whole == by_month


@pytest.mark.parametrize("end, by_second, by_fraction", [
    (second(0, 800_000), 0.0, 0.8 / 3600),
    (second(1800), 0.5, 0.5),
])
def test_durations(spark, end, by_second, by_fraction):
    df = trips(spark, trip(end=end))
    assert add_time_features(df).first().trip_duration_hours == by_second
    assert add_time_features(df, "fraction").first().trip_duration_hours == by_fraction


def test_durations_across_midnight_and_text_without_fraction(spark):
    df = trips(spark, trip(start=dt.datetime(2024, 5, 1, 23, 59, 59, 900_000), end=dt.datetime(2024, 5, 2, 0, 0, 0, 100_000)))
    row = add_time_features(df).first()
    assert row.trip_duration_hours == 1 / 3600
    assert (row.pickup_timestamp, row.dropoff_timestamp) == ("2024-05-01 23:59:59", "2024-05-02 00:00:00")
    assert add_time_features(df, "fraction").first().trip_duration_hours == 0.2 / 3600


def test_wall_clock_on_a_day_the_zone_changes(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    df = trips(spark, trip(start=dt.datetime(2023, 3, 12, 1, 30), end=dt.datetime(2023, 3, 12, 2, 30)))
    for unit in ("second", "fraction"):
        row = add_time_features(df, unit).first()
        assert row.dropoff_timestamp == "2023-03-12 02:30:00"
        assert row.trip_duration_hours == 1.0
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"


def test_speed_forms_agree(spark):
    df = add_time_features(trips(
        spark, trip(), trip(distance=1.1, end=second(7)), trip(end=second(0, 800_000)), trip(distance=0.1, end=second(3))))
    forms = {how: [row.average_speed_mph for row in add_speed(df, how).orderBy("trip_distance").collect()]
             for how in ("native", "try_divide", "udf", "pandas")}
    assert forms["native"].count(None) == 1 and 12.0 in forms["native"]
    assert all(speeds == forms["native"] for speeds in forms.values())
    for how in forms:
        nan = [row.average_speed_mph for row in add_speed(df, how, "nan").orderBy("trip_distance").collect()]
        assert [math.isnan(x) for x in nan] == [x is None for x in forms[how]], how
    with pytest.raises(ValueError):
        add_speed(df, "udf", "zero")


def test_speed_of_missing_values(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, -1.0)], "trip_distance double, trip_duration_hours double")
    for how in ("native", "udf", "pandas"):
        speeds = [row.average_speed_mph for row in add_speed(df, how).collect()]
        assert speeds == [None, None, None], how
    assert all(math.isnan(row.average_speed_mph) for row in add_speed(df, "native", "nan").collect())


def test_a_trip_repeated_without_end_is_merged_before_the_shuffle(spark):
    hot = trips(spark, trip()).crossJoin(spark.range(0, 40_000, 1, 8)).drop("id")
    df = hot.unionAll(trips(spark, trip(vendor=2)))
    assert drop_copies(df).count() == 2
    plan = plan_of(drop_copies(df), "simple")
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
