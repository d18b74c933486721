import pytest
from pyspark.sql import functions as F

from faremill.operators.zones import duplicate_keys, fits_broadcast, join_zone, join_zones, unmatched_zones, zone_side
from faremill.sources.zones import read_zones
from helpers import trip, trips, zones

CSV = '''LocationID,Borough,Zone,service_zone
1,EWR,Newark,EWR
2,,N/A,null
3,Queens,NaN,""
4,Bronx,"Pelham, Bay",Boro Zone
'''


@pytest.fixture()
def lookup(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(CSV)
    return read_zones(spark, str(path))


def test_only_an_empty_field_is_null(lookup):
    assert [tuple(r) for r in lookup.orderBy("LocationID").collect()] == [
        (1, "EWR", "Newark", "EWR"), (2, None, "N/A", "null"), (3, "Queens", "NaN", ""),
        (4, "Bronx", "Pelham, Bay", "Boro Zone")]


def test_defaults(lookup):
    side = {r.PULocationID: tuple(r)[1:] for r in zone_side(lookup, "PULocationID", "pickup").collect()}
    assert side[2] == ("Unknown", "N/A", "null") and side[3] == ("Queens", "NaN", "Unknown")


def test_unmatched_zone_is_null_not_unknown(spark, lookup):
    row = join_zones(trips(spark, trip(pickup=2, dropoff=99)), lookup).first()
    assert (row.pickup_borough, row.pickup_zone) == ("Unknown", "N/A")
    assert (row.dropoff_borough, row.dropoff_zone, row.dropoff_service_zone) == (None, None, None)


def test_another_header_is_refused(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(CSV.replace("Borough,Zone", "Zone,Borough"))
    with pytest.raises(Exception, match="(?i)header|malformed"):
        read_zones(spark, str(path)).collect()


def test_shuffled_join_is_the_broadcast_join(spark, lookup):
    # A third of the trips and more share one id; some ids are unknown or null.
    rows = [trip(vendor=i, pickup=1 if i % 3 else i % 7) for i in range(300)] + [trip(pickup=None)] * 3
    df = trips(spark, *rows)
    small, large = (join_zone(df, lookup, "PULocationID", "pickup", small=s) for s in (True, False))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(small.columns).collect()))
    assert small.count() == 303


def test_salts_spread_a_hot_id(spark, lookup):
    df = trips(spark, *[trip(vendor=i, pickup=1) for i in range(640)])
    salts = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(32)).alias("salt")).groupBy("salt").count().collect()
    assert len(salts) == 32 and max(r["count"] for r in salts) < 60


def test_size_is_checked_before_a_broadcast(spark, lookup):
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, rows=3)
    assert not fits_broadcast(lookup, size=40)
    wide = zones(spark, (1, "x" * 1000, "y", "z"))
    assert not fits_broadcast(wide, size=1000)


def test_key_check(spark, lookup):
    assert duplicate_keys(lookup).count() == 0
    doubled = lookup.unionAll(lookup.filter("LocationID = 4"))
    assert [tuple(r) for r in duplicate_keys(doubled).collect()] == [(4, 2)]
    assert join_zone(trips(spark, trip(pickup=4)), doubled, "PULocationID", "pickup").count() == 2


def test_unmatched_ids_are_counted(spark, lookup):
    df = trips(spark, trip(pickup=1), trip(pickup=50), trip(pickup=50), trip(pickup=None))
    assert sorted(map(str, unmatched_zones(df, lookup).collect())) == sorted(
        ["Row(PULocationID=50, trips=2)", "Row(PULocationID=None, trips=1)"])
