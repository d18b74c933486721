import os

from faremill import session
from faremill.session import SPLIT_KEY, scratch_path, sized, utc


def test_scratch_goes_to_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert one != two
    if base:
        assert one.startswith(base)


def test_scratch_of_a_local_session_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_KEY", "spark.faremill.unset")
    one, two = scratch_path(spark, "a"), scratch_path(spark, "b")
    assert os.path.dirname(one) == os.path.dirname(two)
    spark.range(3).write.parquet(one)
    assert spark.read.parquet(one).count() == 3


def test_shuffles_may_be_wider_than_files(spark):
    with sized(spark, 100, shuffle_bytes=10 << 30) as partitions:
        assert partitions == 80 and spark.conf.get(SPLIT_KEY) == str(128 << 20)


def test_the_zone_is_given_back(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    try:
        with utc(spark):
            assert spark.conf.get(key) == "UTC"
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(key) == before
