import random

from pyspark.sql import functions as F

from faremill.operators.metrics import CPU_COUNTERS, busy_percent
from faremill.operators.ordered import carry_forward
from helpers import plan_of


def carried(rows):
    """The last value before each row of its trace, by a loop; rows are (key, at, value, id)."""
    last, out = {}, {}
    for key, at, value, number in sorted(rows, key=lambda r: r[1]):
        out[number] = last.get(key)
        if value is not None:
            last[key] = value
    return out


def some_rows(count, traces, seed, hot=0.6):
    pick = random.Random(seed)
    rows = []
    for number in range(count):
        key = "hot" if pick.random() < hot else pick.choice(traces)
        rows.append((key, float(number), pick.choice([None, None, number]), number))
    pick.shuffle(rows)
    return rows


def test_carry_against_a_loop(spark):
    rows = some_rows(3000, ["a", "b", None, ""], 1)
    df = spark.createDataFrame(rows, "key string, at double, value long, id long")
    for shares in (1, 7, 40):
        got = {r.id: r.before for r in carry_forward(df, ["key"], "at", "value", "before", shares=shares).collect()}
        assert got == carried(rows)


def test_a_value_crosses_shares_without_one(spark):
    # One value, then only nulls: every later share takes it from the first.
    df = spark.range(2000).select(F.lit("t").alias("key"), F.col("id").cast("double").alias("at"),
                                  F.when(F.col("id") == 3, F.lit(9)).alias("value"))
    got = carry_forward(df, ["key"], "at", "value", "before", shares=16).groupBy("before").count().collect()
    assert {r.before: r["count"] for r in got} == {None: 4, 9: 1996}


def test_one_hour_of_one_trace_is_spread(spark):
    # All samples of a trace within one hour: no share may hold much more than its part.
    columns = [(F.col("id") * (i + 1)).alias(c) for i, c in enumerate(CPU_COUNTERS)]
    samples = spark.range(40_000).select(F.lit("t").alias("trace"), (F.col("id") * 0.09).alias("monotonic_seconds"), *columns)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        busy = busy_percent(samples, ["trace"])
        plan = plan_of(busy)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    path = plan.split("/shares-")[1].split("]")[0].split(",")[0].split(" ")[0]
    written = next(p for p in busy.inputFiles() if f"/shares-{path[:8]}" in p).rsplit("/", 1)[0]
    sizes = [r["count"] for r in spark.read.parquet(written).groupBy("_share").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16
    assert busy.filter("host_cpu_busy_percent is null").count() == 1
    assert busy.select(F.countDistinct("host_cpu_busy_percent")).first()[0] == 1


def test_rows_of_one_instant_have_an_order(spark):
    rows = [("s", 5.0, None, 1), ("s", 5.0, 7, 0), ("s", 4.0, 1, 2)]
    df = spark.createDataFrame(rows, "key string, at double, value long, id long")
    order = [F.col("at"), F.col("value").isNull()]
    got = {r.id: r.before for r in carry_forward(df, ["key"], "at", "value", "before", order, shares=3).collect()}
    assert got == {2: None, 0: 1, 1: 7}


def test_no_rows(spark):
    df = spark.createDataFrame([], "key string, at double, value long")
    assert carry_forward(df, ["key"], "at", "value", "before").collect() == []
