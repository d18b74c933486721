"""Values carried along a trace of rows in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.session import PARTITIONS_KEY, scratch_path

_SHARE, _AT, _PREFIX = "_share", "_place", "_first_value"


def carry_forward(df: DataFrame, keys: list[str], at: str | Column, value: str, into: str,
                  order: list[Column] | None = None, shares: int | None = None) -> DataFrame:
    """Add the last value that is not null among the rows before each row of its trace.

    A prefix scan. All rows are sorted by trace and time and cut into shares of equal size by
    one range partitioning, wherever a trace or an instant begins and ends: a trace that holds
    most rows lies on many shares, and small traces share one. Inside a share the value comes
    from a window; what a share hands on to the next one is its last row with a value, and of
    these there is one per share and trace that crosses a border. Rows of one trace and
    instant come in the order of `order`; equal ones, in that of a hash of the row.

    There are as many shares as the session shuffles into, which `session.sized` sets by the
    input, unless `shares` says otherwise. They are written once, since a range partitioning
    that is planned twice may cut twice; the carry is then read from what was written.
    """
    spark = df.sparkSession
    at = F.col(at) if isinstance(at, str) else at
    order = order or [at]
    # A total order, so that no run of equal instants has to stay together.
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*df.columns).alias("h"))
    shares = shares or int(spark.conf.get(PARTITIONS_KEY, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn(_AT, place)
    cut = placed.repartitionByRange(shares, *keys, _AT).withColumn(_SHARE, F.spark_partition_id())
    path = scratch_path(spark, "shares")
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)

    inside = Window.partitionBy(_SHARE, *keys).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    # One row per share and trace: its last value. Only traces that reach over a border have more
    # than one, and then one per share.
    ends = cut.groupBy(*keys, _SHARE).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(_AT))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(_SHARE).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn(_PREFIX, F.last("_last", ignorenulls=True).over(earlier)).filter(F.col(_PREFIX).isNotNull())
    return (
        cut.withColumn("_inside", F.last(value, ignorenulls=True).over(inside)).alias("r")
        .join(starts.drop("_last").alias("b"), _same([*keys, _SHARE], "r", "b"), "left")
        .select(*[f"r.{c}" for c in df.columns], F.coalesce("r._inside", f"b.{_PREFIX}").alias(into))
    )


def _same(columns: list[str], left: str, right: str) -> Column:
    # Null keys are keys as well.
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])
