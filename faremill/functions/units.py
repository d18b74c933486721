"""Small arithmetic on sizes, memory counters and pairs of runs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_MIB = 1024.0**2
BYTES_PER_GIB = 1024.0**3
KIB_PER_MIB = 1024.0


def mib(size: Column) -> Column:
    return size / F.lit(BYTES_PER_MIB)


def gib(size: Column) -> Column:
    return size / F.lit(BYTES_PER_GIB)


def kib_to_mib(size: Column) -> Column:
    return size / F.lit(KIB_PER_MIB)


def used_mib(total_kib: Column, free_kib: Column) -> Column:
    """Used memory: total less what is still available, KiB in, MiB out."""
    return kib_to_mib(total_kib - free_kib)


def percent_over(value: Column, base: Column) -> Column:
    """By how many percent of the base a value exceeds it; null on a zero base."""
    return F.try_divide(F.lit(100.0) * (value - base), base)


def ratio(value: Column, base: Column) -> Column:
    return F.try_divide(value, base)


def finite_text(value: Column) -> Column:
    """A double as text; nan, inf and -inf where it is not finite; null stays null."""
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .otherwise(value.cast("string"))
    )
