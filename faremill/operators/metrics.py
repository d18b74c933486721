"""Resource samples and run metrics."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.units import percent_over, ratio
from faremill.operators.ordered import carry_forward

# The first eight CPU counters in order; guest time is already in user time.
CPU_COUNTERS = ["user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal"]
IDLE_COUNTERS = ["idle", "iowait"]

def busy_percent(samples: DataFrame, keys: list[str], at: str = "monotonic_seconds") -> DataFrame:
    """Add the CPU busy percent between successive samples of a trace.

    Null for the first sample and where the counters did not advance.
    """
    total = reduce(add, [F.col(c).cast("long") for c in CPU_COUNTERS])
    idle = reduce(add, [F.col(c).cast("long") for c in IDLE_COUNTERS])
    counted = samples.withColumn("_now", F.struct(total.alias("total"), idle.alias("idle")))
    paired = carry_forward(counted, keys, at, "_now", "_past")
    d_total = F.col("_now.total") - F.col("_past.total")
    d_idle = F.col("_now.idle") - F.col("_past.idle")
    busy = F.when(d_total > 0, F.lit(100.0) * (d_total - d_idle) / d_total)
    return paired.select(*samples.columns, busy.alias("host_cpu_busy_percent"))


def phase_maxima(samples: DataFrame, keys: list[str], at: str = "monotonic_seconds") -> DataFrame:
    """Samples, sampled maxima and the first sample of each trace; nulls are skipped."""
    first = F.struct("host_ram_total_mib", "host_ram_used_mib", "host_swap_used_mib", "host_cpu_busy_percent", at)
    return samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.max("host_cpu_busy_percent").alias("max_observed_cpu_busy_percent"),
        F.max("host_ram_used_mib").alias("max_observed_ram_used_mib"),
        F.max("host_swap_used_mib").alias("max_observed_swap_used_mib"),
        F.min_by(first, at).alias("baseline"),
    )


def array_median(values: Column) -> Column:
    """Median of an array of doubles; the mean of the middle two for an even number of values."""
    ordered, n = F.sort_array(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n % 2 == 1, low).otherwise((low + high) / 2)


def trial_medians(metrics: DataFrame) -> DataFrame:
    """Median of the timed trials of every run, the warm-up left out.

    The trials of a run are an array in its document, so nothing is shuffled.
    """
    timed = F.col("feature_stage.timed_runs_seconds")
    return metrics.select(
        "run_id", "variant",
        F.col("feature_stage.warmup_seconds_not_in_median").alias("warmup_seconds"),
        F.size(timed).alias("trials"), array_median(timed).alias("median_seconds"),
    )


def variant_ratios(metrics: DataFrame, variants: list[str], base: str, value: Column | None = None) -> DataFrame:
    """The variants of each run side by side; difference, percent and ratio of each to the base."""
    value = F.col("pipeline_seconds") if value is None else value
    wide = metrics.groupBy("run_id").agg(*[
        F.max(F.when(F.col("variant") == name, value)).alias(f"{name}_seconds") for name in variants
    ])
    against = F.col(f"{base}_seconds")
    more = {}
    for name in variants:
        if name != base:
            own = F.col(f"{name}_seconds")
            more[f"{name}_minus_{base}"] = own - against
            more[f"{name}_percent_over_{base}"] = percent_over(own, against)
            more[f"{name}_to_{base}"] = ratio(own, against)
    return wide.withColumns(more)


def execution_checks(metrics: DataFrame) -> DataFrame:
    """Rows and speed sum of every timed trial."""
    return metrics.select(
        "run_id", "variant", F.posexplode("feature_stage.execution_checks").alias("trial", "check")
    ).select("run_id", "variant", (F.col("trial") + 1).alias("trial"), "check.rows", "check.speed_sum")
