"""Average speed: the native forms and the Python ones kept for comparison."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def speed_or_null(distance: Column, hours: Column) -> Column:
    """Miles per hour; null where the hours are null or not positive."""
    return F.when(hours > 0, distance / hours)


def speed_try_divide(distance: Column, hours: Column) -> Column:
    """Unguarded quotient; null on zero hours instead of an error."""
    return F.try_divide(distance, hours)


@F.udf(T.DoubleType(), useArrow=True)
def speed_row_udf(distance, hours):
    """One Python call per row, the rows in Arrow batches. Leaves generated code; only for comparison."""
    if distance is not None and hours is not None and hours > 0:
        return distance / hours
    return None


@F.pandas_udf(T.DoubleType())
def speed_batch_udf(distance: pd.Series, hours: pd.Series) -> pd.Series:
    """One Python call per Arrow batch. A missing value comes back as null."""
    return distance / hours.where(hours > 0, np.nan)


def _or_nan(speed):
    """The same speed, NaN where it has no value."""
    return lambda distance, hours: F.coalesce(speed(distance, hours), F.lit(float("nan")))


_FORMS = {"native": speed_or_null, "try_divide": speed_try_divide, "udf": speed_row_udf, "pandas": speed_batch_udf}
SPEEDS = {(how, "null"): speed for how, speed in _FORMS.items()}
SPEEDS |= {(how, "nan"): _or_nan(speed) for how, speed in _FORMS.items()}
