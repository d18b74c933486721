"""Python over Arrow batches, where a step has no native form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType) -> DataFrame:
    """Apply a function to batches of rows.

    A batch is some rows of one partition, not a month: a function that needs all rows of a
    month, such as dropping copies, belongs in `drop_copies`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
