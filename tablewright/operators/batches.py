"""Vectorised Python where built-ins cannot express the work. Spark splits the rows; Python sees batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_udf(fn: Callable, returns: str) -> Callable[..., Column]:
    """A Pandas UDF from a plain function; input the function rejects becomes null instead of failing the job."""

    def attempt(value):
        try:
            return fn(value)
        except Exception:  # bad input is expected here and shows up as null
            return None

    @F.pandas_udf(returns)
    def apply(values: pd.Series) -> pd.Series:
        return values.map(attempt)

    return apply


def enrich(df: DataFrame, column: str, fn: Callable, returns: str) -> DataFrame:
    """Replace a column by ``fn`` of it and drop the rows ``fn`` rejects.

    The null test must not evaluate the UDF a second time, so the result is computed first.
    """
    return df.withColumn(column, safe_udf(fn, returns)(F.col(column))).where(F.col(column).isNotNull())


def normalise_vectors(df: DataFrame, key: str, vector: str, mean: float, deviation: float) -> DataFrame:
    """Batch-wise standardisation of an array column: ``(x - mean) / deviation`` per element."""

    def transform(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = (np.stack(batch[vector].to_numpy()).astype("float64") - mean) / deviation
                yield pd.DataFrame({key: batch[key], vector: list(x)})

    return df.select(key, vector).mapInPandas(transform, f"{key} long, {vector} array<double>")
