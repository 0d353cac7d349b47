"""Nearest vectors to query vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import squared_distance
from tablewright.operators.metric_index import MetricIndex


def nearest(vectors: DataFrame, query: list[float], k: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors to one query, exact: built-in distance, then a distributed top-k."""
    target = F.array(*[F.lit(float(v)) for v in query])
    return (
        vectors.select(key, F.sqrt(squared_distance(F.col(vector), target)).alias("distance"))
        .orderBy("distance", key).limit(k)
    )


def nearest_many(
    vectors: DataFrame, queries: DataFrame, k: int = 4, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest vectors to each of any number of queries (query_id, vector), exact.

    Builds an index for this one call; ``MetricIndex`` keeps one for many.
    """
    return MetricIndex.build(vectors, key, vector).search(queries, k)
