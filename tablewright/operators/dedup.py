"""Three meanings of "duplicate". None uses a window, so one hot key never lands in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.skew import HOT_ROWS, join_per_key


def _repeated(df: DataFrame, key: str, *aggs: Column) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *aggs).where(F.col("_n") > 1)
    )


def later_duplicates(df: DataFrame, key: Column, order: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Rows that repeat a key seen at a smaller ``order``; null keys never repeat. Adds ``first_<order>``."""
    keyed = df.withColumn("_key", key)
    firsts = _repeated(keyed, "_key", F.min(order).alias(f"first_{order}"))
    return (
        join_per_key(keyed, firsts, ["_key"], "_n", order, "inner", hot_rows)
        .where(F.col(order) > F.col(f"first_{order}"))
        .drop("_key")
    )


def keep_first(df: DataFrame, key: Column, order: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows with ``survivor``: the smallest ``order`` among rows of equal key (itself if unique)."""
    keyed = df.withColumn("_key", key)
    firsts = _repeated(keyed, "_key", F.min(order).alias("_first"))
    return (
        join_per_key(keyed, firsts, ["_key"], "_n", order, "left", hot_rows)
        .withColumn("survivor", F.coalesce("_first", order))
        .drop("_key", "_first")
    )


def shared_keys(df: DataFrame, key: Column, row_id: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows with ``n_same``: how many rows share the key; 1 where the key is unique or null."""
    keyed = df.withColumn("_key", key)
    counts = _repeated(keyed, "_key").withColumn("n_same", F.col("_n"))
    return (
        join_per_key(keyed, counts, ["_key"], "_n", row_id, "left", hot_rows)
        .withColumn("n_same", F.coalesce("n_same", F.lit(1).cast("bigint")))
        .drop("_key")
    )
