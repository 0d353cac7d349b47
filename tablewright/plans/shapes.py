"""Output shapes shared by several registered queries, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_SQL = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority"
)


def order_rows(df: DataFrame, *more: str) -> DataFrame:
    """Orders with the date as text."""
    return df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority", *more,
    )


def joined_list(column: str, alias: str):
    """An array as comma-separated text."""
    return F.array_join(F.transform(F.col(column), lambda v: v.cast("string")), ",").alias(alias)


def pair_list(column: str, alias: str):
    """An array of (value, count) structs as ``value:count`` text."""
    return F.array_join(
        F.transform(F.col(column), lambda v: F.concat_ws(":", v["value"].cast("string"), v["count"].cast("string"))), ","
    ).alias(alias)
