"""Profiling, cleaning and reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tablewright.functions.numbers import real, to_number
from tablewright.functions.text import present, quoted


def null_counts(df: DataFrame) -> DataFrame:
    """Null-or-NaN count of every column in one pass: rows (column, n_missing, n_rows)."""

    def missing(field) -> Column:
        c = F.col(f"`{field.name}`")
        return c.isNull() | F.isnan(c) if isinstance(field.dataType, DoubleType | FloatType) else c.isNull()

    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(missing(f)).alias(f"m{i}") for i, f in enumerate(df.schema.fields)]
    )
    cells = [
        F.struct(F.lit(f.name).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, f in enumerate(df.schema.fields)
    ]
    return one.select("n_rows", F.inline(F.array(*cells))).select("column", "n_missing", "n_rows")


def align_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Select, by name and ignoring case, the target's columns with the target's types; absent ones are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in target.fields
        ]
    )


def align_report(df: DataFrame, target: StructType) -> dict[str, list[str]]:
    """What ``align_schema`` has to drop or fill."""
    have, want = {c.lower() for c in df.columns}, {f.name.lower() for f in target.fields}
    return {"missing": sorted(want - have), "extra": sorted(have - want)}


def row_totals(df: DataFrame, columns: list[str], total: str = "total", average: str = "average") -> DataFrame:
    """Sum and mean across columns; the divisor is the number of columns."""
    whole = F.col(columns[0])
    for c in columns[1:]:
        whole = whole + F.col(c)
    return df.withColumns({total: whole, average: whole / F.lit(len(columns))})


def bucketize(c: Column, buckets: list[tuple[float, float, str]]) -> Column:
    """Label of the closed range the value falls in; null outside all ranges."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(buckets):
        out = F.when(c.between(low, high), label).otherwise(out)
    return out


def threshold(c: Column, at: float) -> Column:
    return F.when(c > F.lit(at), 1).otherwise(0)


def _valid_order(status: str, currency: str) -> Column:
    return F.expr(
        f"""coalesce({present('order_id')} AND {present('customer_id')} AND status = {quoted(status)}
        AND currency = {quoted(currency)} AND {real(to_number('amount'))} > 0, false)"""
    )


def clean_orders(df: DataFrame, status: str = "PAID", currency: str = "USD") -> DataFrame:
    """Rows with both ids, the wanted status and currency, and a positive numeric amount."""
    return df.where(_valid_order(status, currency)).withColumn("amount", F.expr(to_number("amount")))


def quality_report(df: DataFrame, status: str = "PAID", currency: str = "USD") -> DataFrame:
    """What ``clean_orders`` keeps and drops, counted in one pass."""
    kept = F.count_if(_valid_order(status, currency))
    total = F.count(F.lit(1))
    return df.agg(total.alias("rows_in"), kept.alias("rows_out"), (total - kept).alias("rows_dropped")).withColumn(
        "filters", F.lit(f"status=={status},currency=={currency},amount>0,non_empty_ids")
    )


def stable_order(key: str, seed: str = "") -> Column:
    """A pseudo-random but repeatable order over a key."""
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def split_label(key: str, train: float = 0.8, seed: str = "") -> Column:
    """train/test by hash: the same row lands on the same side on any cluster.

    The first eight hex digits of the hash, as a fraction of their range, are compared to ``train``.
    """
    share = F.conv(F.substring(stable_order(key, seed), 1, 8), 16, 10).cast("bigint") / F.lit(float(16**8))
    return F.when(share < train, "train").otherwise("test")
