"""Row changes as pure functions: each returns the rows of the next snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import persist_to_shared


def delete_where(table: DataFrame, condition: Column) -> DataFrame:
    """SQL DELETE: a row goes only if the condition is true, so null results keep it."""
    return table.where(~F.coalesce(condition, F.lit(False)))


def delete_keys(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Delete by a frame of ids; rows with a null key stay."""
    return table.join(keys.select(*on), on, "left_anti").select(*table.columns)


def update_where(table: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """SQL UPDATE; every column keeps its type."""
    types = dict(table.dtypes)
    return table.withColumns(
        {c: F.when(condition, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
    )


def _source_by_key(source: DataFrame, columns: list[str], on: list[str]) -> DataFrame:
    """One row per key with the new values packed in ``_new``; a repeated key fails the job.

    The exchange of this aggregate is the one the following join needs anyway.
    """
    packed = source.groupBy(*on).agg(
        F.any_value(F.struct(*columns)).alias("_new"), F.count(F.lit(1)).alias("_n")
    )
    clash = F.raise_error(F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*on))))
    return packed.select(*on, F.when(F.col("_n") == 1, F.col("_new")).otherwise(clash).alias("_new"))


def upsert(table: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """MERGE … UPDATE SET * / INSERT *: source values win as they are, nulls included."""
    columns = table.columns
    keyed = None
    for c in on:
        keyed = F.col(c).isNotNull() if keyed is None else keyed & F.col(c).isNotNull()
    source = source.select(*[F.col(c).cast(t) for c, t in table.dtypes])
    new = persist_to_shared(_source_by_key(source.where(keyed), columns, on), "keyed")  # used three times below
    updated = table.join(new, on, "left").select(
        *[
            F.col(c) if c in on else F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    inserted = new.join(_known(table, new, on), on, "left_anti").select(*[F.col(f"_new.{c}").alias(c) for c in columns])
    loose = source.where(~keyed)  # a null key matches nothing: plain insert
    return updated.unionByName(inserted).unionByName(loose)


def _known(table: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Keys of ``source`` that the table has.

    With a small source both this and the update are broadcast joins: the big table is scanned but
    never shuffled, and a key that fills much of the table does no harm.
    """
    return table.select(*on).join(source.select(*on), on, "left_semi").distinct()


def insert_new(table: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """MERGE … WHEN NOT MATCHED INSERT: existing keys are left alone."""
    source = source.select(*[F.col(c).cast(t) for c, t in table.dtypes])
    return table.unionByName(source.join(_known(table, source, on), on, "left_anti").select(*table.columns))


def insert_rows(table: DataFrame, source: DataFrame) -> DataFrame:
    """One append for any number of rows."""
    return table.unionByName(source.select(*[F.col(c).cast(t) for c, t in table.dtypes]))


class SchemaDrift(ValueError):
    """An append would change the table's columns."""


def append_strict(table: DataFrame, source: DataFrame) -> DataFrame:
    """Append that refuses unknown, missing or retyped columns."""
    have, come = dict(table.dtypes), dict(source.dtypes)
    if have != come:
        extra = sorted(set(come) - set(have))
        missing = sorted(set(have) - set(come))
        retyped = sorted(c for c in set(have) & set(come) if have[c] != come[c])
        raise SchemaDrift(f"columns added {extra}, missing {missing}, retyped {retyped}")
    return table.unionByName(source)


def append_evolving(table: DataFrame, source: DataFrame) -> DataFrame:
    """Append that widens the table; cells absent on one side are null."""
    return table.unionByName(source, allowMissingColumns=True)
