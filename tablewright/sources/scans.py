"""Readers with the options this library settles on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """With a schema: one pass, nothing inferred. Without: types are inferred from all rows."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def csv_positional(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV as text columns _c0, _c1, …"""
    return spark.read.csv(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON document (or array of records) per file; a file is the unit of parallelism."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def columns(df: DataFrame, name: str) -> DataFrame:
    """The schema as rows: table, position, column, type. Reads file footers, no data."""
    rows = [(name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "table string, position int, column string, type string")


def describe(df: DataFrame, name: str) -> DataFrame:
    """Table inspection as rows: table, position, column, type, and how many cells hold a value."""
    fields = df.schema.fields
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("n_values"))
        for i, f in enumerate(fields)
    ]
    return one.select(F.lit(name).alias("table"), "n_rows", F.inline(F.array(*cells)))
