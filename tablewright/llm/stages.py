"""The operators as steps of a pipeline: each takes documents and gives documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, mixing, near_copies, secrets, toxicity
from tablewright.llm.shared import replaced, whole


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(docs, _table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; their secrets go. A text without findings is not touched, null included."""
    found, _ = secrets.scan_secrets(docs)
    clean = F.when(F.size("spans") > 0, secrets.redact(whole("text"), F.col("spans"))).otherwise(F.col("text"))
    length = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("text", clean).withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy taken; ``copy`` counts them from 1."""
    return mixing.mix(docs).select(*replaced(docs, ["copy"]).columns, "copy")
