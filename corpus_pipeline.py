"""Documents to a training mix in five stages; each works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import stages
from tablewright.session import apply_settings, persist_to_shared

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("near_copies", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("secrets", stages.redact_secrets),
    ("mix", stages.mix_sources),
]

# The first stage is a trained model, so there is no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = persist_to_shared(stage(spark, docs, sf_dir), name)
    return docs
