"""Dimension reduction and a classifier on top of Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pca(df: DataFrame, vector: str, k: int) -> tuple[DataFrame, list[float]]:
    """Rows with ``components`` (k numbers) and the explained variance of each component."""
    rows = df.withColumn("_raw", array_to_vector(F.col(vector).cast("array<double>")))
    stages = [
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=k, inputCol="_std", outputCol="_pca"),
    ]
    model = Pipeline(stages=stages).fit(rows)
    out = model.transform(rows).withColumn("components", vector_to_array("_pca")).drop("_raw", "_std", "_pca")
    return out, [float(v) for v in model.stages[-1].explainedVariance]


def train_forest(train: DataFrame, label: str, numbers: list[str], texts: list[str], seed: int = 42, trees: int = 20) -> PipelineModel:
    """A random forest over numeric columns and indexed text columns.

    A text column is a category: its distinct values are the model's vocabulary, and the forest gets as many
    bins as the widest column needs (one more for values not seen in training).
    """
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep").fit(train) for c in texts]
    bins = max([32, *[len(ix.labelsArray[0]) + 1 for ix in indexers]])
    stages = [
        *indexers,
        VectorAssembler(inputCols=numbers + [f"{c}_ix" for c in texts], outputCol="features"),
        RandomForestClassifier(labelCol=label, featuresCol="features", predictionCol="pred", numTrees=trees, seed=seed, maxBins=bins),
    ]
    return Pipeline(stages=stages).fit(train)
