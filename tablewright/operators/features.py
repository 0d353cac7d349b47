"""Feature scaling, class weights and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Scaler:
    """Standard scores with the population deviation. ``fit`` reads one row of statistics, ``apply`` is map-only."""

    def __init__(self, stats: dict[str, tuple[float, float]]):
        self.stats = stats

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Scaler:
        aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*aggs).first()
        return cls({c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns})

    def apply(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        return df.withColumns({c + suffix: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()})


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    per_class = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()  # rows / classes, one value
    return counts.select(label, "n", (per_class / F.col("n")).alias("weight"))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy, precision and recall of class 1 in one pass."""
    y, p = F.col(label), F.col(pred)
    c = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("hit"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    return c.select(
        "n", _ratio(F.col("hit"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )


def per_class_f1(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per class: tp, fp, fn, support and F1, from the confusion counts."""
    cells = confusion(df, label, pred)
    right = F.col(label) == F.col(pred)
    roles = cells.select(
        F.inline(
            F.array(
                F.struct(F.col(label).alias("class"), F.when(right, F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.when(right, 0).otherwise(F.col("n")).alias("fn"), F.col("n").alias("support")),
                F.struct(F.col(pred).alias("class"), F.lit(0).cast("bigint").alias("tp"), F.when(right, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("bigint").alias("fn"), F.lit(0).cast("bigint").alias("support")),
            )
        )
    )
    sums = roles.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")])
    return sums.withColumn("f1", _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def f1_scores(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Micro and support-weighted F1."""
    return per_class_f1(df, label, pred).agg(
        (2 * F.sum("tp") / (2 * F.sum("tp") + F.sum("fp") + F.sum("fn"))).alias("f1_micro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def iou_scores(df: DataFrame, key: str, label: str = "label", pred: str = "pred") -> DataFrame:
    """Intersection over union of class 1: mean of the per-key scores, and the pooled score.

    A key without any positive scores 1.
    """
    y, p = F.col(label) == 1, F.col(pred) == 1
    per_key = df.groupBy(key).agg(F.count_if(y & p).alias("tp"), F.count_if(y | p).alias("all"))
    one = F.when(F.col("all") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("all"))
    return per_key.agg(F.avg(one).alias("iou_per_key"), (F.sum("tp") / F.sum("all")).alias("iou_pooled"))
