"""Connected components by contraction: every round each node joins its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import persist_to_shared


def _roots(parent: DataFrame) -> DataFrame:
    """Follow ``(node, up)`` to the top by pointer doubling; parents are smaller, so there are no cycles."""
    while True:
        above = parent.select(F.col("node").alias("__n"), F.col("up").alias("__up"))
        jumped = parent.join(above, F.col("up") == F.col("__n"), "left").select(
            "node", F.coalesce("__up", "up").alias("next"), (F.col("__up") < F.col("up")).alias("moved")
        )
        jumped = persist_to_shared(jumped, "roots")
        parent = jumped.select("node", F.col("next").alias("up"))
        if not jumped.where("moved").limit(1).count():
            return parent


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` to ``(node, root)``: the smallest node each linked node can reach.

    Every step is an equi-join or a combining minimum, so a node with many links is no hot group. The number of
    rounds grows with the logarithm of the longest path; each round's result is written, so a lost executor
    repeats one round.
    """
    edges = persist_to_shared(links.where("a != b").select("a", "b").distinct(), "links")
    label = None
    while True:
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up"))
        parent = _roots(persist_to_shared(parent, "parents"))
        top = parent.select(F.col("node").alias("__n"), F.col("up").alias("__r"))
        if label is None:
            label = parent.select("node", F.col("up").alias("root"))
        else:
            label = label.join(top, F.col("root") == F.col("__n"), "left").select("node", F.coalesce("__r", "root").alias("root"))
            label = persist_to_shared(label, "labels")
        top_b = parent.select(F.col("node").alias("__m"), F.col("up").alias("__s"))
        edges = edges.join(top, F.col("a") == F.col("__n")).join(top_b, F.col("b") == F.col("__m"))
        edges = persist_to_shared(edges.where("__r != __s").select(F.col("__r").alias("a"), F.col("__s").alias("b")).distinct(), "links")
        if not edges.limit(1).count():
            return label
