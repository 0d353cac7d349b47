"""The index of cells and rings against distances to all vectors."""

import numpy as np
import pytest

from tablewright.operators import metric_index
from tablewright.operators.metric_index import MetricIndex


def frame(spark, x, name="vec_id", column="embedding"):
    rows = [(i, None if v is None else [float(n) for n in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"{name} long, {column} array<double>").repartition(5)


def brute(x, q, k):
    out = {}
    for i, p in enumerate(q):
        d = np.sqrt(((x - p) ** 2).sum(axis=1))
        out[i] = sorted(range(len(x)), key=lambda j: (d[j], j))[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(metric_index, "BLOCK_VECTORS", 32)
    monkeypatch.setattr(metric_index, "BLOCK_QUERIES", 8)


@pytest.mark.parametrize("kind", ["clusters", "noise", "copies"])
def test_equal_to_all_distances(spark, small_blocks, kind):
    rnd = np.random.default_rng(11)
    if kind == "clusters":
        x = rnd.normal(size=(40, 4))[rnd.integers(0, 40, 1500)] * 20 + rnd.normal(size=(1500, 4))
    elif kind == "noise":
        x = rnd.normal(size=(700, 8))
    else:  # a third of all rows are one vector, and distances tie
        x = rnd.integers(0, 6, size=(900, 3)).astype(float)
        x[:300] = x[0]
    q = np.concatenate([x[:20], rnd.normal(size=(15, x.shape[1])) * 15])
    index = MetricIndex.build(frame(spark, x), pivots=40)
    assert index.blocks.selectExpr("sum(n)").first()[0] == len(x)
    assert index.blocks.selectExpr("max(n)").first()[0] <= 32
    asked = frame(spark, q, "query_id", "vector")
    assert found(index.search(asked, 5)) == brute(x, q, 5)
    if kind == "clusters":
        met = index.meetings(asked, 5).first()
        assert met.all_pairs == len(q) * index.blocks.count()
        assert met.met * 4 < met.all_pairs


def test_few_null_and_no_vectors(spark):
    asked = frame(spark, [[0, 0], None, [5, 5]], "query_id", "vector")
    index = MetricIndex.build(frame(spark, [[0, 1], None, [4, 4]]))
    assert found(index.search(asked, 5)) == {0: [0, 2], 2: [2, 0]}  # all there are, fewer than asked for
    nothing = MetricIndex.build(frame(spark, [None, None]))
    assert nothing.search(asked, 5).count() == 0
    assert index.search(asked.limit(0), 5).count() == 0


def test_an_index_is_kept_for_more_searches(spark):
    x = np.random.default_rng(2).normal(size=(200, 3))
    index = MetricIndex.build(frame(spark, x))
    for lo in (0, 50):
        assert found(index.search(frame(spark, x[lo : lo + 5], "query_id", "vector"), 3)) == brute(x, x[lo : lo + 5], 3)
