"""The Jaccard join against brute force, and what its filters and stars must not lose."""

import random

import numpy as np
import pytest

from tablewright.llm import graph, near_copies
from tests.llm import brute


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rnd.randrange(4, 160))]
        docs.append(base)
        for _ in range(rnd.randrange(9)):
            copy = list(base)
            for _ in range(rnd.randrange(1 + len(base) // 25)):
                copy[rnd.randrange(len(copy))] = word()
            docs.append(copy[: len(copy) - rnd.randrange(1 + len(copy) // 12)])
    passage = [word() for _ in range(60)]
    docs += [[word() for _ in range(rnd.randrange(80))] + passage + [word() for _ in range(rnd.randrange(80))] for _ in range(30)]
    docs += [["a", "b"], ["A", "b"], ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], [], ["x"] * 50, ["x"] * 90]
    ids = rnd.sample(range(10_000), len(docs))
    return [(i, " ".join(d)) for i, d in zip(ids, docs)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc: (r.n_shingles, r.component) for r in near_copies.similar_documents(df).collect()}
    assert got == brute.components(docs)


def test_an_ignorant_sketch_loses_nothing(spark, monkeypatch):
    """The order of shingles only steers the work: here it knows nothing of their frequencies."""
    monkeypatch.setattr(near_copies, "frequencies", lambda docs, words: np.zeros(1 << near_copies.SKETCH_BITS, np.uint32))
    docs = corpus(7)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc: (r.n_shingles, r.component) for r in near_copies.similar_documents(df).collect()} == brute.components(docs)


def test_whole_sets_are_not_written(spark, monkeypatch):
    """Sets are as large as their texts: on disk they would stand beside the exchange that they are read for."""
    written = []
    keep = near_copies.persist_to_shared
    monkeypatch.setattr(near_copies, "persist_to_shared", lambda df, label="cut": written.append((label, keep(df, label))) or written[-1][1])
    docs = corpus(2)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc: (r.n_shingles, r.component) for r in near_copies.similar_documents(df).collect()} == brute.components(docs)
    assert "parts" in {label for label, _ in written} and not [label for label, table in written if "shingles" in table.columns]


def test_keep_one(spark):
    docs = corpus(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = {i for i, (_, c) in brute.components(docs).items() if i == c}
    assert {r.doc_id for r in near_copies.keep_one(df).collect()} == want


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(3).shuffle(edges)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}
