"""Held-out accuracy, and pairs that no additive model can tell apart."""

import random

import numpy as np
import pyarrow as pa

from tablewright.llm import toxicity


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = toxicity.score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted").join(labels, "doc_id")
    rows = scored.where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.85 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)


def test_labels_of_held_out_rows_are_never_read(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(toxicity.score_toxicity(docs, y).select("doc_id", "score").collect()) for y in (labels, turned))
    assert a == b and len(a) == docs.count()


def test_the_machine_learns_an_interaction():
    """Two words that are harmless alone and toxic together, the opposite of additive."""
    rnd = random.Random(3)
    owner, term, label = [], [], []
    for r in range(1500):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        words = ([0] if a else []) + ([1] if b else []) + [2 + rnd.randrange(20)]
        owner += [r] * len(words)
        term += words
        label.append(float(a != b))  # exclusive or
    term, owner, label = np.array(term), np.array(owner), np.array(label)
    bias, weight, factor = toxicity.learn(term, owner, label, 22)
    model = toxicity.Model(np.zeros(0), bias, weight, factor)
    assert ((model.logit(term, owner, 1500) > 0) == (label > 0.5)).mean() > 0.95


def test_logit_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    model = toxicity.Model(np.zeros(0), 0.3, rng.normal(size=9), rng.normal(size=(9, 3)))
    rows = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5, 6, 7, 8]]
    owner = np.repeat(np.arange(4), [len(r) for r in rows])
    got = model.logit(np.array(sum(rows, [])), owner, 4)
    for r, value in zip(rows, got):
        pairs = sum(model.factor[a] @ model.factor[b] for i, a in enumerate(r) for b in r[i + 1 :])
        assert np.isclose(value, 0.3 + sum(model.weight[a] for a in r) + pairs)


def test_terms_stay_inside_words_and_documents(monkeypatch):
    from tablewright.llm import arrays

    texts = ["abcdefgh ij", "", None, "klmnop", "abcd", "ABCD! efgh"]
    whole = [frozenset(zip(*(x.tolist() for x in t))) for t in toxicity.terms(pa.array(texts))]
    monkeypatch.setattr(arrays, "PIECE", 5)
    small = frozenset(p for t in toxicity.terms(pa.array(texts)) for p in zip(*(x.tolist() for x in t)))
    assert small == frozenset().union(*whole)
    alone = [{t for t, _ in zip(*toxicity.distinct(pa.array([x])))} for x in texts]
    assert alone[1] == alone[2] == set() and alone[4] < alone[0] | {next(iter(alone[4] - alone[0]), 0)}
    assert len(alone[0]) == 2 + 5 + 4 and len(alone[5]) == 2 + 2
