"""Repeated strings against brute force, on texts made to repeat in many ways."""

import random

import numpy as np
import pytest

from tablewright.llm import arrays, repeats
from tests.llm import brute


def corpus(seed):
    rnd = random.Random(seed)
    shared = ["".join(rnd.choice("abc é") for _ in range(rnd.randrange(30, 140))) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [rnd.choice(shared) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(90))) for _ in range(rnd.randrange(5))]
        docs.append("".join(parts))
    docs += [docs[3], docs[5] + "x", "y" + docs[5], "a" * 200, "a" * 120, "ab" * 90, "ba" * 90, None, "", shared[0][:50], shared[0][:49]]
    ids = rnd.sample(range(1000), len(docs))
    return list(zip(ids, docs))


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET", 200)
    monkeypatch.setattr(repeats, "BUFFER", 500)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {tuple(r) for r in repeats.remove_repeats(df).drop("kept").collect()}
    assert got == set(brute.repeats(docs))


def test_repeated_ids_never_cut_each_other(spark):
    text = "the same words stand here and there and everywhere in this text of ours"
    docs = [(5, text), (5, text + " !"), (5, text), (9, "? " + text)]
    out = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(5, 0), (5, 0), (5, 0), (9, len(text))]


def test_pieces_do_not_change_anchors(monkeypatch):
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 700, 730, 2900, 5000])
    whole = [np.concatenate(x) for x in zip(*repeats.anchors(data, offsets))]
    monkeypatch.setattr(arrays, "PIECE", 64)
    cut = [np.concatenate(x) for x in zip(*repeats.anchors(data, offsets))]
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_a_hot_key_is_split_between_its_contexts():
    key = np.full(1000, 7, np.uint64)
    context = np.arange(1000, dtype=np.uint64)
    s = repeats.Splitters(key, context, 8)
    assert len(set(s.bucket(key, context))) == 8 and s.cut(key).all()
    assert not repeats.Splitters(key, context, 1).cut(key).any()
