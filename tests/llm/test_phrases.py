"""Collocations against plain counting, and what the summaries promise."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablewright.llm import phrases
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string"


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = ["New", "york", "new", "YORK", "city", "é", "Ünder", "token", "=", "a", "b", "c\x0bd", "x\ty", "of", "the", "=a"]
    gap = [" ", "  ", "\t", " \t ", ". ", ",", "\n", " ; ", "!?", "\r\n"]
    texts = []
    for _ in range(n):
        words = [rnd.choice(vocabulary[: rnd.choice((4, 16))]) for _ in range(rnd.randrange(60))]
        texts.append("".join(w + rnd.choices(gap, [30, 3, 2, 1, 2, 2, 1, 1, 1, 1])[0] for w in words))
    rows = [(i, t, rnd.choice(["en", "en", "fr", None, "und", "é"])) for i, t in enumerate(texts)]
    return rows + [(n, None, "en"), (n + 1, "", "xx"), (n + 2, "a a a a a a a a a a a a a a a", "de"), (n + 3, texts[0], "en")]


@pytest.mark.parametrize("small", [0, phrases.SMALL])
@pytest.mark.parametrize("seed", range(2))
def test_equals_plain_counting(spark, monkeypatch, seed, small):
    monkeypatch.setattr(phrases, "BUCKET", 300)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = phrases.collocations(df, small=small).drop("n_words", "cut").collect()
    assert {tuple(r) for r in got} == set(brute.collocations(rows)) and got


def test_top_and_least_are_parameters(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in phrases.collocations(df, least=25, top=3).drop("n_words", "cut").collect()}
    assert got == set(brute.collocations(rows, 25, 3))


@pytest.mark.parametrize("seed", range(6))
def test_no_frequent_hash_is_lost_when_counters_are_few(seed):
    """Far more different hashes than counters, merged in any order and from summaries that were cut themselves."""
    rng = np.random.default_rng(seed)
    often = np.repeat(np.arange(30, dtype=np.uint64), rng.integers(10, 60, 30))
    stream = rng.permutation(np.concatenate([often, rng.integers(100, 10**9, 4000).astype(np.uint64)]))
    true, least = Counter(stream.tolist()), 10
    capacity = len(stream) // least + 1
    parts = [phrases.Summary(capacity) for _ in range(7)]
    for i, chunk in enumerate(np.array_split(stream, 40)):
        own, count = np.unique(chunk, return_counts=True)
        parts[i % 7].merge(own, count)
        parts[i % 7].settle()
    whole = phrases.Summary(capacity)
    for p in parts:
        p.settle()
        whole.merge(p.hashes, p.counts, p.lost)
        whole.settle()
        assert len(whole.counts) <= capacity
    kept = set(whole.survivors(least).tolist())
    assert {h for h, c in true.items() if c >= least} <= kept
    assert whole.lost * (capacity + 1) <= len(stream) and len(kept) < len(true)
    for h, c in zip(whole.hashes.tolist(), whole.counts.tolist()):
        assert c <= true[h] <= c + whole.lost


def test_a_task_of_the_first_pass_holds_a_bounded_share_of_its_text():
    """24 MB of text in one Arrow batch, as Spark hands over a split: words of a small part exist at one time."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 4000)) for _ in range(750)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    runs = sum(4000 - n + 1 for n in (1, 2, 3)) * len(texts)
    mass = sum(b.column(2)[0].as_py() for b in phrases.sent_runs(iter([batch]), 3, 6))  # fills the tables of powers
    tracemalloc.start()
    found = sum(b.column(2)[0].as_py() for b in phrases.sent_runs(iter([batch]), 3, 6))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == mass == runs and peak < 125 << 20, peak >> 20


def test_scores_are_exact_beyond_64_bits(spark):
    a, x, y = 9_000_000_000_001, 9_100_000_000_007, 9_200_000_000_003
    counts = spark.createDataFrame([("en", 2, "p q", a), ("en", 1, "p", x), ("en", 1, "q", y), ("en", 0, "", 10**14)], "lang string, n_words int, phrase string, f long")
    assert phrases.scored(counts, 3, 50).first()["score"] == 10**6 * a * a // (x * y)


def test_ties_of_cuts_and_of_ranks(spark):
    counts = [("en", 3, "a b c", 10), ("en", 2, "a b", 25), ("en", 2, "b c", 25), ("en", 1, "a", 30), ("en", 1, "b", 40), ("en", 1, "c", 30), ("en", 2, "c a", 10)]
    out = {r.phrase: r for r in phrases.scored(spark.createDataFrame(counts, "lang string, n_words int, phrase string, f long"), 3, 40).collect()}
    assert (out["a b c"].cut, out["a b c"].l, out["a b c"].r) == (1, 30, 25)  # both cuts score the same
    assert set(out) == {"a b c", "c a"}  # 100 * 10 >= 40 * 25
