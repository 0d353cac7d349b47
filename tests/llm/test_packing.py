"""Tokens against the library that defines them, packing against trying all windows."""

import random
import struct

import numpy as np
import pytest

from tablewright.llm import packing
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def texts(seed):
    rnd = random.Random(seed)
    letters = "abc XYZ é  ß\n\t'd'll 1234 ½٣ 漢字 🙂  ​!?…<|endoftext|>"
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(300))) for _ in range(120)]
    return out + ["", " ", "\n\n\n", "a <|endoftext|> b", "<|endoftext|", "x" * 5000, " " * 3000, None]


def test_ids_are_those_of_the_library(spark):
    rows = list(enumerate(texts(1)))
    got = {}
    for r in packing.pieces(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        got[r.doc_id, r.start] = list(struct.unpack(f"<{r.length}I", bytes(r.ids)))
        assert r.length <= 2048 and (r.start + r.length == r.doc_tokens or r.length == 2048)
    for (i, _), want in zip(rows, brute.token_ids([t for _, t in rows])):
        assert [x for at in range(0, len(want), 2048) for x in got.pop((i, at))] == want
    assert not got


def test_every_code_point_in_a_few_places():
    """The fast path splits and merges like the library, whatever the letter."""
    import public_tokenizers
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    fast = packing.encoder(None)
    rnd = random.Random(3)
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [rnd.randrange(0xE000, 0x110000) for _ in range(4000)]
    many = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)}  {chr(c)}{chr(c)}x\n{chr(c)}'s" for c in points]
    assert [x.ids for x in slow.encode_batch(many, add_special_tokens=False)] == [x.tolist() for x in fast(many)]


def test_other_vocabularies_go_to_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pieces(spark.createDataFrame([(1, "Some WORDS here")], SCHEMA), tokenizer=path, end=7).collect()
    assert list(struct.unpack(f"<{rows[0].length}I", bytes(rows[0].ids))) == [*Tokenizer.from_file(path).encode("Some WORDS here", add_special_tokens=False).ids, 7]


@pytest.mark.parametrize("window", [1, 7, 64, 100, 2048])
def test_best_fit_is_that_of_trying_all_windows(window):
    rnd = random.Random(window)
    lengths = sorted((rnd.randrange(1, window + 1) for _ in range(700)), reverse=True)
    fit, used = packing.BestFit(window), {}
    for n in lengths:
        number, offset = fit.place(n)
        assert offset == used.get(number, 0) and offset + n <= window
        used[number] = offset + n
    assert sorted(window - u for u in used.values()) == sorted(brute.best_fit_decreasing(lengths, window))


def packed(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
    return {s: sum(n for _, n in parts) for s, parts in by.items()}


@pytest.mark.parametrize("share", [50, 10**6])
def test_sequences_are_gapless_and_nothing_is_lost(spark, share):
    rnd = random.Random(4)
    lengths = [rnd.choice((1, 2, 5, 64, 64, rnd.randrange(1, 65))) for _ in range(900)]
    rows = [(i % 300, n, "x") for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "doc_id long, length long, offset string").repartition(5)  # repeated ids, a clashing name
    out = packing.pack(df, window=64, share=share).collect()
    sizes = packed(out)
    assert sorted((r.doc_id, r.length) for r in out) == sorted((i, n) for i, n, _ in rows)
    assert max(sizes.values()) <= 64 and sum(64 - s for s in sizes.values()) <= 0.02 * sum(lengths) + 64 * len(lengths) / share
    if share > len(lengths):
        tails = [n for n in lengths if n < 64]
        assert len(sizes) == lengths.count(64) + len(brute.best_fit_decreasing(tails, 64))


def test_a_hot_id_is_dealt_like_any_other(spark):
    df = spark.createDataFrame([(1, 3)] * 3000 + [(2, 3)] * 1000, "doc_id long, length long").repartition(4)
    out = packing.pack(df, window=64, share=100).collect()
    per = {}
    for r in out:
        per[r.sequence_id >> 33] = per.get(r.sequence_id >> 33, 0) + 1
    assert len(per) == 40 and max(per.values()) < 200


def test_the_sequences_hold_the_documents(spark):
    rows = list(enumerate(texts(2)))
    all_ = packing.pack(packing.pieces(spark.createDataFrame(rows, SCHEMA).repartition(2)))
    kept = {r.sequence_id: r for r in packing.sequences(all_).collect()}
    want = dict(zip([i for i, _ in rows], brute.token_ids([t for _, t in rows])))
    for r in all_.collect():
        raw = bytes(kept[r.sequence_id].ids)
        assert len(raw) == 4 * kept[r.sequence_id].n_tokens
        assert list(struct.unpack(f"<{r.length}I", raw[4 * r.offset : 4 * (r.offset + r.length)])) == want[r.doc_id][r.start : r.start + r.length]
