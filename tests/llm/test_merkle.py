"""Manifests against plain trees: addresses, blocks, proofs, odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@pytest.mark.parametrize("levels", range(1, 6))
def test_addresses_are_a_permutation_with_subtrees_in_one_stretch(levels):
    every = [merkle.address(d, np.arange(8**d), levels) for d in range(levels)]
    assert sorted(np.concatenate(every).tolist()) == list(range(merkle.nodes_in(levels)))
    assert every[0][0] == 0
    top = levels // 2
    if top:
        lower = merkle.nodes_in(levels - top)
        for sub in range(8**top):  # each subtree of the lower half is one stretch, laid out like a tree of its own
            first = merkle.nodes_in(top) + sub * lower
            for d in range(top, levels):
                wide = 8 ** (d - top)
                assert (every[d][sub * wide : (sub + 1) * wide] == first + merkle.address(d - top, np.arange(wide), levels - top)).all()


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 100, 511, 512])
def test_a_block_holds_the_tree_and_its_paths(n):
    leaves = [hashlib.sha256(bytes([i % 256, i // 256])).hexdigest() for i in range(n)]
    height = merkle.height_of(n)
    grid = np.frombuffer(bytes.fromhex("".join(leaves)), np.uint8).reshape(n, 32)
    store = merkle.build_block(grid, height)
    root = brute.levels(leaves)[-1][0]
    assert store[:32].hex() == root
    found = list(merkle.paths(store, n, height))
    assert len(found) == n
    for leaf, (siblings, steps) in zip(leaves, found, strict=True):
        assert merkle.fold(leaf.encode(), siblings, steps).decode() == root
        assert len(siblings) == 64 * sum(steps)


def docs(sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) + i, f"Text {i} IN {lang}" if i % 5 else None, lang, f"s{i % 3}", i if i % 7 else None) for i in range(n)]
    return rows[::-1]


@pytest.mark.parametrize("levels, sizes", [
    (3, {"de": 1, None: 9, "en": 700}),
    (1, {"a": 8, "b": 9, "é": 64, "z": 65, None: 1, "": 600}),
    (2, {f"l{i}": 1 + i % 4 for i in range(150)}),
    (3, {"only": 513}), (3, {"only": 1}),
])
def test_equals_plain_trees(spark, levels, sizes):
    """Tiers of blocks of any height, one tree or many, give the plain tree."""
    rows = docs(sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    low = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    manifest = merkle.build(df, FIELDS, presented={"text": low}, levels=levels)
    out = merkle.audit(manifest).collect()
    got = {(r.doc_id, r.leaf, r.subroot, r.root, brute.sha(r.siblings), r.folded_root, r.verified) for r in out}
    want = set(brute.manifest(rows))
    assert got == want and len(out) == len(rows)
    assert manifest.root() == next(iter(want))[3]
    assert {r.verified for r in out} == {True, False} or len(rows) == 1


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(1, "a", "x", None, None)] * 40 + [(None, "b", "x", "s", 1)] * 2 + [(1, "c", "x", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    manifest = merkle.build(df, FIELDS)
    out = merkle.audit(manifest).collect()
    assert len(out) == len(rows) and all(r.verified for r in out)
    assert len({r.leaf for r in out}) == 3 and len({r.root for r in out}) == 1
    empty = merkle.build(df.limit(0), FIELDS)
    assert empty.root() is None and merkle.audit(empty).collect() == []


def test_a_changed_field_is_seen_and_null_is_not_empty(spark):
    df = spark.createDataFrame([(i, "", "x", None, 0) for i in range(20)], SCHEMA)
    for name, value in (("text", F.lit(None).cast("string")), ("source", F.lit("")), ("n_chars", F.lit(1).cast("long"))):
        one = F.when(F.col("doc_id") == 7, value).otherwise(F.col(name))
        out = merkle.audit(merkle.build(df, FIELDS, presented={name: one})).collect()
        assert [r.doc_id for r in out if not r.verified] == [7]
