"""The chunk index follows the versions of a table, and reads no more than they changed."""

import random

import pytest

from tablewright.operators import chunks, reindex
from tablewright.session import scratch
from tablewright.sources.snapshots import SnapshotStore


def texts(seed, n=40):
    rnd = random.Random(seed)
    return {i: "".join(rnd.choice("ab é") for _ in range(rnd.randrange(400))) for i in range(n)} | {n: None, n + 1: ""}


def stored(spark, store, docs):
    return store.write(spark.createDataFrame(list(docs.items()), "id long, text string"), "t")


def of(spark, docs, size=100, overlap=10):
    return chunks.fixed_chunks(spark.createDataFrame(list(docs.items()), "id long, text string"), "id", "text", size, overlap)


@pytest.mark.parametrize("seed", range(3))
def test_updates_turn_the_old_index_into_the_new_one(spark, seed):
    rnd = random.Random(seed)
    store = SnapshotStore(spark, scratch(spark, "store"))
    fixed, old = {1000 + i: x for i, x in texts(9).items()}, texts(seed)
    new = {}
    for i, x in old.items():
        what = rnd.randrange(6)
        if what == 0:
            continue  # removed
        new[i] = x if what < 3 or not x else (x[:150] + "!" + x[151:] if what == 3 else x + " more" if what == 4 else x[: len(x) // 2])
    new |= {500: "added " * 60, 501: "", 502: None, 40: "was null", 41: None}
    kept = stored(spark, store, fixed)
    store.commit("main", "load", {"t": [kept, stored(spark, store, old)]})
    store.create_branch("dev", "main")
    store.commit("dev", "change", {"t": [kept, stored(spark, store, new)]})
    index = reindex.ChunkIndex(store, "t", "id", size=100, overlap=10)
    updates = index.updates("main", "dev")
    got = sorted(map(tuple, reindex.apply_updates(of(spark, fixed | old), updates, "id").collect()))
    assert got == sorted(map(tuple, of(spark, fixed | new).collect()))
    a, b = ({(r.id, r.chunk_no): r.chunk for r in of(spark, x).collect()} for x in (old, new))
    want = {(k, "delete" if k not in b else "upsert") for k in {*a, *b} if a.get(k) != b.get(k)}
    assert {((r.id, r.chunk_no), r.op) for r in updates.collect()} == want  # nothing that did not change


def test_only_folders_that_differ_are_read_and_each_is_digested_once(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    shared, first, second = stored(spark, store, texts(1)), stored(spark, store, {900: "x" * 300}), stored(spark, store, {900: "x" * 299 + "y"})
    store.commit("main", "load", {"t": [shared, first]})
    store.create_branch("dev", "main")
    store.commit("dev", "change", {"t": [shared, second]})
    index = reindex.ChunkIndex(store, "t", "id", size=100, overlap=10)
    out = index.updates("main", "dev")
    assert [(r.id, r.chunk_no, r.op) for r in out.collect()] == [(900, 3, "upsert")]
    read = out.inputFiles()
    assert read and not [f for f in read if shared in f or first in f]  # of the old version digests only
    assert len(index.made) == 2 and not [f for f in index.made if shared.rsplit("/", 1)[1] in f]
    again = reindex.ChunkIndex(store, "t", "id", size=100, overlap=10)
    assert again.updates("main", "dev").count() == 1 and again.made == []
    back = again.updates("dev", "main")  # and back: main's texts are read now
    assert [(r.id, r.op) for r in back.collect()] == [(900, "upsert")] and again.made == []


def test_equal_versions_moved_documents_and_a_first_version(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    a, b = texts(2), {700: "z" * 150}
    store.commit("main", "load", {"t": [stored(spark, store, a), stored(spark, store, b)]})
    store.create_branch("dev", "main")
    index = reindex.ChunkIndex(store, "t", "id", size=100, overlap=10)
    assert index.updates("main", "dev").collect() == []
    store.commit("dev", "compact", {"t": [stored(spark, store, a | b)]})  # same rows in one folder
    assert index.updates("main", "dev").collect() == []
    whole = index.updates(None, "main")
    assert sorted((r.id, r.chunk_no, r.chunk) for r in whole.collect()) == sorted(map(tuple, of(spark, a | b).collect()))
