"""The merge over folders and key ranges gives the rows of the plain merge, and leaves equal data alone."""

import random

import pytest

from tablewright.operators import merge
from tablewright.operators.ref_merge import MergeConflict, RefMerge
from tablewright.session import scratch
from tablewright.sources.snapshots import RefError, SnapshotStore

SCHEMA = "id long, a string, b double"


def table(n, start=0):
    return {i: (None if i % 7 == 0 else f"t{i}", None if i % 5 == 0 else i / 2) for i in range(start, start + n)}


def edit(rows, seed, share=0.1):
    rnd, out = random.Random(seed), {}
    for i, (a, b) in rows.items():
        what = rnd.random()
        if what < share / 3:
            continue
        out[i] = ("new", b) if what < share * 2 / 3 else (a, None) if what < share else (a, b)
    return out | {10_000 + i: ("added", float(seed)) for i in range(3)}


def frame(spark, rows):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in rows.items()], SCHEMA)


def three(spark, seeds=(1, 2), ours_edit=edit, theirs_edit=edit):
    store = SnapshotStore(spark, scratch(spark, "store"))
    fixed, loose = table(200, 50_000), table(300)
    keep = store.write(frame(spark, fixed), "t")
    store.commit("main", "load", {"t": [keep, store.write(frame(spark, loose), "t")]})
    sides = {"base": loose, "ours": ours_edit(loose, seeds[0]), "theirs": theirs_edit(loose, seeds[1])}
    for branch in ("ours", "theirs"):
        store.create_branch(branch, "main")
        store.commit(branch, "edit", {"t": [keep, store.write(frame(spark, sides[branch]), "t")]})
    return store, keep, {s: frame(spark, fixed | rows) for s, rows in sides.items()}


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert sorted(map(repr, a.select(columns).collect())) == sorted(map(repr, b.select(columns).collect()))


@pytest.mark.parametrize("ranges", [1, 64, 4096])
@pytest.mark.parametrize("prefer", [None, "theirs"])
def test_rows_of_the_plain_merge(spark, ranges, prefer):
    store, _, sides = three(spark)
    found = RefMerge(store, "t", ["id"], "main", "ours", "theirs", ranges)
    same(found.rows(prefer), merge.merge_three_way(sides["base"], sides["ours"], sides["theirs"], ["id"], prefer))


def test_shared_folders_are_not_read_and_digests_are_kept(spark):
    store, keep, _ = three(spark)
    first = RefMerge(store, "t", ["id"], "main", "ours", "theirs")
    files = first.moved().inputFiles()
    assert files and not [f for f in files if keep in f]
    assert len(first.made) == 3  # a folder on each side; none for what they share
    again = RefMerge(store, "t", ["id"], "main", "ours", "theirs")
    assert again.differing().count() > 0 and again.made == []


def test_only_ranges_that_differ_are_compared(spark):
    one = lambda rows, seed: rows | {7 + seed: ("changed", 1.0)}
    store, _, sides = three(spark, ours_edit=one, theirs_edit=one)
    found = RefMerge(store, "t", ["id"], "main", "ours", "theirs")
    assert found.differing().count() == 2
    same(found.rows(), merge.merge_three_way(sides["base"], sides["ours"], sides["theirs"], ["id"]))


def test_a_value_that_moves_between_columns_is_a_change(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    put = lambda branch, row: store.overwrite(branch, "t", spark.createDataFrame([row], "id long, a string, b string"))
    put("main", (1, None, "x"))
    store.create_branch("ours", "main")
    store.create_branch("theirs", "main")
    put("theirs", (1, "x", None))
    assert [tuple(r) for r in RefMerge(store, "t", ["id"], "main", "ours", "theirs").rows().collect()] == [(1, "x", None, "theirs")]


def test_commit_keeps_shared_folders_and_refuses_conflicts(spark):
    mine = lambda rows, _: rows | {3: ("ours", 0.0)}
    yours = lambda rows, _: {i: v for i, v in rows.items() if i != 4}
    store, keep, _ = three(spark, ours_edit=mine, theirs_edit=yours)
    found = RefMerge(store, "t", ["id"], "main", "ours", "theirs")
    found.commit("ours", "merge theirs")
    assert keep in store.tables("ours")["t"] and len(store.tables("ours")["t"]) == 2
    got = {r.id: (r.a, r.b) for r in store.read("t", "ours").collect()}
    assert got == {i: v for i, v in (table(200, 50_000) | table(300) | {3: ("ours", 0.0)}).items() if i != 4}
    with pytest.raises(RefError):  # ours has moved since
        found.commit("ours", "again")

    store, _, _ = three(spark, ours_edit=mine, theirs_edit=lambda rows, _: rows | {3: ("theirs", 0.0)})
    before = store.tables("ours")
    found = RefMerge(store, "t", ["id"], "main", "ours", "theirs")
    with pytest.raises(MergeConflict):
        found.commit("ours", "merge theirs")
    assert store.tables("ours") == before
    found.commit("ours", "merge theirs", prefer="theirs")
    assert store.read("t", "ours").where("id = 3").first().a == "theirs"


def test_equal_versions_columns_and_repeated_keys(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    store.overwrite("main", "t", frame(spark, table(20)))
    store.create_branch("ours", "main")
    store.create_branch("theirs", "main")
    assert RefMerge(store, "t", ["id"], "main", "ours", "theirs").rows().where("status = 'unchanged'").count() == 20
    wide = spark.createDataFrame([(500, "n", 1.0, "more")], SCHEMA + ", c string")
    store.append("theirs", "t", wide)  # a column more, in a folder that theirs alone has
    rows = RefMerge(store, "t", ["id"], "main", "ours", "theirs").rows()
    assert rows.where("c = 'more' AND status = 'theirs'").count() == 1 and rows.count() == 21
    store.append("ours", "t", frame(spark, {900: ("x", 1.0)}).union(frame(spark, {900: ("y", 1.0)})))
    with pytest.raises(Exception, match="key occurs twice"):
        RefMerge(store, "t", ["id"], "main", "ours", "theirs").rows().count()
