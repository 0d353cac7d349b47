"""Branches, tags, merges and reverts over Parquet folders."""

import pytest

from tablewright.operators import gates, publish
from tablewright.session import scratch
from tablewright.sources.snapshots import RefError, SnapshotStore


@pytest.fixture()
def store(spark):
    s = SnapshotStore(spark, scratch(spark, "store"))
    s.overwrite("main", "t", spark.range(10), "load", metadata={"by": "test"}, committer="me")
    return s


def n(store, ref, table="t"):
    return store.read(table, ref).count()


def test_branch_isolation_and_merge(spark, store):
    store.create_branch("dev", "main")
    store.append("dev", "t", spark.range(10, 15))
    assert (n(store, "main"), n(store, "dev")) == (10, 15)
    merged = store.merge("dev", "main")
    assert n(store, "main") == 15 == n(store, merged)
    assert len(store.commits().where(f"commit_id = '{merged}'").first().parents) == 2
    store.append("dev", "t", spark.range(15, 17))  # a second round merges from the new base
    store.merge("dev", "main")
    assert n(store, "main") == 17


def test_an_append_that_lost_a_race_is_refused(spark, store):
    """The list it would extend is out of date: publishing it would drop the other writer's rows."""
    write = store.write

    def slow(df, table, *a):
        store.write = write
        store.append("main", "t", spark.range(100, 102))  # somebody else is faster
        return write(df, table, *a)

    store.write = slow
    with pytest.raises(RefError, match="moved"):
        store.append("main", "t", spark.range(50, 55))
    assert n(store, "main") == 12


def test_merge_refuses_tables_changed_on_both_sides(spark, store):
    store.create_branch("dev", "main")
    store.overwrite("dev", "t", spark.range(1))
    store.overwrite("main", "t", spark.range(2))
    with pytest.raises(RefError, match="both sides"):
        store.merge("dev", "main")
    assert n(store, "main") == 2


def test_disjoint_tables_never_conflict(spark, store):
    for name in ("a", "b"):
        store.create_branch(name, "main")
        store.overwrite(name, name, spark.range(3))
    store.merge("a", "main")
    store.merge("b", "main")
    assert sorted(store.tables("main")) == ["a", "b", "t"]


def test_revert_keeps_history(spark, store):
    store.overwrite("main", "t", spark.range(3))
    store.overwrite("main", "extra", spark.range(1))
    store.revert("main")
    assert sorted(store.tables("main")) == ["t"] and n(store, "main") == 3
    assert store.commits().count() == 4


def test_tags_and_versions(spark, store):
    store.tag("v1", "main")
    store.overwrite("main", "t", spark.range(3))
    assert n(store, "v1") == 10
    assert store.read_version("t", "main", 0).count() == 10
    with pytest.raises(RefError):
        store.tag("v1", "main")
    with pytest.raises(RefError):
        store.read_version("t", "main", 9)


def test_moved_head_is_refused(spark, store):
    seen = store.head("main")
    store.overwrite("main", "t", spark.range(3))
    with pytest.raises(RefError, match="moved"):
        store.commit("main", "late", {}, expected_head=seen)


def test_drop_and_unknown(store):
    store.create_branch("dev", "main")
    store.drop("dev")
    assert [r.ref for r in store.refs().collect()] == ["main"]
    with pytest.raises(RefError):
        store.read("t", "dev")


def test_merge_schema_fills_nulls(spark, store):
    store.append("main", "t", spark.range(2).selectExpr("id", "'x' AS c"))
    assert store.read("t", "main", merge_schema=True).where("c IS NULL").count() == 10


def test_clone_is_independent(spark, store):
    copy = store.clone(scratch(spark, "clone"))
    copy.overwrite("main", "t", spark.range(1))
    assert (n(store, "main"), n(copy, "main")) == (10, 1)


def test_blocked_publish_leaves_main_alone(spark, store):
    def audits(s, ref):
        return [("rows", gates.non_empty, {"df": s.read("t", ref), "name": "t"})]

    verdict, found = publish.write_audit_publish(store, "empty", "main", {"t": spark.range(0)}, audits)
    assert verdict == "blocked" and found.count() == 1 and n(store, "main") == 10
    verdict, _ = publish.write_audit_publish(store, "more", "main", {"t": spark.range(20)}, audits)
    assert verdict == "published" and n(store, "main") == 20


def test_replaced_partitions_leave_the_old_version(spark, store):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4), ("01", 5)], "k string, v int")
    store.replace_partitions("main", "p", rows, ["k"], "load")
    old = store.head("main")
    before = store.tables(old)["p"]
    store.replace_partitions("main", "p", spark.createDataFrame([("a", 10), ("", 30), ("new", 60)], "k string, v int"), ["k"])
    got = lambda ref: sorted(map(tuple, store.read("p", ref).collect()), key=str)
    assert got("main") == sorted([("a", 10), ("", 30), (None, 4), ("01", 5), ("new", 60)], key=str)
    assert got(old) == sorted([("a", 1), ("a", 2), ("", 3), (None, 4), ("01", 5)], key=str)
    assert len(set(before) & set(store.tables("main")["p"])) == 2  # the null and the 01 partition keep their folders
    store.replace_partitions("main", "p", rows.limit(0), ["k"])  # touches nothing
    assert got("main") == sorted([("a", 10), ("", 30), (None, 4), ("01", 5), ("new", 60)], key=str)


def test_a_failed_replacement_changes_nothing(spark, store):
    store.replace_partitions("main", "p", spark.createDataFrame([(1, 1)], "k int, v int"), ["k"])
    head = store.head("main")
    with pytest.raises(Exception, match="broken"):
        store.replace_partitions("main", "p", spark.sql("SELECT id AS k, raise_error('broken') AS v FROM range(3)"), ["k"])
    with pytest.raises(RefError, match="not partitioned by"):
        store.replace_partitions("main", "p", spark.createDataFrame([(1, 1)], "k int, v int"), ["v"])
    with pytest.raises(RefError, match="not partitioned by"):
        store.replace_partitions("main", "t", spark.range(3), ["id"])
    with pytest.raises(RefError, match="moved"):
        store.replace_partitions("main", "p", spark.createDataFrame([(1, 2)], "k int, v int"), ["k"], expected_head="older")
    assert store.head("main") == head and n(store, "main", "p") == 1
