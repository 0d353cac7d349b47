"""Row changes, diffs and merges: properties on random snapshots, and the failure cases."""

import random

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tablewright.operators import diff, dml, merge

SCHEMA = "k int, a string, b double"


def snapshot(spark, seed, keys=range(60)):
    rnd = random.Random(seed)
    rows = [(k, rnd.choice(["x", "y", None]), rnd.choice([1.0, 2.5, float("nan"), None])) for k in keys if rnd.random() < 0.8]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(str, df.select("k", "a", "b").collect()))


@pytest.mark.parametrize("seed", range(3))
def test_apply_of_diff_gives_the_other_side(spark, seed):
    a, b = snapshot(spark, seed), snapshot(spark, seed + 100)
    assert rows(diff.apply_changes(a, diff.changes(a, b, ["k"]), ["k"])) == rows(b)
    assert diff.diff_rows(a, a, ["k"]).isEmpty()


@pytest.mark.parametrize("seed", range(2))
def test_diff_keeps_null_keys(spark, seed):
    """A null is a key like any other: never removed and added at once, never doubled."""
    a, b = (snapshot(spark, s).withColumn("k", F.when(F.col("k") != 7, F.col("k"))) for s in (seed, seed + 50))
    assert diff.diff_rows(a, a, ["k"]).isEmpty()
    assert rows(diff.apply_changes(a, diff.changes(a, a, ["k"]), ["k"])) == rows(a)
    assert rows(diff.apply_changes(a, diff.changes(a, b, ["k"]), ["k"])) == rows(b)


def test_diff_refuses_repeated_keys(spark):
    once, twice = (spark.createDataFrame([(1, "x", 1.0)] * n, SCHEMA) for n in (1, 2))
    for a, b in ((once, twice), (twice, once)):
        with pytest.raises(SparkRuntimeException, match="key occurs twice"):
            diff.diff_rows(a, b, ["k"]).collect()


def test_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, None, 1.0), (2, "x", None), (3, "x", 1.0)], SCHEMA)
    b = spark.createDataFrame([(1, None, 1.0), (2, "x", 2.0), (4, "x", 1.0)], SCHEMA)
    got = {r.k: (r.change, r.changed_columns) for r in diff.diff_rows(a, b, ["k"]).collect()}
    assert got == {2: ("changed", "b"), 3: ("removed", ""), 4: ("added", "")}


@pytest.mark.parametrize("seed", range(3))
def test_merge_properties(spark, seed):
    base, ours, theirs = (snapshot(spark, seed + i) for i in (0, 10, 20))
    same = merge.merge_three_way(base, ours, ours, ["k"])
    assert rows(same) == rows(ours) and same.where("status = 'conflict'").isEmpty()
    assert rows(merge.merge_three_way(base, base, theirs, ["k"])) == rows(theirs)
    assert rows(merge.merge_three_way(base, ours, base, ["k"])) == rows(ours)
    # undoing a commit that was the last one gives the state before it
    assert rows(merge.revert_rows(ours, before=base, after=ours, key=["k"])) == rows(base)
    picked = merge.merge_three_way(base, ours, theirs, ["k"], prefer="theirs")
    blocked = {r.k for r in merge.conflicts(base, ours, theirs, ["k"]).collect()}
    want = {r.k: (r.a, str(r.b)) for r in theirs.collect() if r.k in blocked}
    assert {r.k: (r.a, str(r.b)) for r in picked.collect() if r.k in blocked} == want


def test_merge_refuses_repeated_keys(spark):
    base = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], SCHEMA)
    with pytest.raises(SparkRuntimeException, match="key occurs twice"):
        merge.merge_three_way(base, twice, base, ["k"]).collect()


def test_upsert(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (None, "z", 3.0)], SCHEMA)
    s = spark.createDataFrame([(2, None, 9.0), (3, "n", None), (None, "w", 4.0), (None, "v", 5.0)], SCHEMA)
    out = dml.upsert(t, s, ["k"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "x", 1.0), (2, None, 9.0), (3, "n", None), (None, "z", 3.0), (None, "w", 4.0), (None, "v", 5.0)], key=str
    )
    keyed = s.where("k IS NOT NULL")
    once = dml.upsert(t, keyed, ["k"])
    assert rows(dml.upsert(once, keyed, ["k"])) == rows(once)


def test_upsert_updates_all_target_rows_of_a_key(spark):
    t = spark.createDataFrame([(1, "x", 1.0)] * 50 + [(2, "y", 2.0)], SCHEMA)
    out = dml.upsert(t, spark.createDataFrame([(1, "new", 7.0)], SCHEMA), ["k"])
    assert out.where("a = 'new'").count() == 50 and out.count() == 51


def test_upsert_refuses_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    s = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0)], SCHEMA)
    with pytest.raises(SparkRuntimeException, match="several source rows"):
        dml.upsert(t, s, ["k"]).collect()


def test_delete_keeps_rows_whose_condition_is_null(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0)], SCHEMA)
    assert [r.k for r in dml.delete_where(t, F.col("a").like("%")).collect()] == [2]


def test_insert_new(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    s = spark.createDataFrame([(1, "no", 0.0), (2, "yes", 0.0)], SCHEMA)
    assert rows(dml.insert_new(t, s, ["k"])) == rows(spark.createDataFrame([(1, "x", 1.0), (2, "yes", 0.0)], SCHEMA))


def test_strict_append(spark):
    t = spark.createDataFrame([(1, "x", 1.0)], SCHEMA)
    with pytest.raises(dml.SchemaDrift, match="added"):
        dml.append_strict(t, t.withColumn("c", F.lit(1)))
    with pytest.raises(dml.SchemaDrift, match="retyped"):
        dml.append_strict(t, t.withColumn("b", F.lit("1")))
    assert dml.append_strict(t, t).count() == 2
    assert dml.append_evolving(t, t.withColumn("c", F.lit(1))).columns == ["k", "a", "b", "c"]


def test_schema_diff(spark):
    a = spark.createDataFrame([], "x int, y string")
    b = spark.createDataFrame([], "x long, z string")
    assert diff.diff_schema(a.schema, b.schema) == [
        ("x", "retyped", "int", "bigint"), ("y", "removed", "string", None), ("z", "added", None, "string"),
    ]
