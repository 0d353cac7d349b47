"""Footers of every file, gates over them, and tables whose folders differ."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators import gates
from tablewright.session import scratch
from tablewright.sources import footers
from tablewright.sources.snapshots import SnapshotStore


def changed_store(spark, order):
    """Two changed folders on dev; ``order`` says which comes first. One has a forbidden and a retyped column."""
    store = SnapshotStore(spark, scratch(spark, "store"))
    rows = spark.range(20).selectExpr("id", "cast(id as double) AS v", "'x' AS s")
    kept = store.write(rows, "t")
    store.commit("main", "load", {"t": [kept]})
    store.create_branch("dev", "main")
    good = store.write(rows, "t")
    bad = store.write(rows.selectExpr("id", "cast(v as string) AS v", "s", "'a@b' AS email"), "t")
    store.commit("dev", "change", {"t": [kept, *((good, bad) if order else (bad, good))]})
    return store, good, bad


@pytest.mark.parametrize("order", [True, False])
def test_a_bad_column_in_either_changed_folder_is_found(spark, order):
    store, good, bad = changed_store(spark, order)
    opened = footers.footers(store.changed_files("t", "main", "dev"))
    found = gates.blocked_columns(opened.select(F.col("path").alias("table"), "column", "type"), ["email"]).collect()
    assert found and all(bad in r.subject for r in found)
    table = F.lit("t").alias("table")
    published = footers.footers(footers.data_files(spark, store.tables("main")["t"])).select(table, "path", "position", "column", "type")
    drift = gates.file_schema_changes(gates.published_schema(published), opened.select(table, "path", "position", "column", "type")).collect()
    assert {r.detail for r in drift} == {"retyped v from double to string", "added email"} and all(bad in r.subject for r in drift)
    n_files = footers.data_files(spark, [bad]).count()
    assert len(drift) == 2 * n_files


def test_sampling_opens_one_file_of_each_folder(spark):
    store, good, bad = changed_store(spark, True)
    files = store.changed_files("t", "main", "dev")
    assert files.count() > 2  # range() writes several files a folder
    for sample, n in ((True, 2), (False, files.count())):
        picked = gates.files_to_check(files.select("path", F.lit("changed").alias("type")), ".parquet", sample)
        assert footers.footers(picked).select("path").distinct().count() == n
        hits = gates.blocked_columns(footers.footers(picked).select(F.col("path").alias("table"), "column", "type"), ["email"])
        assert hits.count() >= 1


def test_footers_are_what_spark_reads(spark):
    path = scratch(spark, "types")
    spark.sql("SELECT 1 AS a, cast(2 as decimal(12,3)) AS `b c`, array(1) AS l, named_struct('x', 1L) AS st, map('k', 1.5D) AS m, "
              "timestamp'2024-01-01 00:00:00' AS t, date'2024-01-01' AS d, cast('x' as binary) AS r, cast(null as string) AS n").write.parquet(path)
    got = footers.footers(footers.data_files(spark, [path])).orderBy("position").collect()
    want = spark.read.parquet(path).schema
    assert [(r.column, r.type) for r in got] == [(f.name, f.dataType.simpleString()) for f in want.fields] and {r.n_rows for r in got} == {1}


def test_footers_of_files_of_other_writers_and_of_empty_tables(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "with space"
    folder.mkdir()
    pq.write_table(pa.table({"a": pa.array([], pa.int32()), "b": pa.array([], pa.list_(pa.string()))}), folder / "x.parquet")
    got = footers.footers(footers.data_files(spark, [str(folder)])).orderBy("position").collect()
    assert [(r.n_rows, r.column, r.type) for r in got] == [(0, "a", "int"), (0, "b", "array<string>")]
    assert footers.footers(footers.data_files(spark, [])).collect() == []


def test_a_file_that_is_no_parquet_file_stops_the_gate(spark, tmp_path):
    (tmp_path / "x.parquet").write_bytes(b"no footer here")
    with pytest.raises(Exception, match="(?i)parquet"):
        footers.footers(footers.data_files(spark, [str(tmp_path)])).collect()


def test_a_store_that_arrow_does_not_open_is_read_through_spark(spark, monkeypatch):
    path = scratch(spark, "far")
    spark.range(5).write.parquet(path)
    monkeypatch.setattr(footers, "DIRECT", ())
    got = footers.footers(footers.data_files(spark, [path])).collect()
    assert {(r.column, r.type) for r in got} == {("id", "bigint")} and sum(r.n_rows for r in got) == 5


@pytest.mark.parametrize("wide_first", [True, False])
def test_a_table_has_the_columns_of_all_its_folders(spark, wide_first):
    store = SnapshotStore(spark, scratch(spark, "store"))
    narrow, wide = spark.range(3), spark.range(3, 5).selectExpr("id", "'x' AS c")
    first, second = (wide, narrow) if wide_first else (narrow, wide)
    store.overwrite("main", "t", first)
    store.append("main", "t", second)
    out = store.read("t", "main")
    assert sorted(out.columns) == ["c", "id"] and sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]
    assert out.where("c IS NULL").count() == 3
    store.create_branch("dev", "main")
    store.append("dev", "t", spark.range(9, 10).selectExpr("id", "'y' AS d"))
    store.append("dev", "t", spark.range(10, 11))
    _, new = store.changed("t", "main", "dev")
    assert sorted(new.columns) == ["d", "id"]
