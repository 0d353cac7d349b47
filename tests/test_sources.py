"""Objects, streams and the scratch folder."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewright import session
from tablewright.operators import lineage
from tablewright.session import scratch
from tablewright.sources import objects, scans, sinks
from tablewright.streaming import flows

MANIFEST = [("a/x/1.txt", "c1", 10), ("a/x/2.txt", "c2", 20), ("a/3.txt", "c3", 30), ("b/4.txt", "c4", 40)]


@pytest.fixture(scope="module")
def manifest(spark):
    return spark.createDataFrame(MANIFEST, "path string, checksum string, size_bytes long")


def test_list_prefix(manifest):
    got = {(r.entry, r.n_objects, r.size_bytes, r.path_type) for r in objects.list_prefix(manifest, "a/").collect()}
    assert got == {("a/x/", 2, 30, "common_prefix"), ("a/3.txt", 1, 30, "object")}
    assert {r.entry for r in objects.list_prefix(manifest).collect()} == {"a/", "b/"}


def test_import_takes_the_longest_prefix_once(manifest):
    out = objects.import_prefixes(manifest, {"a/": "all/", "a/x/": "special/"}).collect()
    assert {r.path for r in out} == {"special/1.txt", "special/2.txt", "all/3.txt"}


def test_images_round_trip(spark):
    folder = session.scratch(spark, "img")
    data = [(f"i{w}.bmp", objects.gray_bitmap(w, 3, list(range(3 * w)))) for w in (1, 2, 3, 4)] + [("bad.bmp", b"no image")]
    df = spark.createDataFrame(data, "name string, content binary")
    assert objects.write_objects(df, folder).count() == 5
    assert {(r.width, r.height) for r in objects.scan_images(spark, folder).collect()} == {(1, 3), (2, 3), (3, 3), (4, 3), (None, None)}
    found = objects.scan_binary(spark, folder, "i*.bmp").select("length").collect()
    assert sorted(r.length for r in found) == sorted(len(c) for n, c in data if n != "bad.bmp")


def test_stream_goes_on_where_it_stopped(spark):
    src, out, progress = (session.scratch(spark, n) for n in ("src", "out", "progress"))
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))

    def run():
        stream = flows.stream_files(spark, src, rows.schema)
        return {r.k: r.total for r in flows.running_totals(stream, ["k"], {"total": F.sum("v")}, out, progress).collect()}

    rows.where("v < 50").write.mode("append").parquet(src)
    first = run()
    assert run() == first  # nothing new: nothing counted twice
    rows.where("v >= 50").write.mode("append").parquet(src)
    assert run() == {k: sum(v for v in range(100) if v % 3 == k) for k in range(3)}


def test_totals_are_folded_and_old_batches_not_read_again(spark):
    src, out, progress = (session.scratch(spark, n) for n in ("src", "out", "progress"))
    rows = spark.range(90).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    totals = {"n": F.count(F.lit(1)), "total": F.sum("v")}

    def run(part):
        rows.where(part).write.mode("append").parquet(src)
        return flows.running_totals(flows.stream_files(spark, src, rows.schema), ["k"], totals, out, progress)

    assert {r.k: r.n for r in run("v < 30").collect()} == {None: 10, 1: 10, 2: 10}
    (Path(out) / "batch=0" / "part-9.parquet").write_bytes(b"not a table: a run that reads this batch again fails")
    (Path(f"{out}-totals") / "upto=7").mkdir()  # a fold that died before its end
    # only one key moves in the second run; the others come from the folded table
    assert {r.k: (r.n, r.total) for r in run("v >= 30 and v % 3 = 1").collect()} == {
        None: (10, sum(range(0, 30, 3))), 1: (30, sum(range(1, 90, 3))), 2: (10, sum(range(2, 30, 3)))
    }
    last = run("v >= 30 and v % 3 <> 1")
    assert {r.k: (r.n, r.total) for r in last.collect()} == {k or None: (30, sum(range(k, 90, 3))) for k in range(3)}
    assert flows.folded_totals(spark, out, ["k"], list(totals)).inputFiles() == last.inputFiles()


def test_landed_files_are_small_and_complete(spark):
    src, out, progress = (session.scratch(spark, n) for n in ("src", "out", "progress"))
    rows = spark.range(1000)
    rows.repartition(2).write.parquet(src)
    flows.land(flows.stream_files(spark, src, rows.schema), out, progress, flush_rows=100)
    landed = scans.csv_positional(spark, out).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    assert landed.agg(F.sum("n"), F.max("n")).first()[:] == (1000, 100)


@pytest.mark.parametrize("values", [3, 3 * sinks.WRITERS])
def test_partitioned_writes_hold_no_sorted_task(spark, values):
    """A task with few values writes its rows as they come; with many it still writes all of them, one file a value."""
    path = session.scratch(spark, "parts")
    df = spark.range(3000).select("id", F.when(F.col("id") % values > 0, F.col("id") % values).alias("p"))
    sinks.partitioned(df, path, "p")
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsList().size())]
    write = [x for x in plans if path in x and "InsertIntoHadoopFsRelationCommand" in x]
    assert write and "Sort" not in write[-1] and spark.conf.get(sinks._WRITERS) == "0"
    back = spark.read.parquet(path)
    assert sorted(back.collect(), key=lambda r: r.id) == df.orderBy("id").collect()
    assert len(set(back.inputFiles())) == len(back.inputFiles()) and back.select("p").distinct().count() == values


def test_partition_overwrite_leaves_the_rest(spark):
    path = session.scratch(spark, "parts")
    df = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    sinks.partitioned(df, path, "p")
    sinks.overwrite_partitions(spark.createDataFrame([(99, 1)], "id long, p long"), path, "p")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8, 99]


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_named_folder_is_used(spark):
    assert session.scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_an_unreadable_image_is_listed_without_a_size(spark):
    folder = scratch(spark, "images")
    content = spark.createDataFrame([("a.bmp", bytearray(objects.gray_bitmap(4, 2, [0] * 8))), ("b.bmp", bytearray(b"no image"))], "name string, content binary")
    objects.write_objects(content, folder).collect()
    got = {r.origin.rsplit("/", 1)[1]: (r.width, r.height) for r in objects.scan_images(spark, folder).collect()}
    assert got == {"a.bmp": (4, 2), "b.bmp": (None, None)}


def test_long_names_are_not_cut(spark):
    long = "x" * 1500
    commits = spark.createDataFrame([("c", {f"source.{long}": "s"})], "commit_id string, metadata map<string,string>")
    assert lineage.lineage_edges(commits).first().kind == long
    assert lineage.upstream(spark.createDataFrame([("b", "a")], "source string, target string"), spark.createDataFrame([("a",)], "node string")).count() == 2


def test_upstream_follows_any_depth(spark):
    depth = 104
    edges = spark.range(depth).select((F.col("id") + 1).alias("source"), F.col("id").alias("target")).coalesce(1)
    got = lineage.upstream(edges, spark.createDataFrame([(0,)], "node long"))
    assert got.count() == depth + 1 and got.agg(F.max("hops")).first()[0] == depth
