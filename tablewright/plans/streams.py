"""Registered queries: streaming. The streams read files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.plans.aggregation import WORDS_SQL
from tablewright.plans.registry import query
from tablewright.sources.scans import csv_positional
from tablewright.sources.snapshots import SnapshotStore
from tablewright.streaming import flows

FILE_ROWS = 1_000_000  # rows per arriving file at most; the scan decides how many tasks write them
_COLS = ["event_id", "user_id", "event_type", "value"]


def _totals():
    return {"n": F.count(F.lit(1)), "total": F.sum("value")}


@query("stream_sum_by", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    arrivals = t.scratch("arrivals")
    rows = t.events.select(*_COLS)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(arrivals)
    stream = flows.stream_files(t.spark, arrivals, rows.schema)
    state = flows.running_totals(stream, ["event_type"], _totals(), t.scratch("totals"), t.scratch("progress"))
    return state.withColumn("total", F.round("total", 2))


@query(
    "stream_matches_batch",
    """SELECT user_id, count(*) AS n_stream, count(*) AS n_batch, round(sum(value), 2) AS total_stream, round(sum(value), 2) AS total_batch
    FROM events GROUP BY 1""",
)
def _(t):
    arrivals, out, progress = t.scratch("arrivals"), t.scratch("totals"), t.scratch("progress")
    rows = t.events.select(*_COLS)
    state = None
    for half in (0, 1):  # the second half arrives after the first run has finished
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").parquet(arrivals)
        stream = flows.stream_files(t.spark, arrivals, rows.schema)
        state = flows.running_totals(stream, ["user_id"], _totals(), out, progress)
    batch = t.spark.read.parquet(arrivals).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_batch"), F.round(F.sum("value"), 2).alias("total_batch")
    )
    streamed = state.select("user_id", F.col("n").alias("n_stream"), F.round("total", 2).alias("total_stream"))
    return streamed.join(batch, "user_id", "full_outer")


def _landed(t, flush_rows: int) -> str:
    arrivals, out = t.scratch("arrivals"), t.scratch("landed")
    rows = t.events.select(*_COLS)
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(arrivals)
    flows.land(flows.stream_files(t.spark, arrivals, rows.schema), out, t.scratch("progress"), flush_rows)
    return out


@query("stream_land", "SELECT count(*) AS n_rows, true AS small_files, CAST(sum(event_id) AS BIGINT) AS ids FROM events")
def _(t):
    landed = csv_positional(t.spark, _landed(t, 1000))
    files = landed.select("_metadata.file_path", F.col("_c0").cast("bigint").alias("id")).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")
    )
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 1000).alias("small_files"), F.sum("ids").alias("ids"))


@query("stream_ingest_publish", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    landed = csv_positional(t.spark, _landed(t, 1000)).select(
        F.col("_c0").cast("bigint").alias("event_id"), F.col("_c1").cast("bigint").alias("user_id"),
        F.col("_c2").alias("event_type"), F.col("_c3").cast("double").alias("value"),
    )
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "events", landed.limit(0), "empty table")
    store.create_branch("ingest", "main")
    store.append("ingest", "events", landed, "ingest landed files")
    store.merge("ingest", "main")
    return store.read("events", "main")


@query("stream_word_count", WORDS_SQL)
def _(t):
    folder = t.scratch("lines")
    t.documents.select("text").write.option("lineSep", "\n").text(folder)
    return flows.streaming_word_count(t.spark, folder, t.scratch("words"), t.scratch("progress"))
