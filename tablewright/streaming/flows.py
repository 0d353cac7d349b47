"""Structured Streaming flows: running totals, landing, word counts.

Each flow runs with ``availableNow`` over whatever has arrived and can be called again with the same
folders to continue. Batches are written under their batch id, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators import aggregates


def stream_files(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A folder as a stream of the files that arrive in it. Swap in another source by passing its frame instead."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_now(stream: DataFrame, out: str, checkpoint: str, mode: str, write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Drain the stream; batch n goes to ``out/batch=n``."""

    def put(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/batch={batch_id}"
        if write:
            write(batch, path)
        else:
            batch.write.mode("overwrite").parquet(path)

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
    )
    query.awaitTermination()


def running_totals(stream: DataFrame, keys: list[str], totals: dict[str, Column], out: str, checkpoint: str) -> DataFrame:
    """Totals per key over everything streamed so far.

    Every batch writes the keys it changed, so it is as large as its input. After each run the new batches are
    folded into a table of totals; see ``folded_totals``.
    """
    run_now(stream.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()]), out, checkpoint, "update")
    return folded_totals(stream.sparkSession, out, keys, list(totals))


def _numbered(spark: SparkSession, folder: str, label: str) -> list[int]:
    """Numbers n of the finished sub-folders ``label=n``; a write that stopped half-way leaves no ``_SUCCESS``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    done = fs.globStatus(at(f"{folder}/{label}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=", 1)[1]) for s in done)


def folded_totals(spark: SparkSession, out: str, keys: list[str], names: list[str]) -> DataFrame:
    """Totals as of the last batch, kept as ``<out>-totals/upto=n``: one row per key, all batches up to n folded in.

    A call reads the newest such table and the batches after it, writes the next one, and never looks at older
    batches again. Tables are only added: a call that dies half-way leaves the one before in force. With nothing
    new, no table is written.
    """
    folded = f"{out}-totals"
    upto = max(_numbered(spark, folded, "upto"), default=None)
    new = [n for n in _numbered(spark, out, "batch") if upto is None or n > upto]
    if not new:
        if upto is None:
            raise ValueError(f"no batch in {out}")
        return spark.read.parquet(f"{folded}/upto={upto}")
    changes = spark.read.option("basePath", out).parquet(*[f"{out}/batch={n}" for n in new])
    state = changes.select(*keys, F.struct(F.col("batch").cast("bigint").alias("batch"), *names).alias("_t"))
    if upto is not None:
        before = spark.read.parquet(f"{folded}/upto={upto}")
        state = state.unionByName(before.select(*keys, F.struct(F.lit(upto).cast("bigint").alias("batch"), *names).alias("_t")))
    newest = state.groupBy(*keys).agg(F.max_by("_t", "_t.batch").alias("_t"))
    path = f"{folded}/upto={new[-1]}"
    newest.select(*keys, *[f"_t.{n}" for n in names]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def land(stream: DataFrame, out: str, checkpoint: str, flush_rows: int = 100, fmt: str = "csv") -> None:
    """Land a stream as files of at most ``flush_rows`` records each."""

    def write(batch: DataFrame, path: str) -> None:
        batch.write.mode("overwrite").option("maxRecordsPerFile", flush_rows).format(fmt).save(path)

    run_now(stream, out, checkpoint, "append", write)


def streaming_word_count(spark: SparkSession, folder: str, out: str, checkpoint: str) -> DataFrame:
    lines = spark.readStream.option("lineSep", "\n").text(folder)
    run_now(aggregates.word_count(lines, "value"), out, checkpoint, "update")
    return folded_totals(spark, out, ["word"], ["n"])
