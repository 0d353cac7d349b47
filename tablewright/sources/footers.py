"""Parquet footers as rows: what every single file says about itself, read where Spark puts the tasks.

A DataFrame over several files has one schema, mostly that of one of them. Gates must know each file's own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTER = "path string, n_rows long, position int, column string, type string"
# Stores that Arrow opens by itself, reading the tail of a file only; files elsewhere are read through Spark.
DIRECT = ("file", "s3", "s3a", "gs", "gcs", "hdfs")


def data_files(spark: SparkSession, folders: list[str], glob: str = "*.parquet") -> DataFrame:
    """``(path, size_bytes)`` of the files below the folders; lists, opens nothing."""
    if not folders:
        return spark.createDataFrame([], "path string, size_bytes long")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.load(folders).select("path", F.col("length").alias("size_bytes"))


def _columns(source) -> tuple[int, list[tuple[str, str]]]:
    """(rows, [(column, type)]) of one file: Spark's own note of the schema if there is one, else the file's."""
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema
    from pyspark.sql.types import StructType

    footer = pq.read_metadata(source)
    note = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    schema = StructType.fromJson(json.loads(note)) if note else from_arrow_schema(footer.schema.to_arrow_schema(), prefer_timestamp_ntz=True)
    return footer.num_rows, [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _open(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if rest else path)
    host, _, inside = rest.lstrip("/").partition("/")
    store, _ = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{host}/")
    return store.open_input_file(f"/{inside}" if scheme == "hdfs" else f"{host}/{inside}")


def _rows(path: str, source) -> pa.RecordBatch:
    n, columns = _columns(source)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(columns)), pa.array([n] * len(columns), pa.int64()), pa.array(range(len(columns)), pa.int32()),
         pa.array([c for c, _ in columns], pa.string()), pa.array([t for _, t in columns], pa.string())],
        names=["path", "n_rows", "position", "column", "type"],
    )


def footers(files: DataFrame) -> DataFrame:
    """``(path, n_rows, position, column, type)``: the columns of every file in ``files`` (``path``), in file order.

    Files are dealt to tasks, several to each, and only their footers are read. A file that cannot be read fails the
    job: a gate must not pass what it has not seen. Nested columns are one row with their whole type.
    """
    spark = files.sparkSession
    scheme = F.when(F.col("path").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lower(F.substring_index("path", ":", 1))).otherwise("file")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path) as source:
                    yield _rows(path, source)

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _rows(path, pa.BufferReader(content))

    # A number given, so that adaptive execution does not put the short paths back into one task.
    dealt = files.where(scheme.isin(*DIRECT)).select("path").repartition(spark.sparkContext.defaultParallelism * 4, "path")
    out = dealt.mapInArrow(near, FOOTER)
    others = [r["path"] for r in files.where(~scheme.isin(*DIRECT)).select("path").toLocalIterator()]  # names, as for any scan
    if others:
        out = out.unionByName(spark.read.format("binaryFile").load(others).select("path", "content").mapInArrow(far, FOOTER))
    return out
