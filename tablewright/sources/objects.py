"""Object listings, imports between prefixes and small binary objects."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import paths


def list_prefix(manifest: DataFrame, prefix: str = "", delimiter: str = "/") -> DataFrame:
    """One row per object or sub-folder right below ``prefix`` with object count and bytes."""
    return (
        manifest.where(F.col("path").startswith(prefix))
        .groupBy(paths.common_prefix(F.col("path"), prefix, delimiter).alias("entry"))
        .agg(F.count(F.lit(1)).alias("n_objects"), F.sum("size_bytes").alias("size_bytes"))
        .withColumn("path_type", F.when(F.col("entry").endswith(delimiter), "common_prefix").otherwise("object"))
    )


def import_prefixes(manifest: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Zero-copy import: objects below each source prefix appear below its destination, content untouched.

    With nested source prefixes the longest one wins, so each object is imported once.
    """
    target = F.lit(None).cast("string")
    for src in sorted(mapping, key=len):
        moved = F.concat(F.lit(mapping[src]), F.substr("path", F.lit(len(src) + 1)))
        target = F.when(F.col("path").startswith(src), moved).otherwise(target)
    return manifest.select(target.alias("path"), "checksum", "size_bytes", F.col("path").alias("source_path")).where(
        F.col("path").isNotNull()
    )


def read_files(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The table below ``root`` from the listed files (``path``) only. Names pass through the driver, as for any scan."""
    return spark.read.option("basePath", root).parquet(*[r["path"] for r in files.select("path").toLocalIterator()])


def import_by_label(manifest: DataFrame, label: str, replace: tuple[str, str]) -> DataFrame:
    """Objects whose folder is named ``label``, each with the path of its paired object."""
    folder = paths.parent(F.col("path"))
    return manifest.where(folder.endswith("/" + label)).select(
        "path", F.replace(F.col("path"), F.lit(replace[0]), F.lit(replace[1])).alias("paired_path"), "size_bytes"
    )


def usage(manifest: DataFrame, levels: int = 1) -> DataFrame:
    """Files and bytes per prefix of so many path levels."""
    return manifest.groupBy(F.substring_index("path", "/", levels).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("n_bytes")
    )


def gray_bitmap(width: int, height: int, values) -> bytes:
    """An uncompressed 24-bit bitmap, one value per pixel from the bottom row up."""
    pad = b"\0" * (-3 * width % 4)
    body = b"".join(
        b"".join(bytes([v, v, v]) for v in values[r * width : (r + 1) * width]) + pad for r in range(height)
    )
    header = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
    return header + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


def write_objects(objects: DataFrame, folder: str) -> DataFrame:
    """Write ``content`` of each row to ``folder/name`` from the tasks; returns name and size.

    Names are fixed by the rows, so a repeated task rewrites the same object.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        target.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                with target.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            yield pd.DataFrame({"name": batch["name"], "size_bytes": batch["content"].map(len)})

    return objects.select("name", "content").mapInPandas(put, "name string, size_bytes long")


def scan_binary(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Objects as path, length, modificationTime, content; select early, ``content`` is only read if used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """Origin, width and height of every file; both sizes are null where the file is no readable image."""
    size = lambda c: F.when(F.col(f"image.{c}") > 0, F.col(f"image.{c}")).alias(c)
    return spark.read.format("image").load(folder).select("image.origin", size("width"), size("height"))
