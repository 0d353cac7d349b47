"""Session settings and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every operator relies on. Shuffle parallelism and split sizes stay with
# whoever creates the session: they belong to the cluster, not to the library.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed joins even where that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablewright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-wh-"))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it: a cluster's executors do not share a
    machine-local temporary folder, so there the missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-tablewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, label: str = "work") -> str:
    """A fresh sub-folder of the shared folder; never reused, never cleared."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# What a finished step shuffled is dropped when its write ends, not when a collector gets round to it.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def persist_to_shared(df, label: str = "cut"):
    """Write a frame to the shared folder and read it back: cuts lineage, survives lost executors, frees its shuffles."""
    path = scratch(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES, None)
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_DROP_SHUFFLES) if before is None else conf.set(_DROP_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames) -> None:
    """Delete tables made by ``persist_to_shared`` that no frame still to be computed reads."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
