"""Keep an index of text chunks in step with a versioned table: work follows the change, not the table.

Data folders of the store never change, so what is known about one is written once, beside it: a digest of every text
and of every chunk. A new version is compared with an old one through the digests of the folders that they do not
share; texts are read only in folders that the new version adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import chunks
from tablewright.sources.snapshots import SnapshotStore


def _finished(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder ended: Spark marks that, so a folder left half written is made anew."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


class ChunkIndex:
    """Digests of one table's texts and of their chunks of ``size`` characters that overlap by ``overlap``."""

    def __init__(self, store: SnapshotStore, table: str, key: str, text: str = "text", size: int = 1000, overlap: int = 100):
        self.store, self.table, self.key, self.text, self.size, self.overlap = store, table, key, text, size, overlap
        self.made: list[str] = []  # digest folders that this object had to write

    def _folder(self, data: str) -> str:
        return f"{self.store.root}/{self.table}_digests/{self.text}-{self.size}-{self.overlap}/{data.rsplit('/', 1)[-1]}"

    def cut(self, docs: DataFrame) -> DataFrame:
        """``(key, chunk_no, chunk)``; null and empty texts have no chunk."""
        return chunks.fixed_chunks(docs, self.key, self.text, self.size, self.overlap)

    def digests(self, folders: list[str], like: str) -> DataFrame:
        """``(key, digest, parts)`` of the documents in these data folders; folders seen before are not opened.

        ``like`` is any data folder of the table. ``parts`` holds a digest per chunk. A null text has a digest of its own, unlike that of an empty one.
        """
        spark = self.store.spark
        for data in folders:
            target = self._folder(data)
            if not _finished(spark, target):
                self._digest(spark.read.parquet(data)).write.mode("overwrite").parquet(target)
                self.made.append(target)
        if not folders:  # no row, but the columns of the table
            return self._digest(spark.read.parquet(like)).limit(0)
        return spark.read.parquet(*[self._folder(f) for f in folders])

    def _digest(self, docs: DataFrame) -> DataFrame:
        """Chunks are cut and hashed row by row: nothing is exploded or shuffled."""
        text, step = F.col(self.text), self.size - self.overlap
        last = F.greatest(F.ceil((F.length(text) - self.size) / F.lit(step)), F.lit(0)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.substring(text, i * step + 1, F.lit(self.size))))
        return docs.select(
            self.key, F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"),
            F.when(F.length(text) > 0, parts).otherwise(F.array().cast("array<bigint>")).alias("parts"),
        )

    def folders(self, old: str | None, new: str) -> tuple[list[str], list[str]]:
        """Data folders that only the old version has, and those that only the new one has."""
        before = self.store.tables(old).get(self.table, []) if old else []
        after = self.store.tables(new).get(self.table, [])
        return [p for p in before if p not in after], [p for p in after if p not in before]

    def changed_documents(self, old: str | None, new: str) -> DataFrame:
        """``(key, change, _old, _new)``: added, changed and removed documents with the digests of their chunks.

        A document that moved to another folder with an equal text is not a change. Keys are unique in a version.
        """
        gone, come = self.folders(old, new)
        like = (come + gone + self.store.tables(new)[self.table])[0]
        a = self.digests(gone, like).select(self.key, F.struct("digest", "parts").alias("_old"))
        b = self.digests(come, like).select(self.key, F.struct("digest", "parts").alias("_new"))
        change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
        both = a.join(b, self.key, "full_outer").where(~F.col("_old.digest").eqNullSafe(F.col("_new.digest")))
        return both.select(self.key, change.alias("change"), F.col("_old.parts").alias("_old"), F.col("_new.parts").alias("_new"))

    def updates(self, old: str | None, new: str) -> DataFrame:
        """``(key, chunk_no, op, chunk)``: what an index of chunks must take in (``upsert``) or drop (``delete``).

        Chunks of changed documents whose own text is as before are left out. With ``old`` None the whole version is new.
        """
        empty = F.array().cast("array<bigint>")
        was, now = F.coalesce("_old", empty), F.coalesce("_new", empty)
        longest = F.greatest(F.size(was), F.size(now))
        places = F.when(longest > 0, F.sequence(F.lit(1), longest))
        numbered = self.changed_documents(old, new).select(self.key, was.alias("a"), now.alias("b"), F.explode(places).alias("i"))
        at = lambda c: F.try_element_at(c, F.col("i"))
        moved = numbered.where(~at("a").eqNullSafe(at("b"))).select(
            self.key, (F.col("i") - 1).cast("bigint").alias("chunk_no"), F.when(at("b").isNull(), "delete").otherwise("upsert").alias("op")
        )
        _, come = self.folders(old, new)
        if not come:
            return moved.withColumn("chunk", F.lit(None).cast("string"))
        texts = self.store.spark.read.option("mergeSchema", len(come) > 1).parquet(*come).select(self.key, self.text)
        wanted = texts.join(moved.where("op = 'upsert'").select(self.key).distinct(), self.key, "left_semi")
        return moved.join(self.cut(wanted), [self.key, "chunk_no"], "left").select(self.key, "chunk_no", "op", "chunk")


def apply_updates(index: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The index ``(key, chunk_no, chunk)`` after the updates."""
    kept = index.join(updates.select(key, "chunk_no"), [key, "chunk_no"], "left_anti")
    return kept.unionByName(updates.where("op = 'upsert'").select(key, "chunk_no", "chunk"))
