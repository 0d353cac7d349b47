"""Three-way merge of a versioned table whose work follows the change, not the table.

Folders that all three versions share hold equal rows and are passed on by name. Of every other folder a digest per
range of keys is stored beside it, once, as folders never change. Ranges whose digests agree in all versions
are passed on row by row; only rows of ranges that differ are shuffled and compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators import merge
from tablewright.operators.reindex import _finished
from tablewright.session import persist_to_shared
from tablewright.sources.snapshots import SnapshotStore

RANGES = 4096  # of hashed keys; a list of those that differ is broadcast
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class MergeConflict(Exception):
    """Keys changed differently on both sides."""


class RefMerge:
    """``table`` at ``base``, ``ours`` and ``theirs`` (branches, tags or commits).

    Keys are unique in every version; a repeated key fails the job if its range differs. A column that a folder lacks
    is null there. Rows are compared as JSON through two 64-bit hashes a row, combined by xor with a row count.
    """

    def __init__(self, store: SnapshotStore, table: str, key: list[str], base: str, ours: str, theirs: str, ranges: int = RANGES):
        self.store, self.table, self.key, self.ranges = store, table, key, ranges
        self.heads = {"base": store.head(base), "ours": store.head(ours), "theirs": store.head(theirs)}
        folders = {side: store.tables(commit).get(table, []) for side, commit in self.heads.items()}
        self.shared = [p for p in folders["ours"] if p in folders["base"] and p in folders["theirs"]]
        self.own = {side: [p for p in paths if p not in self.shared] for side, paths in folders.items()}
        every = sorted({p for paths in folders.values() for p in paths})
        if not every:
            raise ValueError(f"no table {table} in these versions")
        self.schema = store.spark.read.option("mergeSchema", True).parquet(*every).schema
        self.made: list[str] = []  # digest folders that this object had to write

    def _frame(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.store.spark.createDataFrame([], self.schema)
        return self.store.spark.read.schema(self.schema).parquet(*folders)

    def _range(self) -> Column:
        return F.pmod(F.xxhash64(F.to_json(F.struct(*self.key), _EXACT)), F.lit(self.ranges)).alias("_range")

    def _digest(self, folder: str) -> DataFrame:
        """``(_range, n, a, b)`` of one data folder, at most a row per range; columns by name, nulls left out."""
        rows = self.store.spark.read.parquet(folder)
        text = F.to_json(F.struct(*sorted(rows.columns)), _EXACT)
        hashed = rows.select(self._range(), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
        return hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))

    def digests(self, folders: list[str]) -> DataFrame:
        """Digests of a set of folders; folders seen before are not opened."""
        spark, kept = self.store.spark, f"{self.store.root}/{self.table}_ranges/{'-'.join(self.key)}-{self.ranges}"
        paths = [f"{kept}/{f.rsplit('/', 1)[-1]}" for f in folders]
        for folder, path in zip(folders, paths):
            if not _finished(spark, path):
                self._digest(folder).write.mode("overwrite").parquet(path)
                self.made.append(path)
        if not paths:
            return spark.createDataFrame([], "_range bigint, n bigint, a bigint, b bigint")
        return spark.read.parquet(*paths).groupBy("_range").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))

    def differing(self) -> DataFrame:
        """``_range`` of the ranges that are not equal in all three versions, outside the shared folders."""
        sides = None
        for side, folders in self.own.items():
            one = self.digests(folders).withColumn("side", F.lit(side))
            sides = one if sides is None else sides.unionByName(one)
        alike = sides.groupBy("_range").agg(F.count(F.lit(1)).alias("on"), F.count_distinct("n", "a", "b").alias("kinds"))
        return alike.where("on < 3 OR kinds > 1").select("_range")

    def moved(self, prefer: str | None = None) -> DataFrame:
        """Merged rows outside the shared folders, with their ``status`` (see ``merge_three_way``)."""
        if not any(self.own.values()):
            return self._frame([]).withColumn("status", F.lit("unchanged"))
        differing = F.broadcast(persist_to_shared(self.differing(), "ranges"))  # at most ``ranges`` numbers
        sides = {s: self._frame(f).withColumn("_range", self._range()) for s, f in self.own.items()}
        base, ours, theirs = (sides[s].join(differing, "_range", "left_semi").drop("_range") for s in ("base", "ours", "theirs"))
        merged = merge.merge_three_way(base, ours, theirs, self.key, prefer)
        rest = sides["ours"].join(differing, "_range", "left_anti").drop("_range")
        return merged.unionByName(rest.withColumn("status", F.lit("unchanged")))

    def rows(self, prefer: str | None = None) -> DataFrame:
        """The whole merged table with ``status``, as ``merge_three_way`` gives it for the three frames."""
        return self.moved(prefer).unionByName(self._frame(self.shared).withColumn("status", F.lit("unchanged")))

    def commit(self, branch: str, message: str, prefer: str | None = None) -> str:
        """Commit the merge to ``branch``, which must still be at ``ours``: shared folders by name and one new folder.

        Nothing is committed if keys are in conflict and ``prefer`` is not given.
        """
        rows = persist_to_shared(self.moved(prefer), "merged")
        clash = rows.where("status = 'conflict'").select(*self.key).take(5)
        if clash and prefer is None:
            raise MergeConflict(f"{self.table}: {clash}")
        new = [] if rows.isEmpty() else [self.store.write(rows.drop("status"), self.table)]
        return self.store.commit(
            branch, message, {self.table: self.shared + new},
            parents=[self.heads["ours"], self.heads["theirs"]], expected_head=self.heads["ours"],
        )
