"""Branches, commits and tags over plain Parquet folders.

A snapshot is a list of immutable folders; a commit maps each table to such a list; a ref names a
commit. Events are rows of one log, so the history, the ref list and the file listing are ordinary
DataFrames. Only ref resolution (one row) passes through the driver.

Publishing checks that the branch still points where the writer started. On a plain file system
that check and the write that follows are two steps, so two writers can still race.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.sources import footers

# One row per event; it holds the whole state of its ref afterwards, so resolving a ref is one lookup.
LOG_SCHEMA = (
    "kind string, ref string, commit_id string, parents array<string>, message string, committer string, "
    "metadata map<string,string>, created_at timestamp, version long, tables map<string,array<string>>, base string, seq long"
)


class RefError(ValueError):
    """Unknown ref, moved branch head or a tag that already exists."""


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._seq = 0

    # -- the log ------------------------------------------------------------------------
    def _log(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log")

    def _append(self, kind: str, ref: str, **state) -> None:
        """Add one event; written as a literal, so no Python worker and one small file."""
        self._seq = max(self._seq + 1, time.time_ns())
        now = datetime.now(timezone.utc).isoformat()
        row = json.dumps({"created_at": now, **state, "kind": kind, "ref": ref, "seq": self._seq})
        one = self.spark.range(1).select(F.inline(F.array(F.from_json(F.lit(row), LOG_SCHEMA))))
        one.coalesce(1).write.mode("append").parquet(f"{self.root}/_log")

    def commits(self) -> DataFrame:
        return self._log().where("kind = 'commit'").select(
            "commit_id", "parents", F.col("ref").alias("branch"), "message", "committer", "metadata", "created_at", "version", "tables"
        )

    def refs(self) -> DataFrame:
        """Live refs: the last event of each name, unless that event drops it."""
        last = self._log().groupBy("ref").agg(F.max(F.struct("seq", "kind", "commit_id", "base")).alias("r"))
        kind = F.when(F.col("r.kind") == "tag", "tag").otherwise("branch").alias("kind")
        return last.where("r.kind <> 'drop'").select("ref", kind, "r.commit_id", "r.base")

    # -- refs ---------------------------------------------------------------------------
    def _ref(self, name: str) -> dict | None:
        """The last event of one ref, or None: a filtered scan and a top-1."""
        try:
            log = self._log()
        except AnalysisException:  # no such folder yet: the first commit creates it
            return None
        found = log.where(F.col("ref") == name).orderBy(F.desc("seq")).take(1)
        return found[0].asDict(recursive=True) if found and found[0]["kind"] != "drop" else None

    def _resolve(self, ref: str) -> dict:
        """The state behind a branch, tag or commit id."""
        entry = self._ref(ref)
        if entry is None:
            found = self._log().where((F.col("commit_id") == ref) & (F.col("kind") == "commit")).take(1)
            if not found:
                raise RefError(f"unknown ref {ref}")
            entry = found[0].asDict(recursive=True)
        return entry

    def _state(self, entry: dict) -> dict:
        return {k: entry[k] for k in ("commit_id", "parents", "version", "tables", "base")}

    def head(self, ref: str) -> str:
        """Commit id of a branch, tag or commit."""
        return self._resolve(ref)["commit_id"]

    def create_branch(self, name: str, source: str) -> None:
        """No data moves: one more name for the same commit."""
        if self._ref(name):
            raise RefError(f"ref {name} exists")
        start = self._state(self._resolve(source))
        self._append("branch", name, **start | {"base": start["commit_id"]})

    def tag(self, name: str, ref: str) -> None:
        """Tags never move."""
        if self._ref(name):
            raise RefError(f"ref {name} exists")
        self._append("tag", name, **self._state(self._resolve(ref)))

    def drop(self, name: str) -> None:
        self._append("drop", name, commit_id=self.head(name))

    # -- data ---------------------------------------------------------------------------
    def write(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> str:
        """Write one immutable folder; nothing refers to it until a commit does."""
        path = f"{self.root}/{table}/{uuid.uuid4().hex[:12]}"
        if partition_by:  # each partition value in as few tasks as its bytes need
            df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
        else:
            df.write.parquet(path)
        return path

    def tables(self, ref: str) -> dict[str, list[str]]:
        return dict(self._resolve(ref)["tables"])

    def commit(
        self,
        branch: str,
        message: str,
        tables: dict[str, list[str]],
        *,
        metadata: dict[str, str] | None = None,
        committer: str = "",
        parents: list[str] | None = None,
        expected_head: str | None = None,
    ) -> str:
        """Record a commit whose listed tables change; all other tables stay as at the branch head."""
        entry = self._ref(branch)
        head = entry["commit_id"] if entry else None
        if expected_head is not None and head != expected_head:
            raise RefError(f"{branch} moved to {head}, expected {expected_head}")
        if entry and entry["kind"] == "tag":
            raise RefError(f"{branch} is a tag")
        version = entry["version"] + 1 if entry else 0
        content = {t: p for t, p in {**(entry["tables"] if entry else {}), **tables}.items() if p}
        chain = parents if parents is not None else ([head] if head else [])
        text = json.dumps([branch, message, chain, content, version], sort_keys=True)
        commit_id = hashlib.sha256(text.encode()).hexdigest()
        self._append(
            "commit", branch, commit_id=commit_id, parents=chain, message=message, committer=committer,
            metadata=metadata or {}, version=version, tables=content, base=entry["base"] if entry else None,
        )
        return commit_id

    def overwrite(self, branch: str, table: str, df: DataFrame, message: str = "overwrite", **kw) -> str:
        return self.commit(branch, message, {table: [self.write(df, table, kw.pop("partition_by", ()))]}, **kw)

    def append(self, branch: str, table: str, df: DataFrame, message: str = "append", **kw) -> str:
        """Refused if the branch moves while the rows are written: the list they extend would be out of date."""
        start = self._resolve(branch)
        old = dict(start["tables"]).get(table, [])
        kw.setdefault("expected_head", start["commit_id"])
        return self.commit(branch, message, {table: old + [self.write(df, table)]}, **kw)

    def write_partitions(self, df: DataFrame, table: str, columns: list[str]) -> list[str]:
        """Write one immutable folder per combination of the columns' values; the folders, named by a digest of them.

        The columns stay in the files, so types, nulls and empty texts come back as they were.
        """
        values = [F.col(c).cast("string") for c in columns]
        digest = F.md5(F.concat(*[F.coalesce(F.concat(F.length(v), F.lit("="), v), F.lit("-")) for v in values]))
        path = f"{self._by(table, columns)}{uuid.uuid4().hex[:12]}"
        df.withColumn("tw_part", digest).hint("rebalance", "tw_part").write.partitionBy("tw_part").parquet(path)
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        listed = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).listStatus(folder)
        names = [f.getPath().getName() for f in listed if f.isDirectory()]
        return [f"{path}/{name}" for name in sorted(names) if name.startswith("tw_part=")]

    def _by(self, table: str, columns: list[str]) -> str:
        return f"{self.root}/{table}/by-{hashlib.md5(json.dumps(columns).encode()).hexdigest()[:12]}-"

    def replace_partitions(self, branch: str, table: str, df: DataFrame, columns: list[str], message: str = "replace partitions", **kw) -> str:
        """A commit in which the partitions that occur in ``df`` hold its rows only; all others keep their folders.

        Nothing is overwritten: the old version stays readable, and a write that fails leaves folders no commit names.
        The first call makes the table. A table made in another way, or by other columns, is refused, and so is a
        branch that moved meanwhile. The list of folders grows with the number of partitions, not with the rows.
        """
        entry = self._ref(branch)
        old = dict(entry["tables"]).get(table, []) if entry else []
        if any(not p.startswith(self._by(table, columns)) for p in old):
            raise RefError(f"{table} is not partitioned by {columns}")
        new = self.write_partitions(df, table, columns)
        part = lambda p: p.rsplit("/", 1)[1]
        touched = {part(p) for p in new}
        if entry:
            kw.setdefault("expected_head", entry["commit_id"])
        return self.commit(branch, message, {table: [p for p in old if part(p) not in touched] + new}, **kw)

    def _read(self, paths: list[str]) -> DataFrame:
        """Folders written at different times may differ in their columns: the table has all of them, null where a
        folder lacks one. Columns whose types cannot be united are refused."""
        return self.spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)

    def read(self, table: str, ref: str, merge_schema: bool = False) -> DataFrame:
        """The table at a branch, tag or commit, with the columns of all its folders.

        ``merge_schema`` also unites folders whose columns changed their type, as ``unionByName`` does.
        """
        return self._load(table, ref, self.tables(ref), merge_schema)

    def _load(self, table: str, at: str, tables: dict[str, list[str]], merge_schema: bool = False) -> DataFrame:
        paths = tables.get(table)
        if not paths:
            raise RefError(f"no table {table} at {at}")
        if not merge_schema:
            return self._read(paths)
        parts = [self.spark.read.parquet(p) for p in paths]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    def read_version(self, table: str, branch: str, version: int) -> DataFrame:
        """Time travel by number: versions of a branch count from 0."""
        found = self.commits().where((F.col("branch") == branch) & (F.col("version") == version)).select("tables").take(1)
        if not found:
            raise RefError(f"{branch} has no version {version}")
        return self._load(table, f"{branch} version {version}", found[0]["tables"])

    def changed(self, table: str, old: str, new: str) -> tuple[DataFrame | None, DataFrame | None]:
        """The table at two refs, reduced to the folders the refs do not share (None if there are none).

        Shared folders hold equal rows on both sides, so a comparison need not open them.
        """
        a, b = self.tables(old).get(table, []), self.tables(new).get(table, [])
        left, right = [p for p in a if p not in set(b)], [p for p in b if p not in set(a)]
        return (self._read(left) if left else None), (self._read(right) if right else None)

    def changed_files(self, table: str, old: str, new: str) -> DataFrame:
        """``(path, size_bytes)`` of the files that ``new`` has and ``old`` has not; lists, opens nothing."""
        known = set(self.tables(old).get(table, []))
        return footers.data_files(self.spark, [p for p in self.tables(new).get(table, []) if p not in known])

    # -- whole-ref operations -----------------------------------------------------------
    def merge(self, source: str, target: str, message: str | None = None, **kw) -> str:
        """Promote every table that changed on ``source`` since it left ``target``, in one commit.

        Tables changed on both sides need a row-level merge first and are refused here.
        """
        branch, into = self._ref(source), self._resolve(target)
        if branch is None or branch["base"] is None:
            raise RefError(f"{source} is not a branch made from another ref")
        ours, theirs, base = into["tables"], branch["tables"], self.tables(branch["base"])
        moved = {t: theirs.get(t, []) for t in {*theirs, *base} if theirs.get(t) != base.get(t)}
        clash = sorted(t for t in moved if ours.get(t) != base.get(t) and ours.get(t) != theirs.get(t))
        if clash:
            raise RefError(f"tables changed on both sides: {clash}")
        merged = self.commit(
            target, message or f"merge {source}", moved,
            parents=[into["commit_id"], branch["commit_id"]], expected_head=into["commit_id"], **kw,
        )
        # the next merge of this branch starts from here
        self._append("branch", source, **self._state(branch) | {"base": branch["commit_id"]})
        return merged

    def revert(self, branch: str, parent_number: int = 1) -> str:
        """A new commit whose tables equal the chosen parent of the head; history is kept."""
        row = self._resolve(branch)
        head, parents, now = row["commit_id"], row["parents"], row["tables"]
        old = self.tables(parents[parent_number - 1])
        return self.commit(branch, f"revert {head[:12]}", {t: old.get(t, []) for t in {*old, *now}}, expected_head=head)

    def files(self, ref: str) -> DataFrame:
        """Data files behind a ref: table, folder, file, size. Lists folders, reads no data page."""
        out = None
        for table, paths in sorted(self.tables(ref).items()):
            part = (
                self._read(paths)
                .select(F.lit(table).alias("table"), "_metadata.file_path", "_metadata.file_size")
                .groupBy("table", "file_path", "file_size").agg(F.count(F.lit(1)).alias("n_rows"))
            )
            out = part if out is None else out.unionByName(part)
        return out

    def clone(self, root: str) -> SnapshotStore:
        """Copy the log of commits and refs to a new root; data folders are shared, not copied."""
        other = SnapshotStore(self.spark, root)
        self._log().write.parquet(f"{other.root}/_log")
        return other
