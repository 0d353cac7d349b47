"""What changed between two refs: objects, rows, schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.merge import keyed_sides
from tablewright.sources.snapshots import SnapshotStore


def diff_objects(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed objects of two listings (path, checksum, size_bytes); unchanged paths are left out."""
    a = old.select("path", F.col("checksum").alias("_a"), F.col("size_bytes").alias("_as"))
    b = new.select("path", F.col("checksum").alias("_b"), F.col("size_bytes").alias("_bs"))
    return (
        a.join(b, "path", "full_outer")
        .where(~F.col("_a").eqNullSafe(F.col("_b")))
        .select(
            "path",
            F.lit("object").alias("path_type"),
            F.coalesce("_bs", "_as").alias("size_bytes"),
            F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("type"),
        )
    )


def dirty_refs(head: DataFrame, staged: DataFrame) -> DataFrame:
    """Refs that hold uncommitted changes, with their number: all refs (column ``ref``) in one join."""
    a = head.select("ref", "path", F.col("checksum").alias("_a"))
    b = staged.select("ref", "path", F.col("checksum").alias("_b"))
    changed = a.join(b, ["ref", "path"], "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return changed.groupBy("ref").agg(F.count(F.lit(1)).alias("n_changes"))


def reset_prefixes(staged: DataFrame, head: DataFrame, prefixes: list[str]) -> DataFrame:
    """Staged listing with everything below the prefixes put back as at the head; map-only."""
    under = F.lit(False)
    for p in prefixes:
        under = under | F.col("path").startswith(p)
    return staged.where(~under).unionByName(head.where(under))


def move_prefix(manifest: DataFrame, old: str, new: str) -> DataFrame:
    """A listing cloned to another root: paths below ``old`` are rewritten, content is shared."""
    moved = F.concat(F.lit(new), F.substr("path", F.lit(len(old) + 1)))
    return manifest.withColumn("path", F.when(F.col("path").startswith(old), moved).otherwise(F.col("path")))


def diff_rows(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keyed row diff: key, change type and the names of the changed columns.

    Keys and values compare null-safe; a key that one side has twice fails the job.
    """
    values = [c for c in old.columns if c not in key and c in new.columns]
    changed = F.array_compact(
        F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in values])
    )
    return (
        keyed_sides({"_a": old, "_b": new}, key, values)
        .where(~F.col("_a").eqNullSafe(F.col("_b")))
        .select(
            *key,
            F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed").alias("change"),
            F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.array_join(changed, ","))
            .otherwise(F.lit("")).alias("changed_columns"),
        )
    )


def diff_refs(store: SnapshotStore, table: str, old: str, new: str, key: list[str]) -> DataFrame:
    """Row diff of a table between two refs that reads only folders the refs do not share: work follows the change."""
    a, b = store.changed(table, old, new)
    empty = store.read(table, new if b is not None else old).limit(0)
    return diff_rows(a if a is not None else empty, b if b is not None else empty, key)


def changes(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The change set from ``old`` to ``new``: key, ``op`` (upsert / delete) and the new values. Keys as in ``diff_rows``."""
    values = [c for c in old.columns if c not in key]
    return (
        keyed_sides({"_a": old, "_b": new}, key, values)
        .where(~F.col("_a").eqNullSafe(F.col("_b")))
        .select(
            *key,
            F.when(F.col("_b").isNull(), "delete").otherwise("upsert").alias("op"),
            *[F.col(f"_b.{c}").alias(c) for c in values],
        )
    )


def apply_changes(table: DataFrame, change_set: DataFrame, key: list[str]) -> DataFrame:
    """``apply_changes(a, changes(a, b)) == b``."""
    values = [c for c in table.columns if c not in key]
    new = change_set.select(*[F.col(c).alias(f"_k_{c}") for c in key], F.struct("op", *values).alias("_c"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    kept = table.join(new, same, "left").where(~F.coalesce(F.col("_c.op") == "delete", F.lit(False))).select(
        *[
            F.col(c) if c in key else F.when(F.col("_c").isNotNull(), F.col(f"_c.{c}")).otherwise(F.col(c)).alias(c)
            for c in table.columns
        ]
    )
    known = table.select(*key).join(new, same, "left_semi").distinct()
    known = known.select(*[F.col(c).alias(f"_k_{c}") for c in key])
    fresh = change_set.where(F.col("op") == "upsert").join(known, same, "left_anti").select(*table.columns)
    return kept.unionByName(fresh)


def schema_frame(df: DataFrame) -> DataFrame:
    """The schema as rows: position, column, type, nullable. Size follows the column count."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def diff_schema(old: StructType, new: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """By name: (column, change, old type, new type) for added, removed and retyped columns."""
    a = {f.name: f.dataType.simpleString() for f in old.fields}
    b = {f.name: f.dataType.simpleString() for f in new.fields}
    out = [(c, "added", None, b[c]) for c in b if c not in a]
    out += [(c, "removed", a[c], None) for c in a if c not in b]
    out += [(c, "retyped", a[c], b[c]) for c in a if c in b and a[c] != b[c]]
    return sorted(out)
