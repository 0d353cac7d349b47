"""Three-way merge, cherry-pick and revert of keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_sides(frames: dict[str, DataFrame], key: list[str], values: list[str]) -> DataFrame:
    """All sides of a merge under one exchange: one row per key, one packed struct per side.

    A key that occurs twice on a side fails the job instead of multiplying rows.
    """
    tagged = None
    for side, df in frames.items():
        one = df.select(*key, F.lit(side).alias("_side"), F.struct(*values).alias("_v"))
        tagged = one if tagged is None else tagged.unionByName(one)
    aggs = []
    for side in frames:
        on_side = F.col("_side") == side
        aggs.append(F.any_value(F.when(on_side, F.col("_v")), True).alias(side))
        aggs.append(F.count_if(on_side).alias(f"_n_{side}"))
    # A key has at most one row per side, so combining before the exchange would only sort twice.
    packed = tagged.repartition(*key).groupBy(*key).agg(*aggs)
    most = F.greatest(*[F.col(f"_n_{s}") for s in frames]) if len(frames) > 1 else F.col(f"_n_{next(iter(frames))}")
    clash = F.raise_error(F.concat(F.lit("key occurs twice: "), F.to_json(F.struct(*key))))
    first = next(iter(frames))
    return packed.select(
        *key,
        F.when(most <= 1, F.col(first)).otherwise(clash).alias(first),
        *[F.col(s) for s in frames if s != first],
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def merge_status(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: list[str]) -> DataFrame:
    """Every key of the three snapshots with its fate and the packed rows of each side.

    ``status`` is unchanged, ours, theirs, both (same change on both sides) or conflict.
    """
    values = [c for c in base.columns if c not in key]
    sides = keyed_sides({"_base": base, "_ours": ours, "_theirs": theirs}, key, values)
    return sides.withColumn(
        "status",
        F.when(_same("_ours", "_theirs"), F.when(_same("_ours", "_base"), "unchanged").otherwise("both"))
        .when(_same("_theirs", "_base"), "ours")
        .when(_same("_ours", "_base"), "theirs")
        .otherwise("conflict"),
    )


def merge_three_way(
    base: DataFrame, ours: DataFrame, theirs: DataFrame, key: list[str], prefer: str | None = None
) -> DataFrame:
    """The merged table plus ``status``.

    A key changed on one side takes that side; a change made differently on both sides, or changed
    here and deleted there, is a conflict. Conflict rows appear with their "ours" values and status
    ``conflict`` (a publisher must stop on them) unless ``prefer`` settles them.
    """
    if prefer not in (None, "ours", "theirs"):
        raise ValueError(prefer)
    columns = base.columns
    status = merge_status(base, ours, theirs, key)
    pick_theirs = F.col("status") == "theirs"
    if prefer == "theirs":
        pick_theirs = pick_theirs | (F.col("status") == "conflict")
    chosen = status.withColumn("_row", F.when(pick_theirs, F.col("_theirs")).otherwise(F.col("_ours")))
    keep = F.col("_row").isNotNull()
    if prefer is None:
        keep = keep | (F.col("status") == "conflict")
    return chosen.where(keep).select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in columns], "status"
    )


def conflicts(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: list[str]) -> DataFrame:
    """Keys that block a merge, and which kind of conflict each is."""
    return (
        merge_status(base, ours, theirs, key)
        .where(F.col("status") == "conflict")
        .select(
            *key,
            F.when(F.col("_ours").isNull(), "delete/update")
            .when(F.col("_theirs").isNull(), "update/delete")
            .when(F.col("_base").isNull(), "insert/insert")
            .otherwise("update/update").alias("kind"),
        )
    )


def cherry_pick(target: DataFrame, before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Apply one commit (before → after) to ``target``: a merge whose base is the commit's parent."""
    return merge_three_way(before, target, after, key)


def revert_rows(current: DataFrame, before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Undo one commit (before → after) while later, unrelated changes stay: the inverse change set merged in."""
    return merge_three_way(after, current, before, key)
