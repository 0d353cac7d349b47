"""Joining rows to one-row-per-key frames when a single key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds an even share of all keyed rows, one part in ``spark.sql.shuffle.partitions``: more than a
# task should get. So there are never more hot keys than partitions, which bounds what is broadcast. A number given
# instead sets the share by hand.
HOT_ROWS: int | None = None
SALTS = 4096


def join_per_key(
    rows: DataFrame, per_key: DataFrame, on: list[str], weight: str, spread: str,
    how: str = "inner", hot_rows: int | None = HOT_ROWS, salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to ``per_key`` (unique on ``on``; ``weight`` = how many of the rows have that key).

    Hot entries are broadcast; their rows, and rows with a null key, then travel under a salt taken
    from ``spread`` (a column that differs between rows of one key), so no task receives all rows of
    a key. All other rows meet their entry in the ordinary shuffled join. Both readings of
    ``per_key`` use the same columns, so Spark computes it once. ``weight`` is not in the result.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    values = [c for c in per_key.columns if c not in on and c != weight]
    entry = F.struct(F.lit(True).alias("_found"), *values)
    if hot_rows is None:
        share = per_key.agg(F.sum(weight).cast("double")).scalar() / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = (F.col(weight) > 1) & (F.col(weight) >= share)
    else:
        hot = F.col(weight) >= hot_rows
    heavy = F.broadcast(per_key.where(hot).select(*on, entry.alias("_heavy")))
    # Always 0, but computed: a literal would be folded out of the join key and thus out of the shuffle.
    zero = F.pmod(F.col(weight).cast("bigint"), F.lit(1)).alias("_salt")
    light = per_key.where(~hot).select(*on, zero, entry.alias("_light"))
    no_key = F.col(on[0]).isNull()
    for c in on[1:]:
        no_key = no_key | F.col(c).isNull()
    marked = rows.join(heavy, on, "left").withColumn(
        "_salt",
        F.when(F.col("_heavy").isNotNull() | no_key, F.pmod(F.xxhash64(spread), F.lit(salts)) + 1).otherwise(F.lit(0).cast("bigint")),
    )
    joined = marked.join(light, [*on, "_salt"], "left").withColumn("_entry", F.coalesce("_heavy", "_light"))
    if how == "inner":
        joined = joined.where(F.col("_entry").isNotNull())
    return joined.select(*rows.columns, *[F.col(f"_entry.{c}").alias(c) for c in values])
