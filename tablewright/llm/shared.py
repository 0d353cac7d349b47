"""Word patterns, and ranks over range partitions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.session import persist_to_shared

# The two word patterns of the contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before A-Z is lowered, as ranges with the commonest first: several times faster than a negated class.
ANY_CASE_WORD = r"[a-zA-Z0-9\x80-\x{10FFFF}]+"
NOT_PLAIN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

AT = "__at"
ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def whole(text: Column | str = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z only; other scripts keep their case, as the word contracts say."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column, pattern: str = SPACED_WORD) -> Column:
    return F.regexp_count(whole(text), F.lit(pattern)).cast("long")


def keyed(df: DataFrame, *extra: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key columns that name a document even where ids repeat: the id and a hash of the text."""
    return df.select(F.col(key).alias("__id"), F.xxhash64(whole(text)).alias("__text"), *extra)


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["__id"].eqNullSafe(b["__id"]) & (a["__text"] == b["__text"])


def running(df: DataFrame, order: list[Column], sums: tuple[str, ...] = ()) -> DataFrame:
    """Number the rows from 0 in ``order`` (``__rank``) and add totals of the rows before (``__before_<name>``).

    Range partitioning splits even one hot key as long as ``order`` tells its rows apart; each partition
    numbers its own rows and only one total per partition meets in one task. The frame is written once,
    so the numbering cannot change when an executor is lost.
    """
    placed = persist_to_shared(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(AT, F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright(F.col(AT), ROW_BITS)
    totals = placed.groupBy(part.alias("__part")).agg(
        F.count("*").alias("__rows"), *[F.sum(c).alias(f"__all_{c}") for c in sums]
    )
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select(
        F.col("__part").alias("__of"),
        F.coalesce(F.sum("__rows").over(ahead), F.lit(0)).alias("__skip"),
        *[F.coalesce(F.sum(f"__all_{c}").over(ahead), F.lit(0)).alias(f"__skip_{c}") for c in sums],
    )
    inside = Window.partitionBy(part).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    out = placed
    for c in sums:
        out = out.withColumn(f"__in_{c}", F.coalesce(F.sum(c).over(inside), F.lit(0)))
    row = F.col(AT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        out.join(offsets, part == F.col("__of"))
        .withColumn("__rank", F.col("__skip") + row)
        .withColumns({f"__before_{c}": F.col(f"__in_{c}") + F.col(f"__skip_{c}") for c in sums})
        .drop("__of", "__skip", AT, *[f"__in_{c}" for c in sums], *[f"__skip_{c}" for c in sums])
    )


SMALL = 32 << 20  # bytes of a measured side up to which it is sent to every task


def ranked_within(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """Number the rows of every ``group`` from 0 in ``order`` (``__rank``) and add the group's size (``__count``).

    Rows are range partitioned by group, order and their place in the input, so neither a hot group nor many equal rows
    meet in one task. Written once, a row's rank is its place in its partition plus what its group has in the
    partitions before; those facts are a row per partition and group, sent to all tasks if measured to be small,
    else joined by both, where no key has more rows than a partition.
    """
    by = [F.col(group), *order, F.col("__tie")]
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = persist_to_shared(
        tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie").withColumn(AT, F.monotonically_increasing_id()), "ranked"
    )
    part, row = F.shiftright(F.col(AT), ROW_BITS), F.col(AT).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    facts = placed.groupBy(part.alias("__part"), F.col(group).alias("__group")).agg(F.count("*").alias("__rows"), F.min(row).alias("__first"))
    facts = persist_to_shared(facts, "facts")
    whole_group = Window.partitionBy("__group")  # a row per partition that the group reaches
    before = whole_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = facts.select(
        "__part", "__group", F.sum("__rows").over(whole_group).alias("__count"),
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
    )
    measured = facts.agg((F.count("*") * 64 + F.coalesce(F.sum(F.octet_length(F.col("__group").cast("string"))), F.lit(0))).alias("b")).first()["b"]
    shift = F.broadcast(shift) if measured <= SMALL else shift
    same = (part == F.col("__part")) & F.col(group).eqNullSafe(F.col("__group"))
    return placed.join(shift, same).withColumn("__rank", row + F.col("__shift")).drop(AT, "__part", "__group", "__shift")


def replaced(df: DataFrame, names: list[str]) -> DataFrame:
    """Without input columns that a result column of the same name replaces."""
    return df.drop(*[c for c in df.columns if c in names])
