"""Mix sources to target weights by systematic sampling along a prefix sum of expected copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import SMALL, ranked_within, replaced, running, whole, word_count
from tablewright.operators.skew import join_per_key
from tablewright.session import persist_to_shared

WEIGHTS = (1, 2, 3)  # by position of the source in code point order, repeating
MOST_COPIES = 3
SEED = 17


def source_targets(sizes: DataFrame, cap: int = MOST_COPIES) -> DataFrame:
    """Words to take per source: ``(__source, source_size)`` to ``(__source, source_size, target)``.

    Every source gets ``level * weight`` words, but no more than ``cap`` times its size. Handing the excess
    out again until none is above has one fixed point: with sources in order of cap per weight, the level
    is what is left over for the first source that the level does not fill.
    """
    placed = running(sizes, [F.col("__source").asc_nulls_last()])
    weighed = placed.select(
        "__source", "source_size", (F.lit(cap) * F.col("source_size")).alias("__cap"),
        F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("__rank") % len(WEIGHTS)).cast("int") + 1).cast("long").alias("__weight"),
    )
    ratio = (F.col("__cap") / F.col("__weight")).alias("__ratio")
    filled = running(weighed.select("*", ratio), [F.col("__ratio"), F.col("__source").asc_nulls_last()], ("__cap", "__weight"))
    every = weighed.agg(F.sum("source_size").alias("total"), F.sum("__weight").alias("weights")).first()
    left = (F.lit(every["total"] or 0) - F.col("__before___cap")) / (F.lit(every["weights"] or 0) - F.col("__before___weight"))
    level = filled.withColumn("__level", left).where("__level <= __ratio").agg(F.min_by("__level", "__rank").alias("l")).first()["l"]
    return filled.select(
        "__source", "source_size",
        F.least(F.col("__cap").cast("double"), F.lit(float(level or 0.0)) * F.col("__weight")).alias("target"),
    )


def offset(source: Column, seed: int = SEED) -> Column:
    """One number in [0, 1) per source, the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_plan(docs: DataFrame, size: Column | None = None, source: str = "source", key: str = "doc_id",
             text: str = "text", seed: int = SEED, small: int = SMALL) -> DataFrame:
    """Add ``size, source_size, target, copies, taken`` to every row of ``docs``.

    Within a source the documents stand in order of (size, key, text hash), each with the same expected number
    of copies; a document is emitted once per integer that the prefix sum plus the source's offset crosses.
    The order by size makes the words taken follow the target closely. Null sources are one source (the last),
    null texts have size 0 and give no words, repeated rows are separate documents, and input columns called
    like a result column are replaced.

    The rows are written once with a number each; only numbers, sizes and hashes are ranked, and texts meet their
    plan by number, so that no task has more of them than another.
    """
    size = word_count(F.col(text)) if size is None else size
    made = ["size", "source_size", "target", "copies", "taken"]
    held = persist_to_shared(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in replaced(docs, made).columns]).alias("__row"), F.monotonically_increasing_id().alias("__no"),
        F.col(source).alias("__source"), F.col(key).alias("__key"), size.alias("size"), F.xxhash64(whole(text)).alias("__hash"),
    ), "numbered")
    order = [F.col("size"), F.col("__key"), F.col("__hash")]
    placed = ranked_within(held.select("__no", "__source", "__key", "size", "__hash"), "__source", order)
    facts = placed.groupBy("__source").agg(F.sum("size").alias("source_size"), F.max("__count").alias("__weight"))
    facts = persist_to_shared(facts, "sources")
    t = source_targets(facts.select("__source", "source_size")).select(F.col("__source").alias("__s"), "target")
    named = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias("__name")  # noqa: E731  (null is a name too)
    facts = facts.join(t, F.col("__source").eqNullSafe(F.col("__s"))).select(
        named(F.col("__source").cast("string")), "source_size", "target", offset(F.col("__source").cast("string"), seed).alias("__u"), "__weight"
    )
    facts = persist_to_shared(facts, "targets")
    rows = placed.select("__no", "size", "__rank", named(F.col("__source").cast("string")))
    bytes_ = facts.agg(F.coalesce(F.sum(F.octet_length("__name") + 64), F.lit(0)).alias("b")).first()["b"]
    if bytes_ <= small:
        met = rows.join(F.broadcast(facts.drop("__weight")), "__name")
    else:
        met = join_per_key(rows, facts, ["__name"], "__weight", "__no")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("__rank")
    crossed = F.floor((place + 1) * each + F.col("__u")) - F.floor(place * each + F.col("__u"))
    plan = met.select(F.col("__no").alias("__of"), "source_size", "target", crossed.cast("long").alias("copies"))
    return (
        held.select("__row", "__no", "size").join(plan, F.col("__no") == F.col("__of"))
        .select("__row.*", "size", "source_size", "target", "copies")
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan takes it, numbered by ``copy`` from 1."""
    plan = mix_plan(docs, **options).where("copies > 0")
    return replaced(plan, ["copy"]).select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
