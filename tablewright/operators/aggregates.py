"""Summaries. Everything here combines on the map side first, so hot groups shrink before they move."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.operators.skew import join_per_key
from tablewright.session import persist_to_shared


def union_labelled(frames: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """UNION ALL of frames with one shared shape, each marked with its name."""
    parts = [df.select(F.lit(name).alias(label), "*") for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def count_by_ref(refs: dict[str, DataFrame]) -> DataFrame:
    """Rows per ref in one job; refs without rows count 0."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("ref"), "n_rows") for n, df in refs.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _narrowed(left: DataFrame, bins: int) -> DataFrame:
    """One round of the selection in ``_middle``: each group keeps the bin of values that holds its wanted rank.

    The bins come from a sketch of the group's distinct values; how many rows a bin holds is counted exactly. Values
    below the chosen bin leave, and the wanted rank is counted from its start.
    """
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    sizes = left.groupBy("_g").agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx("_v", cuts, F.lit(100 * bins)).alias("_cuts"))
    met = join_per_key(left, persist_to_shared(sizes, "cuts"), ["_g"], "_size", "_v")
    number = F.size(F.filter("_cuts", lambda cut: cut < F.col("_v")))
    met = met.select("_g", "_k", "_v", "_c", F.when(F.col("_v").isNull(), -1).otherwise(number).alias("_bin"))
    met = persist_to_shared(met, "bins")
    heights = met.groupBy("_g", "_k", "_bin").agg(F.sum("_c").alias("_height"))
    upto = F.sum("_height").over(Window.partitionBy("_g").orderBy("_bin"))  # at most bins + 1 rows a group
    reached = heights.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_k"))
    chosen = reached.groupBy("_g").agg(F.min(F.struct("_bin", (F.col("_upto") - F.col("_height")).alias("below"))).alias("_at"))
    weight = met.groupBy("_g").agg(F.count(F.lit(1)).alias("_size"))
    kept = join_per_key(met, persist_to_shared(chosen.join(weight, "_g"), "chosen"), ["_g"], "_size", "_v")
    kept = kept.where(F.col("_bin") == F.col("_at._bin"))
    return kept.select("_g", (F.col("_k") - F.col("_at.below")).alias("_k"), "_v", "_c")


def _middle(left: DataFrame, block: int, bins: int = 64) -> DataFrame:
    """The value of rank ``_k`` in each group ``_g`` of (value ``_v``, count ``_c``) rows; a null value lies below all.

    Rounds of ``_narrowed`` go on until no group has more than ``block`` values left, so the window that ranks them
    holds at most that many rows, whatever the size of the group. A round leaves about one part in ``bins``.
    """
    widest = None
    while True:
        left = persist_to_shared(left, "middle")
        size = left.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
        if size <= block or size == widest:  # values that a sketch of doubles cannot tell apart do not narrow
            break
        left, widest = _narrowed(left, bins), size
    upto = F.sum("_c").over(Window.partitionBy("_g").orderBy(F.col("_v").asc_nulls_first()))
    reached = left.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_k"))
    return reached.groupBy("_g").agg(F.min("_v").alias("median_value"))


def dim_aggregates(df: DataFrame, dimensions: list[str], measure: str, accuracy: int = 10_000, block: int = 4_096) -> DataFrame:
    """Count, exact median, minimum and maximum of a measure for each value of each dimension.

    Each row becomes one (dimension, value) pair per dimension, folded together before the exchange. A first pass
    brackets the middle with a sketch of bounded size, whose rank is off by at most one in ``accuracy`` rows. A
    second pass counts what lies below the bracket and each value inside it, some 4 n / ``accuracy`` rows of a group
    of n. Groups with more than ``block`` values left are narrowed in rounds (``_middle``) before any window ranks
    them. The median of an even count is the lower middle value.
    """
    pairs = []
    for i, d in enumerate(dimensions):
        value = F.col(d).cast("string")
        group = F.concat(F.lit(str(i)), F.coalesce(F.concat(F.lit("="), value), F.lit("")))  # never null, unlike the value
        pairs.append(F.struct(F.lit(d).alias("dimension"), value.alias("value"), group.alias("_g")))
    rows = df.select(F.col(measure).alias("_m"), F.inline(F.array(*pairs)))
    near = F.percentile_approx("_m", F.array(F.lit(0.5 - 2 / accuracy), F.lit(0.5 + 2 / accuracy)), accuracy)
    first = rows.groupBy("dimension", "value", "_g").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_m").alias("_n"), near.alias("_near"),
        F.min("_m").alias("min_value"), F.max("_m").alias("max_value"),
    )
    first = persist_to_shared(first, "groups")
    met = rows.select("_g", "_m").join(first.select("_g", "_n", "_near"), "_g").where(F.col("_m") <= F.col("_near")[1])
    # Everything below the bracket counts as one value, so at most the bracket's values are left per group.
    place = F.when(F.col("_m") >= F.col("_near")[0], F.col("_m")).alias("_v")
    left = met.groupBy("_g", F.ceil(F.col("_n") / 2).alias("_k"), place).agg(F.count(F.lit(1)).alias("_c"))
    return first.join(_middle(left, block), "_g", "left").select(
        "dimension", "value", "n_rows", "median_value", "min_value", "max_value"
    )


def top_sellers(
    books: DataFrame, authors: DataFrame, sales: DataFrame, *,
    author_key: tuple[str, str], sale_key: tuple[str, str], name: str, price: str, n: int = 3, how: str = "left",
) -> DataFrame:
    """Best-selling authors: sales joined to books joined to authors, summed per name, largest first.

    Sales are summed per book and then per author before they meet the next table, so neither a
    bestseller nor a prolific author sends many rows through a join. ``author_key`` is (book column, author column), ``sale_key`` is
    (book column, sale column). With ``how="inner"`` authors without sales vanish.
    """
    per_book = sales.groupBy(F.col(sale_key[1]).alias("_book")).agg(F.sum(price).alias("_total"))
    b = books.select(F.col(author_key[0]).alias("_author"), F.col(sale_key[0]).alias("_book"))
    a = authors.select(F.col(author_key[1]).alias("_author"), F.col(name))
    per_author = b.join(per_book, "_book", how).groupBy("_author").agg(F.sum("_total").alias("_total"))
    return (
        per_author.join(a, "_author", how)
        .groupBy(name).agg(F.round(F.sum("_total"), 2).alias("total_sales"))
        .orderBy(F.desc_nulls_last("total_sales"), F.asc(name)).limit(n)
    )


def values_per_key(df: DataFrame, key: str, value: str, block: int = 1000) -> DataFrame:
    """The values of each key, of any type, with their counts: lists in blocks, and the number per key.

    Equal pairs are counted before anything is collected. A key's distinct values are dealt by hash over as many
    blocks as they fill, so a list holds about ``block`` of them and no key builds an unbounded one. ``n_total``
    is the number of values of the key over all its blocks.
    """
    pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_c"))
    per = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_pairs"), F.sum("_c").alias("n_total"))
    per = per.withColumn("_blocks", F.ceil(F.col("_pairs") / block))
    dealt = join_per_key(pairs, per, [key], "_pairs", value)
    loose = pairs.where(F.col(key).isNull()).crossJoin(per.where(F.col(key).isNull()).select("n_total", "_blocks"))  # one row
    dealt = dealt.where(F.col(key).isNotNull()).unionByName(loose)
    number = F.pmod(F.xxhash64(F.col(value)), F.col("_blocks")).alias("value_block")
    return dealt.groupBy(key, number).agg(
        F.sum("_c").alias("n_values"), F.any_value("n_total").alias("n_total"),
        F.array_sort(F.collect_list(F.struct(F.col(value).alias("value"), F.col("_c").alias("count")))).alias("values"),
    )


def best_run(runs: DataFrame, status: str = "FINISHED") -> DataFrame:
    """The finished run with the highest metric; the smaller run id wins a tie. One pass, no sort."""
    done = runs.where(F.col("status") == status)
    top = done.groupBy("metric").agg(F.min_by(F.struct(*runs.columns), "run_id").alias("r"))
    return top.agg(F.max_by("r", "metric").alias("r")).where(F.col("r").isNotNull()).select("r.*")


def attach_values(rows: DataFrame, details: DataFrame, key: str, value: str, block: int = 1000) -> DataFrame:
    """Each row with the blocks of its matching detail values (see ``values_per_key``); rows without details stay."""
    return rows.join(values_per_key(details, key, value, block), key, "left")


def word_count(lines: DataFrame, column: str) -> DataFrame:
    words = lines.select(F.explode(F.split(F.lower(F.col(column)), r"[^\p{L}\p{N}_]+")).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
