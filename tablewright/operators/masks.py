"""Run-length masks: 1-based (start, length) pairs over columns of ``height`` pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# A pair of the mask text: group 1 is the start, group 2 the length.
_PAIR = r"([0-9]+)\s+([0-9]+)"


def _column_of_pairs(c: Column, group: int) -> Column:
    return F.regexp_extract_all(c, F.lit(_PAIR), F.lit(group))


def runs(c: Column) -> Column:
    """A mask text as an array of (start, stop) pixel ranges, 0-based, stop exclusive."""
    return F.zip_with(
        _column_of_pairs(c, 1), _column_of_pairs(c, 2),
        lambda s, n: F.struct((s.cast("bigint") - 1).alias("start"), (s.cast("bigint") - 1 + n.cast("bigint")).alias("stop")),
    )


def mask_area(c: Column) -> Column:
    """Pixels of one mask: the sum of its run lengths."""
    return F.aggregate(_column_of_pairs(c, 2), F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))


def mask_boxes(masks: DataFrame, height: int, mask: str = "encoded_pixels") -> DataFrame:
    """Rows with the inclusive bounding box x0, y0, x1, y1 of each mask.

    A run that crosses a column border spans all rows. The runs are decoded once per mask.
    """
    decoded = masks.select("*", F.inline(F.array(F.struct(runs(F.col(mask)).alias("_runs")))))
    h = f"{int(height)}L"
    return decoded.selectExpr(
        *masks.columns,
        f"""named_struct(
            'x0', array_min(transform(_runs, r -> r.start)) div {h},
            'y0', array_min(transform(_runs, r -> if(r.start div {h} <> (r.stop - 1) div {h}, 0L, r.start % {h}))),
            'x1', (array_max(transform(_runs, r -> r.stop)) - 1) div {h},
            'y1', array_max(transform(_runs, r -> if(r.start div {h} <> (r.stop - 1) div {h}, {h} - 1, (r.stop - 1) % {h})))
        ) AS box""",
    ).select(*masks.columns, "box.*")


def mask_stats(masks: DataFrame, key: str = "image_id", mask: str = "encoded_pixels") -> DataFrame:
    """Masks and summed area per image, combined before the shuffle; no pixel image and no list is built."""
    areas = masks.where(F.col(mask).isNotNull()).select(key, mask_area(F.col(mask)).alias("_area"))
    return areas.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_masks"), F.sum("_area").alias("sum_area"), F.max("_area").alias("max_area")
    )


def _word(start: Column, stop: Column, number: int) -> Column:
    """The bits of word ``number`` (64 pixels) that the range covers, as a bigint."""
    low = F.greatest(start - 64 * number, F.lit(0)).cast("int")
    high = F.least(stop - 64 * number, F.lit(64)).cast("int")
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), 64 - (high - low))
    return F.when(high > low, F.call_function("shiftleft", ones, low)).otherwise(F.lit(0).cast("bigint"))


def union_area(masks: DataFrame, tile: int, key: str = "image_id", mask: str = "encoded_pixels") -> DataFrame:
    """Pixels covered by at least one mask of an image: overlapping runs count once.

    Runs are cut at the borders of tiles of ``tile`` pixels, and a tile is a few 64-bit words with one bit a pixel.
    Words are combined by OR before they are shuffled, so each task sends at most one row per image and tile, however
    many masks cover it; nothing is sorted and no group is gathered. The second exchange carries one sum per image and task.
    """
    cut = masks.where(F.col(mask).isNotNull()).select(key, F.inline(runs(F.col(mask))))
    cut = cut.where(F.col("stop") > F.col("start")).select(
        key, "start", "stop",
        F.explode(F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("stop") - 1) / tile))).alias("_tile"),
    )
    origin = F.col("_tile") * tile
    pieces = cut.select(
        key, "_tile", F.greatest(F.col("start") - origin, F.lit(0)).alias("start"), F.least(F.col("stop") - origin, F.lit(tile)).alias("stop")
    )
    words = range((tile + 63) // 64)
    tiles = pieces.groupBy(key, "_tile").agg(*[F.bit_or(_word(F.col("start"), F.col("stop"), w)).alias(f"_w{w}") for w in words])
    covered = sum((F.bit_count(F.col(f"_w{w}")) for w in words[1:]), F.bit_count(F.col("_w0")))
    return tiles.groupBy(key).agg(F.sum(covered.cast("bigint")).alias("union_area"))
