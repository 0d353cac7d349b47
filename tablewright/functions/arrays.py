"""Arrays, maps and small geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_total(c: Column) -> Column:
    """Sum over the values of a map."""
    return F.aggregate(F.map_values(c), F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def scale(c: Column, by: float = 255.0) -> Column:
    return F.transform(c, lambda v: v.cast("double") / F.lit(by))


def corners(x: Column, y: Column, width: Column, height: Column) -> Column:
    """Box given by its corner and size → its two corners."""
    return F.struct(x.alias("x0"), y.alias("y0"), (x + width).alias("x1"), (y + height).alias("y1"))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )


def flat_json(c: Column, paths: dict[str, str]) -> Column:
    """Chosen JSON paths of a text column as one flat string map; absent paths give null values."""
    pairs = [x for key, path in paths.items() for x in (F.lit(key), F.get_json_object(c, path))]
    return F.create_map(*pairs)
