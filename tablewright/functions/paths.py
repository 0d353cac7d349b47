"""Object paths taken apart and put together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def parent(c: Column) -> Column:
    """Folder of a path without a trailing slash, '' at the top."""
    return F.when(c.contains("/"), F.regexp_replace(c, r"/[^/]*$", "")).otherwise(F.lit(""))


def suffix(c: Column) -> Column:
    """File extension with its dot, '' if there is none."""
    return F.regexp_extract(base_name(c), r"(\.[^.]*)$", 1)


def join(folder: Column, name: Column) -> Column:
    return F.when(folder == "", name).otherwise(F.concat_ws("/", folder, name))


def folders(c: Column) -> Column:
    """All folders above a path, the nearest first, '' (the top) last."""
    parts = F.split(c, "/")
    depth = F.size(parts) - 1
    return F.transform(F.sequence(depth, F.lit(0), F.lit(-1)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def common_prefix(c: Column, prefix: str, delimiter: str = "/") -> Column:
    """The listing entry of a path below ``prefix``: a sub-folder, or the object itself."""
    rest = F.substr(c, F.lit(len(prefix) + 1))
    return F.concat(
        F.lit(prefix),
        F.when(rest.contains(delimiter), F.concat(F.substring_index(rest, delimiter, 1), F.lit(delimiter))).otherwise(rest),
    )
