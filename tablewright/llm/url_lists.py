"""URL filters: dated list entries become validity intervals; every capture meets the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.shared import replaced
from tablewright.session import persist_to_shared

# scheme, user, port and a closing dot of the host are not part of what lists name
URL = r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)"
FIRST_FOLDER = r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)/"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    """Lower-case host, null if the address has none."""
    found = F.lower(F.regexp_extract(F.trim(url), URL, 1))
    return F.when(F.length(found) > 0, found)


def folder(url: Column) -> Column:
    """First folder of the path, or the empty text."""
    return F.coalesce(F.regexp_extract(F.trim(url), FIRST_FOLDER, 1), F.lit(""))


def names(host_: Column, folder_: Column) -> Column:
    """What a list can call a page: its host, every parent domain of two labels or more, and host/folder/."""
    labels = F.split(host_, r"\.", -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.when(folder_ != "", F.concat(parents, F.array(F.concat_ws("/", host_, folder_, F.lit(""))))).otherwise(parents)


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, pattern, day, op)`` with op ``add`` or ``remove`` to ``(list, pattern, since, until)``.

    An entry holds from the day it is added until, but not on, the next day it is removed. Entries of one list,
    pattern and day are one: ``remove`` wins over ``add``; adding twice changes nothing. So a pattern has one
    row per day at most, which bounds the window below. Entries with a null in list, pattern or day are void.
    """
    daily = entries.where("list is not null and pattern is not null and day is not null and op in ('add', 'remove')").groupBy("list", "pattern", "day").agg(F.max("op").alias("op"))
    order = Window.partitionBy("list", "pattern").orderBy("day")
    turns = daily.withColumn("__before", F.lag("op").over(order)).where("op = 'add' and coalesce(__before, '') != 'add' or op = 'remove' and __before = 'add'")
    ends = turns.withColumn("until", F.lead("day").over(order))
    return ends.where("op = 'add'").select("list", "pattern", F.col("day").alias("since"), F.coalesce("until", F.lit(FOREVER).cast("date")).alias("until"))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Add ``host, blocked, pattern, list, since`` to every capture.

    The longest active pattern decides (``list`` ``allow`` permits, any other blocks; between equal patterns the
    smallest list name). Sites are judged once per host, folder and day, then handed to all their captures, so a
    host with a third of the captures meets the lists once a day. A null or hostless address, or a null day, is
    never blocked; repeated rows are kept.
    """
    made = ["host", "blocked", "pattern", "list", "since"]
    kept = replaced(captures, made).columns
    rows = captures.select(*[F.col(f"`{c}`") for c in kept], host(F.col(url)).alias("host"), folder(F.col(url)).alias("__folder"), F.col(fetched).cast("date").alias("__day"))
    sites = rows.where("host is not null and __day is not null").select("host", "__folder", "__day").distinct()
    known = persist_to_shared(intervals(entries), "intervals")
    asked = sites.select("*", F.explode(names(F.col("host"), F.col("__folder"))).alias("__name"))
    active = asked.join(known, (F.col("__name") == F.col("pattern")) & (F.col("since") <= F.col("__day")) & (F.col("__day") < F.col("until")))
    best = active.groupBy(F.col("host").alias("__h"), F.col("__folder").alias("__f"), F.col("__day").alias("__d")).agg(
        F.min(F.struct((-F.length("pattern")).alias("n"), "list", "pattern", "since")).alias("__best")
    )
    same = (F.col("host") == F.col("__h")) & (F.col("__folder") == F.col("__f")) & (F.col("__day") == F.col("__d"))
    return rows.join(best, same, "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", F.coalesce(F.col("__best.list") != "allow", F.lit(False)).alias("blocked"),
        "__best.pattern", "__best.list", "__best.since",
    )
