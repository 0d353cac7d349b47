"""Registered queries: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.arrays import flat_json
from tablewright.operators import aggregates, clean, gates, masks
from tablewright.plans.registry import query
from tablewright.plans.shapes import pair_list
from tablewright.sources.snapshots import SnapshotStore


@query("join_inner", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.select("o_orderkey", "o_custkey").join(customer, ["o_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@query("join_left", "SELECT o_orderkey, o_custkey, c_name FROM orders_orphans LEFT JOIN customer ON o_custkey = c_custkey")
def _(t):
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return t.orders_orphans.select("o_orderkey", "o_custkey").join(customer, "o_custkey", "left").select(
        "o_orderkey", "o_custkey", "c_name"
    )


_WRONG = "(SELECT o_orderkey, o_custkey, c_name FROM customer LEFT JOIN orders_dev ON o_custkey = c_custkey) x"


@query(
    "join_wrong_side_audit",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n_rows FROM {_WRONG}"
        for c in ("o_orderkey", "o_custkey", "c_name")
    ),
)
def _(t):
    # customers on the kept side: unmatched ones surface as null order keys in the profile
    joined = t.customer.join(t.orders_dev, F.col("o_custkey") == F.col("c_custkey"), "left")
    return clean.null_counts(joined.select("o_orderkey", "o_custkey", "c_name"))


def _sellers_sql(ref: str, table: str, join: str) -> str:
    return f"""SELECT '{ref}' AS ref, * FROM (SELECT n_name, round(sum(o_totalprice), 2) AS total_sales
    FROM customer {join} JOIN nation ON c_nationkey = n_nationkey {join} JOIN {table} ON o_custkey = c_custkey
    GROUP BY n_name ORDER BY total_sales DESC NULLS LAST, n_name LIMIT 3)"""


def sellers(t, orders, how: str = "left"):
    return aggregates.top_sellers(
        t.customer, t.nation, orders, author_key=("c_nationkey", "n_nationkey"), sale_key=("c_custkey", "o_custkey"),
        name="n_name", price="o_totalprice", how=how,
    )


@query("top_sellers", _sellers_sql("main", "orders", "LEFT") + " UNION ALL " + _sellers_sql("dev", "orders_dev", "LEFT"))
def top_sellers(t):
    return aggregates.union_labelled({"main": sellers(t, t.orders), "dev": sellers(t, t.orders_dev)}, "ref")


@query(
    "top_sellers_inner",
    _sellers_sql("main", "orders", "INNER") + " UNION ALL " + _sellers_sql("dev", "orders_dev", "INNER"),
)
def _(t):
    return aggregates.union_labelled(
        {"main": sellers(t, t.orders, "inner"), "dev": sellers(t, t.orders_dev, "inner")}, "ref"
    )


@query(
    "history_diff",
    """SELECT commit_id, prefix, committer FROM commits b WHERE NOT EXISTS (
    SELECT 1 FROM commits a WHERE a.prefix <> 'tables/error/' AND a.commit_id = b.commit_id AND a.ts = b.ts)""",
)
def _(t):
    here = t.commits.where(F.col("prefix") != "tables/error/").select("commit_id", "ts")
    return t.commits.join(here, ["commit_id", "ts"], "left_anti").select("commit_id", "prefix", "committer")


@query(
    "join_versioned",
    """SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def _(t):
    store = SnapshotStore(t.spark, t.scratch("versions"))
    store.overwrite("main", "orders", t.orders, "load")
    store.overwrite("main", "orders", t.orders_dev, "edit")
    past = store.read_version("orders", "main", 0)
    per_customer = past.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("n_orders"), F.round(F.sum("s"), 2).alias("total"))


@query(
    "attach_annotations",
    """WITH pairs AS (SELECT l_orderkey, l_partkey, count(*) AS c FROM lineitem GROUP BY ALL),
    lists AS (SELECT l_orderkey, CAST(sum(c) AS BIGINT) AS n_total, string_agg(l_partkey || ':' || c, ',' ORDER BY l_partkey) AS parts
              FROM pairs GROUP BY ALL)
    SELECT o_orderkey, n_total, coalesce(n_total, 0) AS n_values, parts FROM orders LEFT JOIN lists ON o_orderkey = l_orderkey""",
)
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    out = aggregates.attach_values(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_partkey")
    return out.select("o_orderkey", "n_total", F.coalesce("n_values", F.lit(0)).alias("n_values"), pair_list("values", "parts"))


@query(
    "join_series",
    """WITH a AS (SELECT strftime(ts, '%Y-%m-%d') AS day, round(sum(value), 2) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1),
    b AS (SELECT strftime(ts, '%Y-%m-%d') AS day, round(sum(value), 2) AS purchases FROM events
          WHERE event_type = 'purchase' AND day(ts) <> 5 GROUP BY 1)
    SELECT coalesce(a.day, b.day) AS day, clicks, purchases FROM a FULL JOIN b ON a.day = b.day""",
)
def _(t):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    clicks = t.events.where("event_type = 'click'").groupBy(day).agg(F.round(F.sum("value"), 2).alias("clicks"))
    bought = t.events.where("event_type = 'purchase' AND day(ts) <> 5").groupBy(day).agg(
        F.round(F.sum("value"), 2).alias("purchases")
    )
    return clicks.join(bought, "day", "full_outer")


@query(
    "attach_metadata",
    """SELECT path, size_bytes, CAST(size_bytes % 640 AS VARCHAR) AS width, substr(path, 6, 2) AS folder FROM manifest_main""",
)
def _(t):
    notes = t.manifest_main.select(
        F.regexp_replace("path", r"^docs/(.*)\.txt$", "notes/$1.json").alias("path"),
        F.to_json(
            F.struct(F.struct(F.substring("path", 6, 2).alias("folder"), F.struct((F.col("size_bytes") % 640).alias("width")).alias("size")).alias("annotation"))
        ).alias("json"),
    )
    keyed = notes.select(
        F.regexp_replace("path", r"^notes/(.*)\.json$", "docs/$1.txt").alias("path"),
        flat_json(F.col("json"), {"size.width": "$.annotation.size.width", "folder": "$.annotation.folder"}).alias("user_metadata"),
    )
    return t.manifest_main.join(keyed, "path").select(
        "path", "size_bytes", F.col("user_metadata")["size.width"].alias("width"), F.col("user_metadata")["folder"].alias("folder")
    )


@query(
    "gold_join",
    """SELECT image_id, n_masks, sum_area, o_orderpriority AS content FROM (
    SELECT l_orderkey AS image_id, count(*) AS n_masks,
           CAST(sum(CAST(l_quantity AS BIGINT) + 1 + l_linenumber) AS BIGINT) AS sum_area
    FROM lineitem GROUP BY l_orderkey) JOIN orders ON o_orderkey = image_id""",
)
def _(t):
    images = t.orders.select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("content"))
    return masks.mask_stats(t.masks).join(images, "image_id").select("image_id", "n_masks", "sum_area", "content")


@query(
    "ref_integrity",
    """SELECT 'orphan' AS "check", CAST(o_custkey AS VARCHAR) AS subject, CAST(count(*) AS VARCHAR) AS detail
    FROM orders_orphans WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey""",
)
def _(t):
    return gates.orphans(t.orders_orphans, t.customer, "o_custkey", "c_custkey")


@query(
    "ref_count_rule",
    """SELECT (SELECT count(DISTINCT o_custkey) FROM orders_orphans) AS child_keys, (SELECT count(*) FROM customer) AS parent_keys,
    (SELECT count(DISTINCT o_custkey) FROM orders_orphans) <= (SELECT count(*) FROM customer) AS passed""",
)
def _(t):
    sides = t.orders_orphans.select("o_custkey").distinct().select(F.lit(1).alias("c"), F.lit(0).alias("p")).unionAll(
        t.customer.select(F.lit(0), F.lit(1))
    )
    return sides.agg(F.sum("c").alias("child_keys"), F.sum("p").alias("parent_keys")).withColumn(
        "passed", F.col("child_keys") <= F.col("parent_keys")
    )
