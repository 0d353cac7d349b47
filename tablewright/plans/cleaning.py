"""Registered queries: projection, filters, cleaning, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import clean
from tablewright.plans.registry import query
from tablewright.plans.shapes import ORDER_SQL, order_rows
from tablewright.session import persist_to_shared


@query("project", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")


_TOTAL_SQL = "l_quantity + l_extendedprice + l_discount + l_tax + l_linenumber"
_TOTAL_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "row_totals",
    f"SELECT l_orderkey, l_linenumber, round({_TOTAL_SQL}, 4) AS total, round(({_TOTAL_SQL}) / 5, 4) AS average FROM lineitem",
)
def _(t):
    out = clean.row_totals(t.lineitem, _TOTAL_COLS)
    return out.select("l_orderkey", "l_linenumber", F.round("total", 4).alias("total"), F.round("average", 4).alias("average"))


@query(
    "recompute_derived",
    f"SELECT l_orderkey, l_linenumber, round({_TOTAL_SQL}, 4) AS total, round(({_TOTAL_SQL}) / 5, 4) AS average FROM lineitem",
)
def _(t):
    wrong = clean.row_totals(t.lineitem, _TOTAL_COLS).withColumn("average", F.col("total") / 4)
    out = clean.row_totals(wrong.drop("total", "average"), _TOTAL_COLS)
    return out.select("l_orderkey", "l_linenumber", F.round("total", 4).alias("total"), F.round("average", 4).alias("average"))


@query("rename", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey").withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id"}
    )


@query(
    "align_schema",
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(NULL AS INTEGER) AS p_size, p_retailprice FROM part",
)
def _(t):
    incoming = t.part.select(
        F.col("p_retailprice").cast("string").alias("P_RetailPrice"), F.col("p_partkey").cast("string").alias("P_PARTKEY"),
        "p_name", "p_type", "p_brand", F.lit("x").alias("unknown_column"),
    )
    return clean.align_schema(incoming, t.part.schema)


@query("filter_or", f"SELECT {ORDER_SQL} FROM orders WHERE o_custkey = 19 OR o_custkey = 63")
def _(t):
    return order_rows(t.orders.where("o_custkey = 19 OR o_custkey = 63"))


@query("filter_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def _(t):
    return t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@query("filter_not_in", "SELECT c_custkey, c_nationkey FROM customer_nulls WHERE c_nationkey NOT IN (10, 15, 2, 1, 6)")
def _(t):
    return t.customer_nulls.where(~F.col("c_nationkey").isin(10, 15, 2, 1, 6)).select("c_custkey", "c_nationkey")


@query(
    "filter_null",
    "SELECT c_custkey, c_nationkey FROM customer_nulls WHERE c_mktsegment IS NULL AND c_nationkey IS NOT NULL",
)
def _(t):
    return t.customer_nulls.where(F.col("c_mktsegment").isNull() & F.col("c_nationkey").isNotNull()).select(
        "c_custkey", "c_nationkey"
    )


_MISSING = [
    ("c_custkey", "c_custkey IS NULL"), ("c_name", "c_name IS NULL"), ("c_nationkey", "c_nationkey IS NULL"),
    ("c_acctbal", "c_acctbal IS NULL OR isnan(c_acctbal)"), ("c_mktsegment", "c_mktsegment IS NULL"),
]


@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {p}) AS n_missing, count(*) AS n_rows FROM customer_nulls"
        for c, p in _MISSING
    ),
)
def _(t):
    return clean.null_counts(t.customer_nulls)


@query(
    "drop_any_null",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer_nulls
    WHERE c_name IS NOT NULL AND c_nationkey IS NOT NULL AND c_acctbal IS NOT NULL AND NOT isnan(c_acctbal)
    AND c_mktsegment IS NOT NULL""",
)
def _(t):
    return t.customer_nulls.na.drop("any")


@query("fill_nulls", "SELECT c_custkey, coalesce(c_mktsegment, 'UNKNOWN') AS c_mktsegment FROM customer_nulls")
def _(t):
    return t.customer_nulls.fillna("UNKNOWN", subset=["c_mktsegment"]).select("c_custkey", "c_mktsegment")


@query(
    "filter_day",
    "SELECT event_id, event_type, value FROM events WHERE month(ts) = 1 AND day(ts) = 19",
)
def _(t):
    return t.events.where((F.month("ts") == 1) & (F.dayofmonth("ts") == 19)).select("event_id", "event_type", "value")


@query("sample_fraction", "SELECT true AS near_share, CAST(0 AS BIGINT) AS n_foreign, true AS same_again, count(*) AS n_rows FROM orders")
def _(t):
    """What a random sample guarantees: about the share asked for (six deviations), only rows of the table, the same rows again."""
    drawn = persist_to_shared(t.orders.sample(fraction=0.2, seed=42), "sample")
    again = drawn.select("o_orderkey").exceptAll(t.orders.sample(fraction=0.2, seed=42).select("o_orderkey"))
    n, k = F.col("n_rows"), F.col("n_drawn")
    return t.orders.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", drawn.agg(F.count(F.lit(1))).scalar().alias("n_drawn"),
        drawn.join(t.orders, t.orders.columns, "left_anti").agg(F.count(F.lit(1))).scalar().alias("n_foreign"),
        (again.agg(F.count(F.lit(1))).scalar() == 0).alias("same_again"),
    ).select((F.abs(k - 0.2 * n) <= 6 * F.sqrt(0.16 * n)).alias("near_share"), "n_foreign", "same_again", "n_rows")


_SHARE = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


@query("sample_hash", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_SHARE} < 0.2")
def _(t):
    return t.orders.where(clean.split_label("o_orderkey", 0.2) == "train").select("o_orderkey", "o_custkey")


@query(
    "sample_n",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)) LIMIT 200",
)
def _(t):
    return t.orders.orderBy(clean.stable_order("o_orderkey")).limit(200).select("o_orderkey", "o_custkey")


@query(
    "split_hash",
    f"SELECT o_orderkey, CASE WHEN {_SHARE} < 0.8 THEN 'train' ELSE 'test' END AS split FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", clean.split_label("o_orderkey").alias("split"))


@query("first_n", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def _(t):
    return t.customer.orderBy("c_custkey").limit(10).select("c_custkey", "c_name")


@query(
    "bucketize",
    """SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 1 AND 15 THEN 'small' WHEN p_size BETWEEN 16 AND 30 THEN 'middle'
    WHEN p_size BETWEEN 31 AND 45 THEN 'large' END AS bucket FROM part""",
)
def _(t):
    buckets = [(1, 15, "small"), (16, 30, "middle"), (31, 45, "large")]
    return t.part.select("p_partkey", "p_size", clean.bucketize(F.col("p_size"), buckets).alias("bucket"))


@query("threshold", "SELECT event_id, CASE WHEN value > 25.0 THEN 1 ELSE 0 END AS flag FROM events")
def _(t):
    return t.events.select("event_id", clean.threshold(F.col("value"), 25.0).alias("flag"))


@query(
    "clean_orders",
    """SELECT row_no, order_id, customer_id, TRY_CAST(amount AS DOUBLE) AS amount, currency, status FROM orders_dirty
    WHERE trim(order_id) <> '' AND customer_id IS NOT NULL AND trim(customer_id) <> '' AND status = 'completed'
    AND currency = 'USD' AND TRY_CAST(amount AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(amount AS DOUBLE))""",
)
def _(t):
    return clean.clean_orders(t.orders_dirty, status="completed").select(
        "row_no", "order_id", "customer_id", "amount", "currency", "status"
    )


def _with_metadata(t):
    return t.events.select(
        "event_id",
        F.create_map(F.lit("kind"), F.col("event_type"), F.lit("size.k"), F.get_json_object("props", "$.k")).alias("user_metadata"),
    )


@query("search_meta_str", "SELECT event_id FROM events WHERE event_type = 'click'")
def _(t):
    return _with_metadata(t).where(F.col("user_metadata")["kind"] == "click").select("event_id")


@query(
    "search_meta_num",
    "SELECT event_id FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= 60",
)
def _(t):
    return _with_metadata(t).where(F.try_element_at("user_metadata", F.lit("size.k")).try_cast("int") >= 60).select("event_id")


@query("filter_size", "SELECT path, size_bytes FROM manifest_main WHERE size_bytes >= 2048")
def _(t):
    return t.manifest_main.where(F.col("size_bytes") >= 2 * 1024).select("path", "size_bytes")


@query(
    "filter_not_equal",
    """SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderpriority <> '5-LOW'
    GROUP BY o_orderpriority""",
)
def _(t):
    kept = t.orders.where(F.col("o_orderpriority") != "1-URGENT").where(F.col("o_orderpriority") != "5-LOW")
    path = t.scratch("by-priority")
    kept.write.partitionBy("o_orderpriority").parquet(path)
    return t.spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
