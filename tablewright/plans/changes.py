"""Registered queries: deletes, updates, upserts and inserts on the changed branch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import dml
from tablewright.plans.registry import query
from tablewright.plans.shapes import ORDER_SQL, order_rows
from tablewright.sources import objects, sinks


@query("dml_delete", f"SELECT {ORDER_SQL} FROM orders_dev WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)")
def _(t):
    return order_rows(dml.delete_where(t.orders_dev, (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)))


@query(
    "dml_delete_in",
    f"""SELECT {ORDER_SQL} FROM orders_dev WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def _(t):
    debtors = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return order_rows(dml.delete_keys(t.orders_dev, debtors, ["o_custkey"]))


@query("dml_delete_gt", f"SELECT {ORDER_SQL} FROM orders_dev WHERE NOT o_totalprice > 250000")
def _(t):
    return order_rows(dml.delete_where(t.orders_dev, F.col("o_totalprice") > 250000))


@query("dml_delete_like", "SELECT c_custkey, c_name, c_mktsegment FROM customer_nulls WHERE c_mktsegment IS NULL")
def _(t):
    return dml.delete_where(t.customer_nulls, F.col("c_mktsegment").like("%")).select("c_custkey", "c_name", "c_mktsegment")


@query(
    "dml_update",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders_dev""",
)
def _(t):
    out = dml.update_where(
        t.orders_dev, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    return order_rows(out)


@query(
    "dml_mask",
    "SELECT c_custkey, CASE WHEN c_nationkey IN (3, 4) THEN 'x.x.x.x' ELSE c_name END AS c_name, c_nationkey FROM customer_nulls",
)
def _(t):
    out = dml.update_where(t.customer_nulls, F.col("c_nationkey").isin(3, 4), {"c_name": F.lit("x.x.x.x")})
    return out.select("c_custkey", "c_name", "c_nationkey")


_UPSERT = f"""SELECT {ORDER_SQL} FROM (SELECT * FROM order_updates UNION ALL SELECT * FROM orders_dev d
    WHERE NOT EXISTS (SELECT 1 FROM order_updates u WHERE u.o_orderkey = d.o_orderkey AND u.o_custkey = d.o_custkey))"""


@query("dml_upsert", _UPSERT)
def _(t):
    return order_rows(dml.upsert(t.orders_dev, t.order_updates, ["o_orderkey", "o_custkey"]))


@query(
    "dml_insert_new",
    f"""SELECT {ORDER_SQL} FROM (SELECT * FROM orders_dev UNION ALL SELECT * FROM order_updates u
    WHERE NOT EXISTS (SELECT 1 FROM orders_dev d WHERE u.o_orderkey = d.o_orderkey))""",
)
def _(t):
    return order_rows(dml.insert_new(t.orders_dev, t.order_updates, ["o_orderkey"]))


@query(
    "dml_upsert_null",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM (SELECT * FROM order_updates UNION ALL SELECT * FROM orders_dev d
    WHERE NOT EXISTS (SELECT 1 FROM order_updates u WHERE u.o_orderkey = d.o_orderkey)) WHERE o_totalprice IS NULL""",
)
def _(t):
    merged = dml.upsert(t.orders_dev, t.order_updates, ["o_orderkey"])
    return merged.where(F.col("o_totalprice").isNull()).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("dml_insert", f"SELECT {ORDER_SQL} FROM (SELECT * FROM orders_dev UNION ALL SELECT * FROM order_updates)")
def _(t):
    return order_rows(dml.insert_rows(t.orders_dev, t.order_updates))


@query(
    "drop_file",
    "SELECT l_linestatus, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1",
)
def _(t):
    path = t.scratch("files")
    sinks.partitioned(t.lineitem.select("l_orderkey", "l_linestatus", "l_returnflag"), path, "l_returnflag")
    # The listing decides; files that go are never opened.
    listing = objects.scan_binary(t.spark, path, "*.parquet").select("path")
    left = objects.read_files(t.spark, path, listing.where(~F.col("path").contains("/l_returnflag=A/")))
    return left.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))
