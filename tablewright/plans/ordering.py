"""Registered queries: sort, limit, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates
from tablewright.plans.registry import query


@query("latest_value", "SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS latest_year FROM orders")
def _(t):
    return t.orders.agg(F.year(F.max("o_orderdate")).alias("latest_year"))


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


@query("sort_all", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def _(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy("c_acctbal", "c_custkey")


@query("best_run", "SELECT run_id, branch, status, metric FROM runs WHERE status = 'FINISHED' ORDER BY metric DESC, run_id LIMIT 1")
def _(t):
    return aggregates.best_run(t.runs)


@query(
    "union_summaries",
    """SELECT 'by_status' AS summary, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
    UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY ALL""",
)
def _(t):
    frames = {
        "by_status": t.orders.groupBy(F.col("o_orderstatus").alias("value")).agg(F.count(F.lit(1)).alias("n")),
        "by_priority": t.orders.groupBy(F.col("o_orderpriority").alias("value")).agg(F.count(F.lit(1)).alias("n")),
    }
    return aggregates.union_labelled(frames, "summary")


@query(
    "prod_vs_dev",
    """SELECT 'Prod' AS ref, round(sum(o_totalprice), 2) AS total FROM orders
    UNION ALL SELECT 'Dev', round(sum(o_totalprice), 2) FROM orders_dev""",
)
def _(t):
    refs = {"Prod": t.orders, "Dev": t.orders_dev}
    return aggregates.union_labelled({n: df.agg(F.round(F.sum("o_totalprice"), 2).alias("total")) for n, df in refs.items()}, "ref")
