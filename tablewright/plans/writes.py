"""Registered queries: sinks, each read back after the write."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import dml
from tablewright.plans.registry import query
from tablewright.plans.shapes import ORDER_SQL, order_rows
from tablewright.sources import sinks
from tablewright.sources.snapshots import SnapshotStore


def _store(t) -> SnapshotStore:
    return SnapshotStore(t.spark, t.scratch("store"))


@query("write_overwrite", f"SELECT {ORDER_SQL} FROM orders_hotfix")
def _(t):
    store = _store(t)
    store.overwrite("main", "orders", t.orders)
    store.overwrite("main", "orders", t.orders_hotfix)
    return order_rows(store.read("orders", "main"))


@query("write_append", f"SELECT {ORDER_SQL} FROM orders UNION ALL SELECT {ORDER_SQL} FROM order_updates")
def _(t):
    store = _store(t)
    store.overwrite("main", "orders", t.orders)
    store.append("main", "orders", t.order_updates)
    return order_rows(store.read("orders", "main"))


@query(
    "write_partitioned",
    """SELECT coalesce(c_mktsegment, '__HIVE_DEFAULT_PARTITION__') AS c_mktsegment, count(*) AS n, sum(c_custkey)::BIGINT AS keys
    FROM customer_nulls GROUP BY 1""",
)
def _(t):
    path = t.scratch("by-segment")
    sinks.partitioned(t.customer_nulls, path, "c_mktsegment")
    back = t.spark.read.parquet(path)
    return back.groupBy(F.coalesce("c_mktsegment", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("c_mktsegment")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys")
    )


@query(
    "write_partitioned_multi",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM lineitem GROUP BY ALL",
)
def _(t):
    path = t.scratch("by-flag")
    cols = t.lineitem.select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity")
    sinks.partitioned(cols, path, "l_returnflag", "l_linestatus")
    return t.spark.read.parquet(path).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys")
    )


@query("save_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    db = sinks.own_database(t.spark)
    t.customer.select("c_custkey", "c_name", "c_mktsegment").write.saveAsTable(f"{db}.customer")
    return t.spark.table(f"{db}.customer")


@query("ctas_agg", "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    db = sinks.own_database(t.spark)
    t.spark.sql(
        f"""CREATE TABLE {db}.agg_priority USING parquet AS
        SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {{orders}} GROUP BY o_orderpriority""",
        orders=t.orders,
    )
    return t.spark.table(f"{db}.agg_priority")


@query("insert_select", "SELECT c_custkey, c_nationkey FROM customer_nulls WHERE c_nationkey NOT IN (10, 15, 2, 1, 6)")
def _(t):
    db = sinks.own_database(t.spark)
    t.spark.sql(f"CREATE TABLE {db}.silver (c_custkey BIGINT, c_nationkey INT) USING parquet")
    t.spark.sql(
        f"INSERT INTO {db}.silver SELECT c_custkey, c_nationkey FROM {{bronze}} WHERE c_nationkey NOT IN (10, 15, 2, 1, 6)",
        bronze=t.customer_nulls,
    )
    return t.spark.table(f"{db}.silver")


@query("gold_partitioned", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    db = sinks.own_database(t.spark)
    t.spark.sql(f"CREATE TABLE {db}.gold (o_orderkey BIGINT, o_orderstatus STRING, year INT) USING parquet PARTITIONED BY (year)")
    t.spark.sql(
        f"INSERT INTO {db}.gold SELECT /*+ REBALANCE(year) */ o_orderkey, o_orderstatus, year FROM (SELECT *, year(o_orderdate) AS year FROM {{orders}})",
        orders=t.orders,
    )
    return t.spark.table(f"{db}.gold").groupBy("year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "overwrite_partitions",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice * 2 ELSE o_totalprice END), 2) AS total
    FROM orders GROUP BY 1""",
)
def _(t):
    store = SnapshotStore(t.spark, t.scratch("by-year"))
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    store.replace_partitions("main", "orders", rows, ["year"], "load")
    fixed = rows.where("year = 1998").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    store.replace_partitions("main", "orders", fixed, ["year"])
    return store.read("orders", "main").groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "append_merge_schema",
    """SELECT o_orderkey, o_totalprice, NULL AS channel FROM orders UNION ALL
    SELECT o_orderkey, o_totalprice, 'web' FROM order_updates""",
)
def _(t):
    store = _store(t)
    store.overwrite("main", "orders", t.orders.select("o_orderkey", "o_totalprice"))
    store.append("main", "orders", t.order_updates.select("o_orderkey", "o_totalprice", F.lit("web").alias("channel")))
    return store.read("orders", "main", merge_schema=True)


@query(
    "append_strict",
    """SELECT 'refused' AS wider, count(*) AS n_rows FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM order_updates)""",
)
def _(t):
    try:
        dml.append_strict(t.orders, t.order_updates.withColumn("channel", F.lit("web")))
        wider = "accepted"
    except dml.SchemaDrift:
        wider = "refused"
    same = dml.append_strict(t.orders, t.order_updates)
    return same.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(wider).alias("wider"), "n_rows")


@query("overwrite_schema", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18, 2))::VARCHAR AS o_totalprice, 'web' AS channel FROM orders")
def _(t):
    store = _store(t)
    store.overwrite("main", "orders", t.orders)
    store.overwrite("main", "orders", t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"), F.lit("web").alias("channel")))
    return store.read("orders", "main")


@query(
    "report_rows",
    "SELECT 'orders' AS dataset, count(*) AS rows_in, count(*) FILTER (WHERE currency = 'USD') AS rows_out FROM orders_dirty",
)
def _(t):
    path = t.scratch("report")
    report = t.orders_dirty.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("currency") == "USD").alias("rows_out"))
    report.select(F.lit("orders").alias("dataset"), "rows_in", "rows_out").write.json(path)
    return t.spark.read.schema("dataset string, rows_in long, rows_out long").json(path)


@query("materialize_join", "SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    path = t.scratch("joined")
    t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_name").write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "export_manifest",
    """SELECT 'orders' AS "table", 'main' AS ref, count(*) AS n_rows, 6 AS n_columns, 'o_orderkey' AS first_column FROM orders""",
)
def _(t):
    store = _store(t)
    store.overwrite("main", "orders", t.orders)
    listed = sinks.export_manifest(store.read("orders", "main"), "orders", "main")
    names = F.from_json(F.get_json_object("schema_json", "$.fields"), F.lit("array<struct<name:string>>"))
    return listed.groupBy("table", "ref", F.size(names).alias("n_columns"), names[0]["name"].alias("first_column")).agg(F.sum("n_rows").alias("n_rows"))


@query("write_coalesced", "SELECT count(*) AS n_rows, true AS few_files FROM lineitem")
def _(t):
    path = t.scratch("training")
    sinks.rebalanced(t.lineitem.select("l_orderkey", "l_quantity"), path)
    files = t.spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size")
    back = files.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("n"))
    # few: a file for every 8 MB at most, and one for the rest
    return back.agg(F.sum("n").alias("n_rows"), (F.count(F.lit(1)) <= 1 + F.sum("file_size") / (8 << 20)).alias("few_files"))
