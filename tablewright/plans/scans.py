"""Registered queries: sources. Each file a query scans is first written from the given tables."""

from __future__ import annotations

from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablewright.functions import paths
from tablewright.plans.registry import query
from tablewright.plans.shapes import ORDER_SQL, order_rows
from tablewright.sources import objects, scans, sinks
from tablewright.sources.snapshots import SnapshotStore


@query("scan_csv_schema", "SELECT * FROM customer")
def _(t):
    path = t.scratch("csv")
    t.customer.write.option("header", True).csv(path)
    return scans.csv(t.spark, path, t.customer.schema)


@query("scan_csv_inferred", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def _(t):
    path = t.scratch("csv")
    t.part.write.option("header", True).csv(path)
    return scans.csv(t.spark, path).select(F.col("p_partkey").cast("bigint"), "p_name", "p_size", "p_retailprice")


@query(
    "scan_csv_positional",
    """SELECT CAST(s_suppkey AS VARCHAR) AS _c0, s_name AS _c1, CAST(s_nationkey AS VARCHAR) AS _c2,
    CAST(s_acctbal AS VARCHAR) AS _c3 FROM supplier""",
)
def _(t):
    path = t.scratch("csv")
    t.supplier.write.csv(path)
    return scans.csv_positional(t.spark, path)


@query("scan_json_multiline", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(t):
    path = t.scratch("json")
    # one document per 1,000 customer keys, so no document grows with the table
    docs = t.customer.groupBy(F.floor(F.col("c_custkey") / 1000).alias("doc")).agg(
        F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_nationkey")), {"pretty": "true"}).alias("value")
    )
    docs.write.partitionBy("doc").text(path)
    return scans.json_documents(t.spark, path).select("c_custkey", "c_name", F.col("c_nationkey").cast("int"))


@query("scan_json_lines", "SELECT event_id, event_type, user_id, value FROM events")
def _(t):
    path = t.scratch("json")
    t.events.write.json(path)
    return scans.json_lines(t.spark, path).select("event_id", "event_type", "user_id", "value")


@query("scan_parquet_glob", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    path = t.scratch("parquet")
    t.supplier.write.parquet(path)
    return t.spark.read.parquet(f"{path}/*.parquet").select("s_suppkey", "s_name")


@query(
    "scan_text",
    r"""SELECT count(*) AS n_lines, count(*) FILTER (WHERE line = '') AS n_blank, CAST(sum(length(line)) AS BIGINT) AS n_chars
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
)
def _(t):
    path = t.scratch("text")
    t.documents.select("text").write.option("lineSep", "\n").text(path)
    return scans.text_lines(t.spark, path).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("value") == "").alias("n_blank"), F.sum(F.length("value")).alias("n_chars")
    )


def _bitmaps(t) -> str:
    """One small gray image per vector, 8 pixels high and 4 + label wide."""

    @F.pandas_udf("binary")
    def draw(vector: pd.Series, width: pd.Series) -> pd.Series:
        def one(v, w):
            pixels = np.clip(np.resize(np.asarray(v) * 255 + 128, w * 8), 0, 255).astype("uint8")
            return objects.gray_bitmap(w, 8, pixels.tolist())

        return pd.Series([one(v, w) for v, w in zip(vector, width)])

    folder = t.scratch("images")
    images = t.embeddings.select(
        F.format_string("img-%d.bmp", "vec_id").alias("name"), draw("embedding", F.col("label") + 4).alias("content")
    )
    objects.write_objects(images, folder).write.format("noop").mode("overwrite").save()
    return folder


@query(
    "scan_binary_manifest",
    """SELECT 'img-' || vec_id || '.bmp' AS name, CAST(54 + 8 * (4 * ceil(3 * (4 + label) / 4.0)) AS BIGINT) AS length FROM embeddings""",
)
def _(t):
    found = objects.scan_binary(t.spark, _bitmaps(t), "*.bmp")
    return found.select(paths.base_name(F.col("path")).alias("name"), "length")


@query("scan_image_dims", "SELECT 'img-' || vec_id || '.bmp' AS name, 4 + label AS width, 8 AS height FROM embeddings")
def _(t):
    found = objects.scan_images(t.spark, _bitmaps(t))
    return found.select(paths.base_name(F.col("origin")).alias("name"), "width", "height")


@query(
    "inline_table",
    """SELECT rank, o_orderpriority, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3),
    ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) v(p, rank) ON p = o_orderpriority GROUP BY ALL""",
)
def _(t):
    data = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]
    ranks = t.spark.createDataFrame(data, "o_orderpriority string, rank int")
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(ranks, "o_orderpriority").select("rank", "o_orderpriority", "n")


_YEARS = [(y, date(y, 1, 1), 0.5 + 0.25 * (y - 1995)) for y in range(1995, 2002)]


@query(
    "insert_values",
    "SELECT year, strftime(starts, '%Y-%m-%d') AS starts, CAST(rate AS DOUBLE) AS rate, count(*) AS n FROM orders JOIN (VALUES "
    + ", ".join(f"({y}, DATE '{d}', {r})" for y, d, r in _YEARS)
    + ") v(year, starts, rate) ON year = year(o_orderdate) GROUP BY ALL",
)
def _(t):
    db = sinks.own_database(t.spark)
    t.spark.sql(f"CREATE TABLE {db}.rates (year INT, starts DATE, rate DOUBLE) USING parquet")
    values = ", ".join(f"({y}, DATE '{d}', {r}D)" for y, d, r in _YEARS)
    t.spark.sql(f"INSERT INTO {db}.rates VALUES {values}")
    counts = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(t.spark.table(f"{db}.rates"), "year").select(
        "year", F.date_format("starts", "yyyy-MM-dd").alias("starts"), "rate", "n"
    )


def two_branches(t) -> SnapshotStore:
    """orders on main (tagged v1), edited on branch dev, hot-fixed on main afterwards."""
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "orders", t.orders, "load orders")
    store.tag("v1", "main")
    store.create_branch("dev", "main")
    store.overwrite("dev", "orders", t.orders_dev, "edit orders")
    store.overwrite("main", "orders", t.orders_hotfix, "hotfix")
    return store


@query("read_at_ref", f"SELECT {ORDER_SQL} FROM orders")
def _(t):
    return order_rows(two_branches(t).read("orders", "v1"))


@query("read_version", f"SELECT {ORDER_SQL} FROM orders_hotfix")
def _(t):
    return order_rows(two_branches(t).read_version("orders", "main", 1))


@query("read_branch", f"SELECT {ORDER_SQL} FROM orders_dev")
def _(t):
    return order_rows(two_branches(t).read("orders", "dev"))


@query("table_files", """SELECT 'orders' AS "table", count(*) AS n_rows, true AS each_file_once, true AS sizes_known FROM orders_dev""")
def _(t):
    files = two_branches(t).files("dev")
    return files.groupBy("table").agg(
        F.sum("n_rows").alias("n_rows"), (F.count_distinct("file_path") == F.count(F.lit(1))).alias("each_file_once"),
        (F.min("file_size") > 0).alias("sizes_known"),
    )


@query(
    "table_history",
    """SELECT 'main' AS branch, CAST(0 AS BIGINT) AS version, 'load orders' AS message, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'dev', 1, 'edit orders', count(*) FROM orders_dev UNION ALL SELECT 'main', 1, 'hotfix', count(*) FROM orders_hotfix""",
)
def _(t):
    store = two_branches(t)
    log = store.commits().select("branch", F.when(F.col("branch") == "dev", 1).otherwise(F.col("version")).cast("bigint").alias("version"), "message")
    sizes = None
    for branch, version in (("main", 0), ("main", 1), ("dev", None)):
        df = store.read("orders", "dev") if version is None else store.read_version("orders", branch, version)
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(branch).alias("branch"), F.lit(1 if version is None else version).cast("bigint").alias("version"), "n_rows"
        )
        sizes = one if sizes is None else sizes.unionByName(one)
    return log.join(sizes, ["branch", "version"])


@query(
    "list_prefix",
    """SELECT 'docs/' || split_part(path, '/', 2) || '/' AS entry, count(*) AS n_objects, CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
    'common_prefix' AS path_type FROM manifest_main GROUP BY 1""",
)
def _(t):
    return objects.list_prefix(t.manifest_main, "docs/")


@query(
    "list_suffix",
    "SELECT path, size_bytes FROM manifest_main WHERE path LIKE 'docs/en/%' AND path LIKE '%.txt'",
)
def _(t):
    return t.manifest_main.where(F.col("path").startswith("docs/en/") & F.col("path").endswith(".txt")).select("path", "size_bytes")


@query(
    "import_prefixes",
    """SELECT CASE WHEN path LIKE 'docs/en/%' THEN 'raw/english/' || substr(path, 9) ELSE 'raw/other/' || substr(path, 6) END AS path,
    checksum, size_bytes, path AS source_path FROM manifest_main""",
)
def _(t):
    return objects.import_prefixes(t.manifest_main, {"docs/en/": "raw/english/", "docs/": "raw/other/"})


@query(
    "import_by_label",
    """SELECT path, replace(path, 'docs/', 'notes/') AS paired_path, size_bytes FROM manifest_main WHERE path LIKE '%/src1/%'""",
)
def _(t):
    return objects.import_by_label(t.manifest_main, "src1", ("docs/", "notes/"))


_LINEITEM = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    "describe_table",
    " UNION ALL ".join(
        f"""SELECT 'lineitem' AS "table", count(*) AS n_rows, {i} AS position, '{c}' AS "column", '{ty}' AS type, count({c}) AS n_values
        FROM lineitem"""
        for i, (c, ty) in enumerate(_LINEITEM.items())
    ),
)
def _(t):
    return scans.describe(t.lineitem, "lineitem")
