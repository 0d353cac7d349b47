"""Registered queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import arrays, dates, numbers, paths, text
from tablewright.plans.registry import query


@query("fn_basename", "SELECT path, split_part(path, '/', -1) AS base_name FROM manifest_main")
def _(t):
    return t.manifest_main.select("path", paths.base_name(F.col("path")).alias("base_name"))


@query("fn_cast", "SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS price_text, CAST(p_size AS DOUBLE) AS size_number FROM part")
def _(t):
    return t.part.select(
        "p_partkey", F.col("p_retailprice").cast("string").alias("price_text"), F.col("p_size").cast("double").alias("size_number")
    )


@query("fn_to_number", "SELECT row_no, TRY_CAST(amount AS DOUBLE) AS amount FROM orders_dirty")
def _(t):
    return t.orders_dirty.select("row_no", F.expr(numbers.to_number("amount")).alias("amount"))


@query("fn_rand", "SELECT count(*) AS n_rows, true AS in_range, true AS centred, true AS distinct_values FROM customer")
def _(t):
    """Bounds, mean (six deviations) and hardly a repeat: what uniform numbers owe whatever the seed."""
    drawn = t.customer.select("c_custkey", F.rand(10).alias("amount"))
    n = F.count(F.lit(1))
    return drawn.agg(
        n.alias("n_rows"), ((F.min("amount") >= 0) & (F.max("amount") < 1)).alias("in_range"),
        (F.abs(F.avg("amount") - 0.5) <= 6 * F.sqrt(1 / (12 * n))).alias("centred"),
        (F.approx_count_distinct("amount") >= 0.8 * n).alias("distinct_values"),
    )


@query("fn_parse_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed FROM events")
def _(t):
    iso = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
    return iso.selectExpr("event_id", f"date_format({dates.parse_timestamp('iso')}, 'yyyy-MM-dd HH:mm:ss') AS parsed")


@query("fn_ts_label", "SELECT event_id, strftime(ts, '_%Y-%m-%d_%H-%M-%S') AS label FROM events")
def _(t):
    return t.events.select("event_id", F.expr(dates.ts_label("ts")).alias("label"))


@query(
    "fn_valid_date",
    """SELECT row_no, regexp_matches(order_date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') AND TRY_CAST(order_date AS DATE) IS NOT NULL AS valid
    FROM orders_dirty""",
)
def _(t):
    return t.orders_dirty.select("row_no", F.expr(dates.is_calendar_date("order_date")).alias("valid"))


@query("fn_normalize", "SELECT source_file, upper(trim(coalesce(currency, ''))) AS currency, nullif(trim(vendor), '') IS NOT NULL AS has_vendor FROM receipts")
def _(t):
    return t.receipts.select(
        "source_file", F.expr(text.tidy_upper("currency")).alias("currency"), F.expr(text.present("vendor")).alias("has_vendor")
    )


@query("parse_amount", "SELECT source_file, TRY_CAST(trim(replace(replace(total, '$', ''), ',', '')) AS DOUBLE) AS total FROM receipts")
def _(t):
    return t.receipts.select("source_file", F.expr(numbers.parse_amount("total")).alias("total"))


@query(
    "to_iso_date",
    """SELECT p.o_orderkey, printed, CASE WHEN p.o_orderkey % 12 < 9 OR p.o_orderkey % 12 = 9 AND day(o_orderdate) > 12 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS iso
    FROM printed_dates p JOIN orders o ON o.o_orderkey = p.o_orderkey""",
)
def _(t):
    return t.printed_dates.select("o_orderkey", "printed", F.expr(dates.to_iso_date("printed")).alias("iso"))


@query("json_to_map", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS absent FROM events")
def _(t):
    flat = t.events.select("event_id", arrays.flat_json(F.col("props"), {"k": "$.k", "none": "$.none"}).alias("m"))
    return flat.select("event_id", F.col("m")["k"].alias("k"), F.col("m")["none"].alias("absent"))


@query(
    "fn_path_parts",
    """SELECT path, regexp_replace(path, '/[^/]*$', '') AS parent, '.txt' AS suffix,
    regexp_replace(path, '/[^/]*$', '') || '/index.yaml' AS sibling FROM manifest_main""",
)
def _(t):
    p = F.col("path")
    return t.manifest_main.select(
        "path", paths.parent(p).alias("parent"), paths.suffix(p).alias("suffix"),
        paths.join(paths.parent(p), F.lit("index.yaml")).alias("sibling"),
    )


@query(
    "fn_bbox",
    """SELECT l_orderkey, l_linenumber, l_partkey AS x0, l_suppkey AS y0, l_partkey + CAST(l_quantity AS BIGINT) AS x1,
    l_suppkey + l_linenumber AS y1 FROM lineitem""",
)
def _(t):
    box = arrays.corners(F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity").cast("bigint"), F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", box.alias("b")).select("l_orderkey", "l_linenumber", "b.*")


@query(
    "fn_scale_array",
    "SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) / 255)), 8) AS total, CAST(len(embedding) AS INTEGER) AS n FROM embeddings",
)
def _(t):
    scaled = arrays.scale(F.col("embedding"))
    return t.embeddings.select(
        "vec_id", F.round(F.aggregate(scaled, F.lit(0.0), lambda s, v: s + v), 8).alias("total"), F.size("embedding").alias("n")
    )
