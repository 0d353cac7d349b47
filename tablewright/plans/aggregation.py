"""Registered queries: aggregates and duplicate handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import dates
from tablewright.functions.arrays import map_total
from tablewright.functions.text import tidy
from tablewright.operators import aggregates, dedup, features, lineage
from tablewright.plans.registry import query
from tablewright.session import persist_to_shared
from tablewright.sources import objects


@query("count_by", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("minmax", "SELECT count(*) AS n, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders")
def _(t):
    return t.orders.agg(
        F.count(F.lit(1)).alias("n"), F.year(F.min("o_orderdate")).alias("first_year"), F.year(F.max("o_orderdate")).alias("last_year")
    )


@query("sum_by", "SELECT n_regionkey, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    )


_DIMS = ["l_returnflag", "l_linestatus", "l_linenumber"]


@query(
    "dim_aggs",
    " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS n_rows,
        quantile_disc(l_extendedprice, 0.5) AS median_value, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value
        FROM lineitem GROUP BY {d}"""
        for d in _DIMS
    ),
)
def _(t):
    return aggregates.dim_aggregates(t.lineitem, _DIMS, "l_extendedprice")


@query(
    "map_total",
    "SELECT event_id, round(value + CAST(json_extract_string(props, '$.k') AS DOUBLE), 4) AS total FROM events",
)
def _(t):
    amounts = F.create_map(F.lit("value"), F.col("value"), F.lit("k"), F.get_json_object("props", "$.k").cast("double"))
    return t.events.select("event_id", F.round(map_total(amounts), 4).alias("total"))


@query("total_by_user", "SELECT user_id, round(sum(value), 2) AS total FROM events GROUP BY user_id")
def _(t):
    return t.events.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("total"))


@query("total_by_event_type", "SELECT event_type, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def _(t):
    return t.events.groupBy("event_type").agg(F.round(F.sum("value"), 2).alias("total"))


@query("total_by_month", "SELECT strftime(ts, '%Y-%m') AS month, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(F.expr(dates.month_of("ts")).alias("month")).agg(F.round(F.sum("value"), 2).alias("total"))


@query(
    "collect_per_key",
    """SELECT image_id, encoded_pixels AS value, count(*) AS "count", sum(count(*)) OVER (PARTITION BY image_id)::BIGINT AS n_total, true AS bounded
    FROM masks GROUP BY image_id, encoded_pixels""",
)
def _(t):
    """Texts of masks per image, laid out again one value a row; no list may be much longer than its block."""
    out = aggregates.values_per_key(t.masks, "image_id", "encoded_pixels")
    return out.select("image_id", "n_total", (F.size("values") <= 2000).alias("bounded"), F.inline("values"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_orderpriority").distinct()


@query("n_groups", "SELECT count(*) AS n_groups FROM (SELECT DISTINCT c_mktsegment FROM customer_nulls)")
def _(t):
    return t.customer_nulls.select("c_mktsegment").distinct().agg(F.count(F.lit(1)).alias("n_groups"))


@query(
    "count_by_ref",
    """SELECT 'main' AS ref, count(*) AS n_rows FROM orders UNION ALL SELECT 'dev', count(*) FROM orders_dev
    UNION ALL SELECT 'hotfix', count(*) FROM orders_hotfix""",
)
def _(t):
    return aggregates.count_by_ref({"main": t.orders, "dev": t.orders_dev, "hotfix": t.orders_hotfix})


_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "scale_features",
    "WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATURES)
    + " FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01') SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 5) AS {c}_scaled" for c in _FEATURES)
    + " FROM lineitem, s",
)
def _(t):
    scaler = features.Scaler.fit(t.lineitem.where("l_shipdate < timestamp_ntz '2000-01-01'"), _FEATURES)
    out = scaler.apply(t.lineitem)
    return out.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_scaled", 5).alias(f"{c}_scaled") for c in _FEATURES])


@query(
    "class_weights",
    """SELECT label, count(*) AS n, round((SELECT count(*) FROM predictions) /
    ((SELECT count(DISTINCT label) FROM predictions) * count(*)), 8) AS weight FROM predictions GROUP BY label""",
)
def _(t):
    return features.class_weights(t.predictions, "label").withColumn("weight", F.round("weight", 8))


@query(
    "binary_metrics",
    """SELECT count(*) AS n, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 8) AS accuracy,
    round(sum(label * pred) / sum(pred), 8) AS precision, round(sum(label * pred) / sum(label), 8) AS recall FROM predictions""",
)
def _(t):
    return features.binary_metrics(t.predictions).select(
        "n", *[F.round(c, 8).alias(c) for c in ("accuracy", "precision", "recall")]
    )


@query("confusion", "SELECT label, pred, count(*) AS n FROM predictions GROUP BY ALL")
def _(t):
    return features.confusion(t.predictions)


@query(
    "f1_scores",
    """WITH k AS (SELECT DISTINCT label AS k FROM predictions), c AS (SELECT k, count(*) FILTER (WHERE label = k AND pred = k) AS tp,
    count(*) FILTER (WHERE label <> k AND pred = k) AS fp, count(*) FILTER (WHERE label = k AND pred <> k) AS fn
    FROM predictions, k GROUP BY k)
    SELECT round(2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 8) AS f1_micro,
    round(sum((tp + fn) * 2.0 * tp / (2 * tp + fp + fn)) / sum(tp + fn), 8) AS f1_weighted FROM c""",
)
def _(t):
    return features.f1_scores(t.predictions).select(*[F.round(c, 8).alias(c) for c in ("f1_micro", "f1_weighted")])


@query(
    "iou_scores",
    """WITH c AS (SELECT source, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
    count(*) FILTER (WHERE label = 1 OR pred = 1) AS n FROM predictions JOIN documents USING (doc_id) GROUP BY source)
    SELECT round(avg(CASE WHEN n = 0 THEN 1.0 ELSE tp / n END), 8) AS iou_per_key, round(sum(tp) / sum(n), 8) AS iou_pooled FROM c""",
)
def _(t):
    keyed = t.predictions.join(t.documents.select("doc_id", "source"), "doc_id")
    return features.iou_scores(keyed, "source").select(*[F.round(c, 8).alias(c) for c in ("iou_per_key", "iou_pooled")])


WORDS_SQL = r"""SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY word"""


@query("word_count", WORDS_SQL)
def _(t):
    return aggregates.word_count(t.documents, "text")


@query(
    "usage_by_prefix",
    """SELECT split_part(path, '/', 1) || '/' || split_part(path, '/', 2) AS prefix, count(*) AS n_files,
    CAST(sum(size_bytes) AS BIGINT) AS n_bytes FROM manifest_main GROUP BY 1""",
)
def _(t):
    return objects.usage(t.manifest_main, levels=2)


@query(
    "dup_later",
    """SELECT row_no, order_id, first_row_no FROM (SELECT row_no, trim(order_id) AS order_id,
    min(row_no) OVER (PARTITION BY trim(order_id)) AS first_row_no FROM orders_dirty WHERE trim(order_id) <> '')
    WHERE row_no > first_row_no""",
)
def _(t):
    ids = t.orders_dirty.select("row_no", F.expr(tidy("order_id")).alias("order_id"))
    return dedup.later_duplicates(ids, F.nullif("order_id", F.lit("")), "row_no").select("row_no", "order_id", "first_row_no")


@query(
    "dedup_exact",
    """SELECT file, min(file) OVER (PARTITION BY sha256(content)) AS survivor,
    file = min(file) OVER (PARTITION BY sha256(content)) AS kept FROM inbox""",
)
def _(t):
    hashed = persist_to_shared(t.inbox.select("file", F.sha2("content", 256).alias("digest")), "digests")  # texts are read once
    out = dedup.keep_first(hashed, F.col("digest"), "file")
    return out.select("file", "survivor", (F.col("file") == F.col("survivor")).alias("kept"))


@query(
    "dup_all",
    """SELECT source_file, invoice_no, n_same FROM (SELECT source_file, invoice_no,
    count(*) OVER (PARTITION BY invoice_no) AS n_same FROM receipts WHERE invoice_no <> '') WHERE n_same > 1""",
)
def _(t):
    counted = dedup.shared_keys(t.receipts.select("source_file", "invoice_no"), F.expr(f"nullif({tidy('invoice_no')}, '')"), "source_file")
    return counted.where(F.col("n_same") > 1).select("source_file", "invoice_no", "n_same")


@query(
    "latest_commit",
    """SELECT prefix, commit_id, committer FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY ts DESC, commit_id DESC) AS r
    FROM commits) WHERE r = 1""",
)
def _(t):
    return lineage.latest_commit(t.commits).select("prefix", "commit_id", "committer")
