"""The given tables, and inputs derived from them so that every operator and gate has work to do.

Each derived input is a SQL text over the whole tables. The divisors in them place defects and
changes (every 37th order is repriced, every 53rd loses its customer, ...); no row is left out to
make a query cheaper. Spark and the SQL checks read the same definitions, except where the two
dialects differ, in which case both texts are given.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import apply_settings, scratch

GIVEN = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_HAS_ORDERS = "NOT EXISTS (SELECT 1 FROM {customer} WHERE c_custkey = o_custkey AND c_nationkey = 7)"

DERIVED: dict[str, str | tuple[str, str]] = {
    # branch "ours": repriced, removed and new orders; one nation loses all of its orders
    "orders_dev": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 37 = 0 THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {{orders}} WHERE o_orderkey % 50 <> 0 AND {_HAS_ORDERS}
        UNION ALL
        SELECT o_orderkey + 10000000, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
        FROM {{orders}} WHERE o_orderkey % 101 = 0 AND {_HAS_ORDERS}""",
    # branch "theirs": overlaps orders_dev so that both kinds of conflict occur
    "orders_hotfix": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_orderkey % 185 = 0 THEN o_totalprice - 50 ELSE o_totalprice END AS o_totalprice,
               o_orderdate,
               CASE WHEN o_orderkey % 41 = 0 THEN 'HOTFIX' ELSE o_orderpriority END AS o_orderpriority
        FROM {orders} WHERE o_orderkey % 111 <> 0""",
    # upsert source: matched rows, new rows, and nulls that must overwrite
    "order_updates": """
        SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus,
               CASE WHEN o_orderkey % 70 = 3 THEN NULL ELSE o_totalprice * 2 END AS o_totalprice,
               o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 10 = 3
        UNION ALL
        SELECT o_orderkey + 20000000, o_custkey, 'I', o_totalprice, o_orderdate, o_orderpriority
        FROM {orders} WHERE o_orderkey % 97 = 0""",
    # all-string orders, one defect family per divisor
    "orders_dirty": """
        SELECT o_orderkey AS row_no,
               CASE WHEN o_orderkey % 211 = 0 THEN '  '
                    WHEN o_orderkey % 97 = 1 THEN 'ORD-1'
                    ELSE 'ORD-' || cast(o_orderkey AS string) END AS order_id,
               CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'CUST-' || cast(o_custkey AS string) END AS customer_id,
               CASE WHEN o_orderkey % 61 = 0 THEN '01/17/2024'
                    WHEN o_orderkey % 67 = 0 THEN '2024-13-01'
                    WHEN o_orderkey % 71 = 0 THEN '2022-06-15'
                    WHEN o_orderkey % 107 = 0 THEN '03/04/2024'
                    ELSE '2024-01-15' END AS order_date,
               CASE WHEN o_orderkey % 73 = 0 THEN 'abc'
                    WHEN o_orderkey % 79 = 0 THEN '-50.00'
                    WHEN o_orderkey % 83 = 0 THEN 'nan'
                    WHEN o_orderkey % 89 = 0 THEN '420.00'
                    WHEN o_orderkey % 103 = 0 THEN '1d'
                    ELSE '150.50' END AS amount,
               CASE WHEN o_orderkey % 43 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
               CASE WHEN o_orderkey % 47 = 0 THEN 'SHIPPED'
                    WHEN o_orderkey % 59 = 0 THEN 'unknown_status'
                    WHEN o_orderstatus = 'F' THEN 'completed'
                    WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'shipped' END AS status,
               CASE WHEN o_orderkey % 31 = 0 THEN 'Electronics' ELSE 'books' END AS product_category
        FROM {orders}""",
    # nulls and NaN in numbers and strings
    "customer_nulls": """
        SELECT c_custkey, nullif(c_name, '') AS c_name,
               CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
               CASE WHEN c_custkey % 23 = 0 THEN cast('nan' AS double)
                    WHEN c_custkey % 29 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM {customer}""",
    # child rows without a parent
    "orders_orphans": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 19 = 0 THEN o_custkey + 9000000 ELSE o_custkey END AS o_custkey,
               o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM {orders}""",
    # object listing of the published ref; some content occurs under several paths
    "manifest_main": """
        SELECT 'docs/' || lang || '/' || source || '/' || cast(doc_id AS string) || '.txt' AS path,
               md5(text) AS checksum, n_chars AS size_bytes
        FROM {documents}""",
    # object listing of the changed ref
    "manifest_dev": """
        SELECT 'docs/' || lang || '/' || source || '/' || cast(doc_id AS string) || '.txt' AS path,
               CASE WHEN doc_id % 33 = 0 THEN md5(text || '!') ELSE md5(text) END AS checksum,
               CASE WHEN doc_id % 33 = 0 THEN n_chars + 1 ELSE n_chars END AS size_bytes
        FROM {documents} WHERE doc_id % 40 <> 0
        UNION ALL
        SELECT 'docs/new/' || cast(doc_id AS string) || '.txt', md5(text), n_chars
        FROM {documents} WHERE doc_id % 45 = 0""",
    # the documents themselves on the changed ref
    "documents_dev": """
        SELECT doc_id, CASE WHEN doc_id % 33 = 0 THEN text || '!' ELSE text END AS text, lang, source
        FROM {documents} WHERE doc_id % 40 <> 0
        UNION ALL
        SELECT doc_id + 10000000, text, lang, source FROM {documents} WHERE doc_id % 45 = 0""",
    # linear commit chain, one touched prefix per commit
    "commits": """
        SELECT 'c' || cast(event_id AS string) AS commit_id,
               CASE WHEN event_id = (SELECT min(event_id) FROM {events}) THEN NULL
                    ELSE 'c' || cast(event_id - 1 AS string) END AS parent_id,
               'tables/' || event_type || '/' AS prefix,
               cast(user_id AS string) AS committer, ts
        FROM {events}""",
    # labels with some predictions flipped
    "predictions": """
        SELECT doc_id, quality AS label,
               CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END AS pred
        FROM {labels}""",
    # one experiment run per source of labelled documents; small sources did not finish
    "runs": """
        SELECT 'run-' || source AS run_id, 'exp/' || source AS branch,
               CASE WHEN count(*) < 5 THEN 'FAILED' ELSE 'FINISHED' END AS status,
               round(avg(CASE WHEN label = pred THEN cast(1 AS double) ELSE cast(0 AS double) END), 6) AS metric
        FROM {predictions} p JOIN {documents} d ON p.doc_id = d.doc_id
        GROUP BY source""",
    # receipt records, each rule broken by some divisor; goods + fee are the line items
    "receipts": """
        SELECT 'r' || cast(o_orderkey AS string) || '.jpg' AS source_file,
               CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE 'vendor ' || cast(o_custkey AS string) END AS vendor,
               CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN '2021-03-01'
                    WHEN o_orderkey % 41 = 0 THEN '2031-01-01' ELSE '2026-01-20' END AS date_iso,
               CASE WHEN o_orderkey % 43 = 0 THEN 'eur' WHEN o_orderkey % 47 = 0 THEN '' ELSE 'usd' END AS currency,
               CASE WHEN o_orderkey % 53 = 0 THEN 'n/a' WHEN o_orderkey % 59 = 0 THEN '$1,234.50'
                    ELSE '$10.00' END AS total,
               CASE WHEN o_orderkey % 61 = 0 THEN '8.00' WHEN o_orderkey % 59 = 0 THEN '$1,233.50'
                    ELSE '9.00' END AS goods,
               CASE WHEN o_orderkey % 71 = 0 THEN 'n/a' ELSE '1.00' END AS fee,
               CASE WHEN o_orderkey % 67 = 0 THEN ''
                    WHEN o_orderkey % 15 = 0 THEN 'INV-' || cast(o_orderkey + 1 AS string)
                    ELSE 'INV-' || cast(o_orderkey AS string) END AS invoice_no
        FROM {orders}""",
    # inbox files: byte-identical copies, unreadable files, files that are no receipt
    "inbox": """
        SELECT 'f' || lpad(cast(doc_id AS string), 12, '0') AS file, text AS content,
               doc_id % 17 <> 0 AS readable, doc_id % 11 <> 0 AS is_receipt
        FROM {documents}""",
    # order dates as people print them
    "printed_dates": (
        """
        SELECT o_orderkey,
               CASE o_orderkey % 12 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
                                   WHEN 1 THEN date_format(o_orderdate, 'M/d/yyyy')
                                   WHEN 2 THEN date_format(o_orderdate, 'MMM d, yyyy')
                                   WHEN 3 THEN date_format(o_orderdate, 'd MMM yyyy')
                                   WHEN 4 THEN date_format(o_orderdate, 'yyyy/MM/dd')
                                   WHEN 5 THEN date_format(o_orderdate, 'MMMM d, yyyy')
                                   WHEN 6 THEN date_format(o_orderdate, 'MMM d yyyy')
                                   WHEN 7 THEN date_format(o_orderdate, 'yyyy.MM.dd')
                                   WHEN 8 THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
                                   WHEN 9 THEN CASE WHEN day(o_orderdate) > 12 THEN date_format(o_orderdate, 'd/M/yyyy') ELSE '31/31/1999' END
                                   WHEN 10 THEN '  ' ELSE 'not a date' END AS printed
        FROM {orders}""",
        """
        SELECT o_orderkey,
               CASE o_orderkey % 12 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                   WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                                   WHEN 2 THEN strftime(o_orderdate, '%b %-d, %Y')
                                   WHEN 3 THEN strftime(o_orderdate, '%-d %b %Y')
                                   WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d')
                                   WHEN 5 THEN strftime(o_orderdate, '%B %-d, %Y')
                                   WHEN 6 THEN strftime(o_orderdate, '%b %-d %Y')
                                   WHEN 7 THEN strftime(o_orderdate, '%Y.%m.%d')
                                   WHEN 8 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
                                   WHEN 9 THEN CASE WHEN day(o_orderdate) > 12 THEN strftime(o_orderdate, '%-d/%-m/%Y') ELSE '31/31/1999' END
                                   WHEN 10 THEN '  ' ELSE 'not a date' END AS printed
        FROM {orders}""",
    ),
    # one folder descriptor per language and for some sources
    "descriptors": """
        SELECT DISTINCT 'docs/' || lang || '/dataset_metadata.yaml' AS path FROM {documents} WHERE lang <> 'de'
        UNION ALL
        SELECT DISTINCT 'docs/' || lang || '/' || source || '/dataset_metadata.yaml' FROM {documents}
        WHERE length(source) % 2 = 0""",
    # run-length masks, 1-based (start, length) pairs over 100-pixel-high columns, several per image
    "masks": """
        SELECT l_orderkey AS image_id, l_linenumber AS mask_no, l_partkey AS part_no,
               cast(1 + l_partkey % 5000 AS string) || ' ' || cast(cast(l_quantity AS bigint) AS string) || ' ' ||
               cast(1 + l_suppkey * 100 AS string) || ' ' || cast(1 + l_linenumber AS string) AS encoded_pixels
        FROM {lineitem}""",
}


def _refs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Tables:
    """``tables.orders`` is a given table, ``tables.orders_dev`` a derived one; both are lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in DERIVED:
            text = DERIVED[name]
            sql = text if isinstance(text, str) else text[0]
            return self.spark.sql(sql, **{ref: getattr(self, ref) for ref in _refs(sql)})
        raise AttributeError(name)

    def scratch(self, label: str = "work") -> str:
        return scratch(self.spark, label)


def check_sql(sql: str) -> str:
    """Put the derived inputs a check query names in front of it as CTEs."""
    ctes: dict[str, str] = {}

    def need(name: str) -> None:
        if name in ctes:
            return
        text = DERIVED[name]
        body = text if isinstance(text, str) else text[1]
        for ref in _refs(body):
            if ref in DERIVED:
                need(ref)
        ctes[name] = re.sub(r"\{(\w+)\}", r"\1", body)

    for name in DERIVED:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    if not ctes:
        return sql
    head = ",\n".join(f"{name} AS ({body.strip()})" for name, body in ctes.items())
    found = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, flags=re.I)
    if found:
        return f"WITH {found.group(1) or ''}{head},\n{sql[found.end():]}"
    return f"WITH {head}\n{sql}"
