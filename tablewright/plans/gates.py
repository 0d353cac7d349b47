"""Registered queries: publish gates and order rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import paths
from tablewright.operators import clean, diff, gates, publish, rules
from tablewright.plans.registry import query
from tablewright.plans.shapes import joined_list
from tablewright.session import persist_to_shared
from tablewright.sources import footers, scans
from tablewright.sources.snapshots import SnapshotStore

# Example gate arguments.
BLOCKED = ["user_id", "email", "ssn", "private_*"]
COMMIT_RULES = {"notebook_url": "github.com/.*", "spark_version": None}
DESCRIPTOR = "dataset_metadata.yaml"
FIELD_RULES = [
    {"name": "contains_pii", "required": True, "type": "boolean"},
    {"name": "approval_link", "required": True, "type": "string", "pattern": r"https?:\/\/.*"},
    {"name": "rank", "required": True, "type": "number"},
    {"name": "department", "type": "string", "choices": ["hr", "it", "other"]},
]


def _wide_customer(t):
    return t.customer.withColumnsRenamed({"c_name": "private_name", "c_acctbal": "email_of_owner"})


@query(
    "check_blocked_columns",
    """SELECT 'blocked_column' AS "check", subject, detail, (SELECT count(*) FROM events) + (SELECT count(*) FROM customer) AS n_rows_checked
    FROM (VALUES ('events.user_id', 'user_id'), ('customer.private_name', 'private_*'), ('customer.email_of_owner', 'email'),
    ('bare.user_id', 'user_id'), ('bare.ssn', 'ssn')) v(subject, detail)""",
)
def _(t):
    bare = t.events.withColumn("ssn", F.lit(None).cast("string")).limit(0)  # no value anywhere: the name is enough
    schemas = scans.columns(t.events, "events").unionByName(scans.columns(_wide_customer(t), "customer"))
    found = gates.blocked_columns(schemas.unionByName(scans.columns(bare, "bare")), BLOCKED)
    rows = t.events.agg(F.count(F.lit(1)).alias("n")).unionByName(t.customer.agg(F.count(F.lit(1)).alias("n"))).agg(F.sum("n")).scalar()
    return found.withColumn("n_rows_checked", rows)


@query(
    "check_schema_change",
    """SELECT 'schema_change' AS "check", 'customer:1' AS subject, 'renamed c_name to private_name' AS detail
    UNION ALL SELECT 'schema_change', 'customer:3', 'retyped c_acctbal from double to string'
    UNION ALL SELECT 'schema_change', 'customer:5', 'added note' UNION ALL SELECT 'schema_change', 'orders:5', 'dropped o_orderpriority'""",
)
def _(t):
    incoming = t.customer.withColumnsRenamed({"c_name": "private_name"}).withColumns(
        {"c_acctbal": F.col("c_acctbal").cast("string"), "note": F.lit("x")}
    )
    old = scans.columns(t.customer, "customer").unionByName(scans.columns(t.orders, "orders"))
    new = scans.columns(incoming, "customer").unionByName(scans.columns(t.orders.drop("o_orderpriority"), "orders"))
    return gates.schema_changes(old, new)


@query(
    "changed_files_to_check",
    """SELECT regexp_replace(b.path, '/[^/]*$', '') AS folder, min(b.path) AS path FROM manifest_dev b LEFT JOIN manifest_main a ON a.path = b.path
    WHERE a.checksum IS DISTINCT FROM b.checksum GROUP BY 1""",
)
def _(t):
    return gates.files_to_check(diff.diff_objects(t.manifest_main, t.manifest_dev), ".txt", sample=True)


@query(
    "changed_files_all",
    """SELECT regexp_replace(b.path, '/[^/]*$', '') AS folder, b.path FROM manifest_dev b LEFT JOIN manifest_main a ON a.path = b.path
    WHERE a.checksum IS DISTINCT FROM b.checksum""",
)
def _(t):
    return gates.files_to_check(diff.diff_objects(t.manifest_main, t.manifest_dev), ".txt", sample=False)


@query(
    "check_changed_files",
    """SELECT 'blocked_column' AS "check", 'dev/orders.email' AS subject, 'email' AS detail, (SELECT count(*) FROM orders WHERE year(o_orderdate) = 1999) AS n_rows""",
)
def _(t):
    """Only files that the refs do not share are opened, each for itself, and of those only the footers."""
    store = SnapshotStore(t.spark, t.scratch("store"))
    recent = F.year("o_orderdate") == 1999
    parts = [store.write(t.orders.where(~recent), "orders"), store.write(t.orders.where(recent), "orders")]
    store.commit("main", "load", {"orders": parts})
    store.create_branch("dev", "main")
    store.commit("dev", "add a column", {"orders": [parts[0], store.write(t.orders.where(recent).withColumn("email", F.lit("x")), "orders")]})
    opened = persist_to_shared(footers.footers(store.changed_files("orders", "main", "dev")), "footers")
    found = gates.blocked_columns(opened.select(F.lit("dev/orders").alias("table"), "column", "type").distinct(), BLOCKED)
    return found.withColumn("n_rows", opened.where("position = 0").agg(F.sum("n_rows")).scalar())


def _changed_years(t) -> SnapshotStore:
    """orders by year; dev writes three of the years anew: one as it was, one with two defects, one with another type."""
    store = SnapshotStore(t.spark, t.scratch("store"))
    years = t.orders.withColumn("o_year", F.year("o_orderdate"))
    of = lambda *y: years.where(F.col("o_year").isin(*y))
    rest = store.write(years.where(~F.col("o_year").isin(1997, 1998, 1999)), "orders", ("o_year",))
    store.commit("main", "load", {"orders": [rest, store.write(of(1997, 1998, 1999), "orders", ("o_year",))]})
    store.create_branch("dev", "main")
    bad = of(1998).withColumn("email_of_owner", F.lit("x")).withColumnRenamed("o_orderstatus", "status")
    retyped = of(1999).withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    parts = [store.write(df, "orders", ("o_year",)) for df in (of(1997), bad, retyped)]
    store.commit("dev", "write three years anew", {"orders": [rest, *parts]})
    return store


def _year(path="path"):
    return paths.base_name(paths.parent(F.col(path)))


@query(
    "check_every_changed_file",
    """SELECT 'blocked_column' AS "check", 'o_year=1998.email_of_owner' AS subject, 'email' AS detail, count(*) AS n_rows
    FROM orders WHERE year(o_orderdate) = 1998""",
)
def _(t):
    """One of three changed folders has a forbidden column: its own footers tell, and how many rows are concerned."""
    opened = persist_to_shared(footers.footers(_changed_years(t).changed_files("orders", "main", "dev")), "footers")
    found = gates.blocked_columns(opened.select(_year().alias("table"), "column", "type").distinct(), BLOCKED)
    rows = opened.where("position = 0").groupBy(_year().alias("year")).agg(F.sum("n_rows").alias("n_rows"))
    return found.join(rows, F.substring_index("subject", ".", 1) == F.col("year")).drop("year")


@query(
    "check_changed_file_schemas",
    """SELECT 'schema_change' AS "check", subject, detail FROM (VALUES ('o_year=1998:2', 'renamed o_orderstatus to status'),
    ('o_year=1998:6', 'added email_of_owner'), ('o_year=1999:3', 'retyped o_totalprice from double to string')) v(subject, detail)
    WHERE (SELECT count(*) FROM orders WHERE year(o_orderdate) IN (1998, 1999)) > 0""",
)
def _(t):
    """Every changed file against the published schema, each with its own footer."""
    store = _changed_years(t)
    table = F.lit("orders").alias("table")
    published = footers.footers(footers.data_files(t.spark, store.tables("main")["orders"]))
    changed = footers.footers(store.changed_files("orders", "main", "dev"))
    found = gates.file_schema_changes(
        gates.published_schema(published.select(table, "path", "position", "column", "type")),
        changed.select(table, "path", "position", "column", "type"),
    )
    place = F.concat_ws(":", _year("file"), F.regexp_extract("subject", r":(\d+)$", 1))
    return found.withColumn("file", F.regexp_replace("subject", r":\d+$", "")).select("check", place.alias("subject"), "detail").distinct()


@query(
    "check_one_file_per_folder",
    """SELECT 'o_year=' || y AS folder, 1 AS n_opened, CASE WHEN y = 1998 THEN 1 ELSE 0 END AS n_blocked, true AS fewer FROM
    (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) IN (1997, 1998, 1999))""",
)
def _(t):
    """Sampling: of each folder's changed files one is opened, and the gate still sees every folder."""
    store = _changed_years(t)
    files = store.changed_files("orders", "main", "dev")
    picked = gates.files_to_check(files.select("path", F.lit("added").alias("type")), ".parquet", sample=True)
    opened = persist_to_shared(footers.footers(picked), "footers")
    schemas = opened.select(_year().alias("table"), "column", "type")
    blocked = gates.blocked_columns(schemas, BLOCKED).groupBy(F.substring_index("subject", ".", 1).alias("folder")).agg(F.count("*").alias("n_blocked"))
    per = opened.groupBy(_year().alias("folder")).agg(F.countDistinct("path").alias("n_opened"))
    listed = files.groupBy(_year().alias("folder")).agg(F.count("*").alias("n_listed"))
    return per.join(blocked, "folder", "left").join(listed, "folder").select(
        "folder", "n_opened", F.coalesce("n_blocked", F.lit(0)).alias("n_blocked"), (F.col("n_opened") <= F.col("n_listed")).alias("fewer")
    )


@query(
    "check_commit_metadata",
    """SELECT 'commit_metadata' AS "check", commit_id AS subject, 'missing notebook_url' AS detail FROM commits WHERE substr(commit_id, -1) = '3'
    UNION ALL SELECT 'commit_metadata', commit_id, 'notebook_url does not match: example.com/' || committer FROM commits WHERE substr(commit_id, -1) = '5'
    UNION ALL SELECT 'commit_metadata', commit_id, 'missing spark_version' FROM commits WHERE substr(commit_id, -1) IN ('3', '7')""",
)
def _(t):
    last = F.substring("commit_id", -1, 1)
    url = F.when(last == "3", None).when(last == "5", F.concat(F.lit("example.com/"), "committer")).otherwise(
        F.concat(F.lit("github.com/"), "committer")
    )
    noted = t.commits.withColumn(
        "metadata",
        F.map_filter(
            F.create_map(F.lit("notebook_url"), url, F.lit("spark_version"), F.when(~last.isin("3", "7"), "4.1")),
            lambda k, v: v.isNotNull(),
        ),
    )
    return gates.commit_metadata(noted, COMMIT_RULES)


@query(
    "nearest_descriptor",
    """WITH f AS (SELECT path, regexp_replace(path, '/[^/]*$', '') AS d1, regexp_replace(path, '/[^/]*/[^/]*$', '') AS d2 FROM manifest_main)
    SELECT path, CASE WHEN d1 || '/dataset_metadata.yaml' IN (SELECT path FROM descriptors) THEN d1 || '/dataset_metadata.yaml'
    WHEN d2 || '/dataset_metadata.yaml' IN (SELECT path FROM descriptors) THEN d2 || '/dataset_metadata.yaml' END AS descriptor FROM f""",
)
def _(t):
    return gates.nearest_descriptor(t.manifest_main.select("path"), t.descriptors, DESCRIPTOR)


@query(
    "check_descriptor_present",
    """SELECT 'descriptor' AS "check", b.path AS subject, 'no dataset metadata found' AS detail FROM manifest_dev b
    LEFT JOIN manifest_main a ON a.path = b.path WHERE a.path IS NULL AND b.path LIKE 'docs/new/%'""",
)
def _(t):
    return gates.missing_descriptors(diff.diff_objects(t.manifest_main, t.manifest_dev), t.descriptors, DESCRIPTOR)


@query(
    "check_descriptor_fields",
    """WITH p AS (SELECT 'datasets/' || p_partkey AS path, p_partkey AS k FROM part)
    SELECT 'descriptor_field' AS "check", path AS subject, 'contains_pii is required' AS detail FROM p WHERE k % 11 = 0
    UNION ALL SELECT 'descriptor_field', path, 'contains_pii is not a boolean' FROM p WHERE k % 11 <> 0 AND k % 13 = 0
    UNION ALL SELECT 'descriptor_field', path, 'approval_link does not match its pattern' FROM p WHERE k % 17 = 0
    UNION ALL SELECT 'descriptor_field', path, 'rank is not a number' FROM p WHERE k % 19 = 0
    UNION ALL SELECT 'descriptor_field', path, 'department is not an allowed choice' FROM p WHERE k % 23 = 0""",
)
def _(t):
    k = F.col("p_partkey")
    fields = F.map_filter(
        F.create_map(
            F.lit("contains_pii"), F.when(k % 11 == 0, None).when(k % 13 == 0, "maybe").otherwise("true"),
            F.lit("approval_link"), F.when(k % 17 == 0, "ask the owner").otherwise("https://example.com/ok"),
            F.lit("rank"), F.when(k % 19 == 0, "first").otherwise(F.col("p_size").cast("string")),
            F.lit("department"), F.when(k % 23 == 0, "sales").when(k % 2 == 0, "it"),
        ),
        lambda key, value: value.isNotNull(),
    )
    described = t.part.select(F.concat(F.lit("datasets/"), k.cast("string")).alias("path"), fields.alias("fields"))
    return gates.descriptor_fields(described, FIELD_RULES)


@query(
    "check_descriptor_types",
    """WITH p AS (SELECT 'datasets/' || p_partkey AS path, p_partkey AS k FROM part)
    SELECT 'descriptor_field' AS "check", path AS subject, 'not a JSON object' AS detail FROM p WHERE k % 29 = 0
    UNION ALL SELECT 'descriptor_field', path, 'contains_pii is required' FROM p WHERE k % 29 <> 0 AND k % 11 = 0
    UNION ALL SELECT 'descriptor_field', path, 'contains_pii is not a boolean' FROM p WHERE k % 29 <> 0 AND k % 11 <> 0 AND k % 13 = 0
    UNION ALL SELECT 'descriptor_field', path, 'approval_link is not a string' FROM p WHERE k % 29 <> 0 AND k % 17 = 0
    UNION ALL SELECT 'descriptor_field', path, 'approval_link is not text' FROM p WHERE k % 29 <> 0 AND k % 17 = 0
    UNION ALL SELECT 'descriptor_field', path, 'rank is not a number' FROM p WHERE k % 29 <> 0 AND k % 19 = 0
    UNION ALL SELECT 'descriptor_field', path, 'department is not an allowed choice' FROM p WHERE k % 29 <> 0 AND k % 23 = 0""",
)
def _(t):
    k = F.col("p_partkey")
    pii = F.when(k % 11 == 0, "null").when(k % 13 == 0, '"true"').otherwise("true")
    link = F.when(k % 17 == 0, "12").otherwise('"https://example.com/ok"')
    rank = F.when(k % 19 == 0, F.concat(F.lit('"'), "p_size", F.lit('"'))).otherwise(F.col("p_size").cast("string"))
    body = F.concat(
        F.lit('{"contains_pii": '), pii, F.lit(', "approval_link": '), link, F.lit(', "rank": '), rank,
        F.lit(', "department": '), F.when(k % 23 == 0, '"sales"').otherwise('"it"'), F.lit("}"),
    )
    body = F.when(k % 29 == 0, "[1, 2]").otherwise(body)
    return gates.typed_fields(t.part.select(F.concat(F.lit("datasets/"), k.cast("string")).alias("path"), body.alias("body")), FIELD_RULES)


@query(
    "check_formats",
    """SELECT 'file_format' AS "check", 'analytics/' || source || '/' || doc_id || '.csv' AS subject, '.csv' AS detail
    FROM documents WHERE doc_id % 3 = 1""",
)
def _(t):
    name = F.concat_ws("/", F.lit("analytics"), "source", F.col("doc_id").cast("string"))
    path = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(name, F.lit(".parquet")))
        .when(F.col("doc_id") % 3 == 1, F.concat(name, F.lit(".csv")))
        .otherwise(F.concat(F.lit("analytics/table/_delta_log/"), F.col("doc_id").cast("string"), F.lit(".json")))
    )
    changed = t.documents.select(path.alias("path"), F.lit("added").alias("type"))
    return gates.file_formats(changed, "analytics/", [".parquet"])


@query(
    "audit_freshness",
    """SELECT 'freshness' AS "check", 'agg_old' AS subject, '2000 instead of ' || (SELECT max(year(o_orderdate)) FROM orders) AS detail""",
)
def _(t):
    year = F.year("o_orderdate")
    tables = {
        "agg_status": t.orders.groupBy("o_orderstatus").agg(F.max("o_orderdate").alias("o_orderdate")),
        "agg_old": t.orders.where(year <= 2000).groupBy("o_orderpriority").agg(F.max("o_orderdate").alias("o_orderdate")),
    }
    return gates.freshness(t.orders, tables, year)


@query(
    "audit_null_dims",
    """SELECT 'null_dimension' AS "check", 'c_nationkey' AS subject, CAST(count(*) AS VARCHAR) AS detail FROM customer_nulls WHERE c_nationkey IS NULL
    UNION ALL SELECT 'null_dimension', 'c_mktsegment', CAST(count(*) AS VARCHAR) FROM customer_nulls WHERE c_mktsegment IS NULL""",
)
def _(t):
    return gates.null_dimensions(t.customer_nulls, ["c_custkey", "c_nationkey", "c_mktsegment"])


@query(
    "audit_membership",
    """WITH e AS (SELECT n_nationkey AS v FROM nation WHERE n_nationkey <> 3), s AS (SELECT DISTINCT c_nationkey AS v FROM customer WHERE c_nationkey <> 5)
    SELECT 'membership' AS "check", CAST(v AS VARCHAR) AS subject, 'missing' AS detail FROM (SELECT v FROM e EXCEPT SELECT v FROM s)
    UNION ALL SELECT 'membership', CAST(v AS VARCHAR), 'unexpected' FROM (SELECT v FROM s EXCEPT SELECT v FROM e)""",
)
def _(t):
    expected = t.nation.where("n_nationkey <> 3").select(F.col("n_nationkey").alias("value"))
    return gates.membership(t.customer.where("c_nationkey <> 5"), "c_nationkey", expected)


@query(
    "check_required_columns",
    """SELECT 'required_column' AS "check", 'created_at' AS subject, 'missing' AS detail, count(*) AS n_rows FROM orders_dirty""",
)
def _(t):
    needed = ["order_id", "customer_id", "amount", "currency", "status", "created_at"]
    found = gates.required_columns(t.orders_dirty, needed)
    return found.withColumn("n_rows", t.orders_dirty.agg(F.count(F.lit(1))).scalar())


@query(
    "quality_report",
    """SELECT count(*) AS rows_in, count(*) FILTER (WHERE trim(order_id) <> '' AND customer_id IS NOT NULL AND status = 'completed' AND currency = 'USD'
    AND TRY_CAST(amount AS DOUBLE) > 0 AND NOT isnan(TRY_CAST(amount AS DOUBLE))) AS rows_out,
    count(*) - rows_out AS rows_dropped, 'status==completed,currency==USD,amount>0,non_empty_ids' AS filters FROM orders_dirty""",
)
def _(t):
    return clean.quality_report(t.orders_dirty, status="completed")


@query("gate_non_empty", """SELECT 'non_empty' AS "check", 'refunds' AS subject, 'no rows' AS detail WHERE (SELECT count(*) FROM orders) > 0""")
def _(t):
    full = gates.non_empty(t.orders, "orders")
    return full.unionByName(gates.non_empty(t.orders.where("o_orderstatus = 'refunded'"), "refunds"))


_DATE_OK = "regexp_matches(order_date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') AND TRY_CAST(order_date AS DATE) IS NOT NULL"
_AMT = "TRY_CAST(amount AS DOUBLE)"
_RULES_SQL = {
    1: [
        ("order_id_required", "SELECT row_no FROM orders_dirty WHERE trim(order_id) = ''"),
        (
            "order_id_unique",
            "SELECT row_no FROM (SELECT row_no, row_number() OVER (PARTITION BY trim(order_id) ORDER BY row_no) AS r FROM orders_dirty WHERE trim(order_id) <> '') WHERE r > 1",
        ),
        ("customer_id_required", "SELECT row_no FROM orders_dirty WHERE customer_id IS NULL"),
        ("amount_parseable", f"SELECT row_no FROM orders_dirty WHERE {_AMT} IS NULL"),
    ],
    2: [
        ("order_date_format", f"SELECT row_no FROM orders_dirty WHERE NOT ({_DATE_OK})"),
        ("amount_positive", f"SELECT row_no FROM orders_dirty WHERE {_AMT} <= 0"),
        ("currency_usd", "SELECT row_no FROM orders_dirty WHERE currency <> 'USD'"),
        ("status_valid", "SELECT row_no FROM orders_dirty WHERE status NOT IN ('completed', 'pending', 'shipped', 'cancelled')"),
        ("product_category_valid", "SELECT row_no FROM orders_dirty WHERE product_category NOT IN ('electronics', 'clothing', 'books', 'home', 'sports')"),
    ],
    3: [
        ("date_recency", f"SELECT row_no FROM orders_dirty WHERE {_DATE_OK} AND CAST(substr(order_date, 1, 4) AS INTEGER) < 2023"),
        ("amount_ceiling", f"SELECT row_no FROM orders_dirty WHERE {_AMT} > 350 AND NOT isnan({_AMT})"),
    ],
}


def _found_sql(*phases: int) -> str:
    return " UNION ALL ".join(
        f"SELECT {p} AS phase, '{rule}' AS rule, row_no FROM ({sql})" for p in phases for rule, sql in _RULES_SQL[p]
    )


@query("rules_phase1", _found_sql(1))
def _(t):
    return rules.order_findings(t.orders_dirty, (1,))


@query("rules_phase2", _found_sql(2))
def _(t):
    return rules.order_findings(t.orders_dirty, (2,))


@query("rules_phase3", _found_sql(3))
def _(t):
    return rules.order_findings(t.orders_dirty, (3,))


@query("validate_progressive", f"SELECT * FROM ({_found_sql(1, 2, 3)}) WHERE phase = 1")
def _(t):
    return rules.first_failing_phase(persist_to_shared(rules.order_findings(t.orders_dirty), "findings"))


@query(
    "validation_report",
    f"""SELECT 'failed' AS status, 1 AS failed_phase, 'Structural Integrity' AS phase_name, (SELECT count(*) FROM orders_dirty) AS row_count,
    string_agg(rule || ':' || n, ',' ORDER BY rule) AS failures FROM (SELECT rule, count(*) AS n FROM ({_found_sql(1)}) GROUP BY rule)""",
)
def _(t):
    return rules.report(t.orders_dirty)


@query(
    "rule_summary",
    f"""SELECT phase, rule, row_no // 1000 AS row_block, count(*) AS n_rows, string_agg(row_no, ',' ORDER BY row_no) AS affected_rows
    FROM ({_found_sql(1, 2, 3)}) GROUP BY ALL""",
)
def _(t):
    out = rules.rule_summary(rules.order_findings(t.orders_dirty))
    return out.select("phase", "rule", "row_block", "n_rows", joined_list("affected_rows", "affected_rows"))


@query(
    "repair_orders",
    """WITH f AS (SELECT row_no, trim(order_id) AS order_id, customer_id,
    CASE WHEN order_date = '01/17/2024' THEN '2024-01-17' ELSE order_date END AS order_date, amount, currency,
    lower(status) AS status, lower(product_category) AS product_category FROM orders_dirty),
    v AS (SELECT * FROM f WHERE order_id <> '' AND customer_id IS NOT NULL AND TRY_CAST(amount AS DOUBLE) > 0
    AND TRY_CAST(amount AS DOUBLE) <= 350 AND NOT isnan(TRY_CAST(amount AS DOUBLE)) AND TRY_CAST(order_date AS DATE) IS NOT NULL
    AND order_date >= '2023' AND currency = 'USD' AND status IN ('completed', 'pending', 'shipped', 'cancelled')
    AND product_category IN ('electronics', 'clothing', 'books', 'home', 'sports'))
    SELECT row_no, order_id, customer_id, order_date, amount, currency, status, product_category FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY row_no) AS r FROM v) WHERE r = 1""",
)
def _(t):
    return rules.repair_orders(t.orders_dirty)


@query(
    "gate_status",
    """SELECT 'stored_status' AS "check", s.run_id AS subject, coalesce(CASE WHEN r.metric IS NULL THEN NULL WHEN metric >= 0.9 THEN 'passed' ELSE 'failed' END, 'no report') AS detail
    FROM (SELECT DISTINCT 'run-' || source AS run_id FROM documents) s LEFT JOIN (SELECT * FROM runs WHERE status = 'FINISHED') r USING (run_id)
    WHERE coalesce(metric, 0) < 0.9""",
)
def _(t):
    expected = t.documents.select(F.concat(F.lit("run-"), "source").alias("subject")).distinct()
    reports = t.runs.where("status = 'FINISHED'").select(
        F.col("run_id").alias("subject"), F.when(F.col("metric") >= 0.9, "passed").otherwise("failed").alias("status")
    )
    return gates.stored_status(expected, reports)


_AUDITS_SQL = """SELECT 'nulls' AS gate, 'null_dimension' AS "check", 'c_mktsegment' AS subject, CAST(count(*) AS VARCHAR) AS detail
    FROM customer_nulls WHERE c_mktsegment IS NULL
    UNION ALL SELECT 'orphans', 'orphan', CAST(o_custkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM orders_orphans
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey"""


@query("run_gates", _AUDITS_SQL)
def _(t):
    return gates.run_gates(
        [
            ("nulls", gates.null_dimensions, {"table": t.customer_nulls, "columns": ["c_custkey", "c_mktsegment"]}),
            ("orphans", gates.orphans, {"child": t.orders_orphans, "parent": t.customer, "child_key": "o_custkey", "parent_key": "c_custkey"}),
            ("rows", gates.non_empty, {"df": t.orders_orphans, "name": "orders"}),
        ]
    )


@query(
    "wap_publish",
    """SELECT 'good' AS load, 'published' AS verdict, CAST(0 AS BIGINT) AS n_findings, (SELECT count(*) FROM orders_dev) AS rows_on_main
    UNION ALL SELECT 'bad', 'blocked', (SELECT count(DISTINCT o_custkey) FROM orders_orphans WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)),
    (SELECT count(*) FROM orders_dev)""",
)
def _(t):
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "customer", t.customer, "load")
    store.overwrite("main", "orders", t.orders, "load")

    def audits(store, ref):
        orders = store.read("orders", ref)
        keys = {"child_key": "o_custkey", "parent_key": "c_custkey"}
        return [
            ("orphans", gates.orphans, {"child": orders, "parent": store.read("customer", ref), **keys}),
            ("nulls", gates.null_dimensions, {"table": orders, "columns": ["o_custkey", "o_orderstatus"]}),
            ("rows", gates.non_empty, {"df": orders, "name": "orders"}),
        ]

    out = None
    for load, orders in (("good", t.orders_dev), ("bad", t.orders_orphans)):
        verdict, found = publish.write_audit_publish(store, load, "main", {"orders": orders}, audits)
        one = found.agg(F.count(F.lit(1)).alias("n_findings")).withColumns(
            {
                "load": F.lit(load), "verdict": F.lit(verdict),
                "rows_on_main": store.read("orders", "main").agg(F.count(F.lit(1))).scalar(),
            }
        )
        out = one if out is None else out.unionByName(one)
    return out.select("load", "verdict", "n_findings", "rows_on_main")
