"""Registered queries: diffs, merges, reverts, refs, logs and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates, clean, diff, dml, lineage, merge
from tablewright.operators.ref_merge import RefMerge
from tablewright.plans.registry import query
from tablewright.plans.shapes import ORDER_SQL, order_rows
from tablewright.sources import scans, sinks
from tablewright.sources.snapshots import RefError, SnapshotStore


def _store(t) -> SnapshotStore:
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "orders", t.orders, "load orders")
    return store


def _sizes(store: SnapshotStore, refs: list[str]):
    return aggregates.count_by_ref({r: store.read("orders", r) for r in refs})


@query(
    "branch_create",
    """SELECT 'main' AS ref, 'branch' AS kind, count(*) AS n_rows, true AS same_commit FROM orders
    UNION ALL SELECT 'feature', 'branch', count(*), true FROM orders""",
)
def _(t):
    store = _store(t)
    store.create_branch("feature", "main")
    main = F.lit(store.head("main"))
    refs = store.refs().select("ref", "kind", (F.col("commit_id") == main).alias("same_commit"))
    return refs.join(_sizes(store, ["main", "feature"]), "ref")


@query(
    "commit_rows",
    """SELECT commit_id, parent_id, sha256(coalesce(parent_id, '') || '|' || prefix || '|' || committer || '|' ||
    strftime(ts, '%Y-%m-%d %H:%M:%S')) AS content_id FROM commits""",
)
def _(t):
    return lineage.commit_ids(t.commits).select("commit_id", "parent_id", "content_id")


def _diff_sql(a: str, b: str) -> str:
    return f"""SELECT coalesce(a.path, b.path) AS path, 'object' AS path_type, coalesce(b.size_bytes, a.size_bytes) AS size_bytes,
    CASE WHEN a.path IS NULL THEN 'added' WHEN b.path IS NULL THEN 'removed' ELSE 'changed' END AS type
    FROM {a} a FULL JOIN {b} b ON a.path = b.path WHERE a.checksum IS DISTINCT FROM b.checksum"""


@query("diff_objects", _diff_sql("manifest_main", "manifest_dev"))
def _(t):
    return diff.diff_objects(t.manifest_main, t.manifest_dev)


@query("diff_uncommitted", _diff_sql("manifest_dev", "(SELECT * FROM manifest_main WHERE size_bytes > 100)"))
def _(t):
    return diff.diff_objects(t.manifest_dev, t.manifest_main.where("size_bytes > 100"))


_ROW_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "diff_rows",
    """SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
    CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
    CASE WHEN a.o_orderkey IS NULL OR b.o_orderkey IS NULL THEN '' ELSE concat_ws(',', """
    + ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _ROW_COLS)
    + ") END AS changed_columns FROM orders a FULL JOIN orders_hotfix b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR "
    + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _ROW_COLS),
)
def _(t):
    return diff.diff_rows(t.orders, t.orders_hotfix, ["o_orderkey"])


def two_folder_change(t) -> SnapshotStore:
    """orders in two folders on main; branch dev rewrites one of them and appends a third."""
    early = F.year("o_orderdate") < 1998
    store = SnapshotStore(t.spark, t.scratch("store"))
    old, recent = store.write(t.orders.where(early), "orders"), store.write(t.orders.where(~early), "orders")
    store.commit("main", "load", {"orders": [old, recent]})
    store.create_branch("dev", "main")
    fixed = dml.update_where(store.spark.read.parquet(recent), F.year("o_orderdate") == 1999, {"o_totalprice": F.col("o_totalprice") + 1})
    fresh = t.order_updates.where("o_orderstatus = 'I'")
    store.commit("dev", "fix and append", {"orders": [old, store.write(fixed, "orders"), store.write(fresh, "orders")]})
    return store


@query(
    "diff_refs",
    """SELECT o_orderkey, 'changed' AS change, 'o_totalprice' AS changed_columns FROM orders WHERE year(o_orderdate) = 1999
    UNION ALL SELECT o_orderkey, 'added', '' FROM order_updates WHERE o_orderstatus = 'I'""",
)
def _(t):
    return diff.diff_refs(two_folder_change(t), "orders", "main", "dev", ["o_orderkey"])


@query("apply_diff", f"SELECT {ORDER_SQL} FROM orders_dev")
def _(t):
    return order_rows(diff.apply_changes(t.orders, diff.changes(t.orders, t.orders_dev, ["o_orderkey"]), ["o_orderkey"]))


@query(
    "diff_schema",
    """SELECT 'channel' AS "column", 'added' AS change, NULL AS old_type, 'string' AS new_type, count(*) AS n_values FROM orders
    UNION ALL SELECT 'o_orderpriority', 'removed', 'string', NULL, NULL
    UNION ALL SELECT 'o_totalprice', 'retyped', 'double', 'string', count(*) FROM orders""",
)
def _(t):
    new = t.orders.drop("o_orderpriority").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("string"), "channel": F.lit("web")}
    )
    rows = t.spark.createDataFrame(
        diff.diff_schema(t.orders.schema, new.schema), "column string, change string, old_type string, new_type string"
    )
    return rows.join(scans.describe(new, "orders").select("column", "n_values"), "column", "left")


@query(
    "log_by_prefix",
    """SELECT commit_id, prefix, committer FROM commits WHERE prefix LIKE 'tables/click/%' OR prefix LIKE 'tables/error/%'
    ORDER BY ts DESC, commit_id DESC LIMIT 25""",
)
def _(t):
    return lineage.log_by_prefix(t.commits, ["tables/click/", "tables/error/"], 25).select("commit_id", "prefix", "committer")


def _merge_sql(base: str, ours: str, theirs: str, tail: str) -> str:
    def packed(table):
        return (
            f"SELECT *, concat_ws('|', o_custkey, o_orderstatus, coalesce(CAST(o_totalprice AS VARCHAR), '-'), o_orderdate, o_orderpriority) AS v "
            f"FROM {table}"
        )

    return f"""WITH b AS ({packed(base)}), o AS ({packed(ours)}), s AS ({packed(theirs)}),
    keys AS (SELECT o_orderkey FROM b UNION SELECT o_orderkey FROM o UNION SELECT o_orderkey FROM s),
    m AS (SELECT k.o_orderkey AS k, CASE WHEN o.v IS NOT DISTINCT FROM s.v THEN
    CASE WHEN o.v IS NOT DISTINCT FROM b.v THEN 'unchanged' ELSE 'both' END
    WHEN s.v IS NOT DISTINCT FROM b.v THEN 'ours' WHEN o.v IS NOT DISTINCT FROM b.v THEN 'theirs' ELSE 'conflict' END AS status,
    o.v AS ov, s.v AS sv, b.v AS bv FROM keys k LEFT JOIN b USING (o_orderkey) LEFT JOIN o USING (o_orderkey) LEFT JOIN s USING (o_orderkey))
    {tail}"""


_PICK = ", ".join(f"CASE WHEN status = 'theirs' THEN s.{c} ELSE o.{c} END AS {c}" for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"))
_MERGED = f"""SELECT k AS o_orderkey, {_PICK}, status FROM m LEFT JOIN o ON o.o_orderkey = k LEFT JOIN s ON s.o_orderkey = k
    WHERE status = 'conflict' OR (status = 'theirs' AND sv IS NOT NULL) OR (status <> 'theirs' AND ov IS NOT NULL)"""
_MERGE_OUT = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "status")


@query("merge_three_way", _merge_sql("orders", "orders_dev", "orders_hotfix", _MERGED))
def _(t):
    return merge.merge_three_way(t.orders, t.orders_dev, t.orders_hotfix, ["o_orderkey"]).select(*_MERGE_OUT)


def _part_of(changed: str, parts: int) -> str:
    """SQL of orders whose first ``parts`` of four folders were written anew."""
    return f"(SELECT * FROM {changed} WHERE o_orderkey % 4 < {parts} UNION ALL SELECT * FROM orders WHERE o_orderkey % 4 >= {parts})"


def orders_in_folders(t) -> SnapshotStore:
    """Orders in four folders; dev writes the first one anew, hotfix the first two."""
    store = SnapshotStore(t.spark, t.scratch("store"))
    part = lambda df, n: store.write(df.where(F.col("o_orderkey") % 4 == n), "orders")
    folders = [part(t.orders, n) for n in range(4)]
    store.commit("main", "load", {"orders": folders})
    for branch, changed, n in (("dev", t.orders_dev, 1), ("hotfix", t.orders_hotfix, 2)):
        store.create_branch(branch, "main")
        store.commit(branch, "edit", {"orders": [part(changed, i) for i in range(n)] + folders[n:]})
    return store


@query("merge_refs", _merge_sql("orders", _part_of("orders_dev", 1), _part_of("orders_hotfix", 2), _MERGED))
def _(t):
    return RefMerge(orders_in_folders(t), "orders", ["o_orderkey"], "main", "dev", "hotfix").rows().select(*_MERGE_OUT)


@query(
    "merge_conflicts",
    _merge_sql(
        "orders", "orders_dev", "orders_hotfix",
        """SELECT k AS o_orderkey, CASE WHEN ov IS NULL THEN 'delete/update' WHEN sv IS NULL THEN 'update/delete'
        WHEN bv IS NULL THEN 'insert/insert' ELSE 'update/update' END AS kind FROM m WHERE status = 'conflict'""",
    ),
)
def _(t):
    return merge.conflicts(t.orders, t.orders_dev, t.orders_hotfix, ["o_orderkey"])


@query(
    "merge_prefer_theirs",
    _merge_sql(
        "orders", "orders_dev", "orders_hotfix",
        """SELECT k AS o_orderkey, CASE WHEN status IN ('theirs', 'conflict') THEN s.o_totalprice ELSE o.o_totalprice END AS o_totalprice
        FROM m LEFT JOIN o ON o.o_orderkey = k LEFT JOIN s ON s.o_orderkey = k
        WHERE CASE WHEN status IN ('theirs', 'conflict') THEN sv IS NOT NULL ELSE ov IS NOT NULL END""",
    ),
)
def _(t):
    merged = merge.merge_three_way(t.orders, t.orders_dev, t.orders_hotfix, ["o_orderkey"], prefer="theirs")
    return merged.select("o_orderkey", "o_totalprice")


@query(
    "promote_tables",
    """SELECT 'orders' AS "table", count(*) AS n_rows FROM orders_dev UNION ALL SELECT 'customer', count(*) FROM customer
    WHERE c_nationkey <> 7""",
)
def _(t):
    store = _store(t)
    store.overwrite("main", "customer", t.customer, "load customers")
    store.create_branch("dev", "main")
    store.overwrite("dev", "orders", t.orders_dev, "edit orders")
    store.overwrite("dev", "customer", t.customer.where("c_nationkey <> 7"), "drop a nation")
    store.merge("dev", "main")  # one commit covers both tables
    return aggregates.union_labelled(
        {n: store.read(n, "main").agg(F.count(F.lit(1)).alias("n_rows")) for n in ("orders", "customer")}, "table"
    )


@query("revert_commit", f"SELECT {ORDER_SQL} FROM orders")
def _(t):
    store = _store(t)
    store.create_branch("dev", "main")
    store.overwrite("dev", "orders", t.orders_dev, "edit orders")
    store.merge("dev", "main")
    store.revert("main", parent_number=1)
    return order_rows(store.read("orders", "main"))


@query("revert_rows", _merge_sql("orders_dev", "orders_hotfix", "orders", _MERGED))
def _(t):
    return merge.revert_rows(t.orders_hotfix, before=t.orders, after=t.orders_dev, key=["o_orderkey"]).select(*_MERGE_OUT)


@query(
    "reset_staged",
    "SELECT * FROM manifest_dev WHERE path NOT LIKE 'docs/en/%' UNION ALL SELECT * FROM manifest_main WHERE path LIKE 'docs/en/%'",
)
def _(t):
    return diff.reset_prefixes(t.manifest_dev, t.manifest_main, ["docs/en/"])


_UPDATED = """(SELECT * FROM order_updates UNION ALL SELECT * FROM orders x
    WHERE NOT EXISTS (SELECT 1 FROM order_updates u WHERE u.o_orderkey = x.o_orderkey))"""


@query("cherry_pick", _merge_sql("orders", "orders_hotfix", _UPDATED, _MERGED))
def _(t):
    after = dml.upsert(t.orders, t.order_updates, ["o_orderkey"])
    return merge.cherry_pick(t.orders_hotfix, before=t.orders, after=after, key=["o_orderkey"]).select(*_MERGE_OUT)


@query(
    "branch_drop",
    "SELECT 'main' AS ref, count(*) AS n_rows FROM orders",
)
def _(t):
    store = _store(t)
    store.create_branch("dev", "main")
    store.overwrite("dev", "orders", t.orders_dev, "edit orders")
    store.drop("dev")
    return store.refs().select("ref").withColumn("n_rows", store.read("orders", "main").agg(F.count(F.lit(1))).scalar())


@query(
    "read_tag",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, 'refused' AS repoint FROM orders GROUP BY 1",
)
def _(t):
    store = _store(t)
    store.tag("v1", "main")
    store.overwrite("main", "orders", t.orders_dev, "edit orders")
    try:
        store.tag("v1", "main")
        repoint = "moved"
    except RefError:
        repoint = "refused"
    tagged = store.read("orders", "v1")
    return tagged.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    ).withColumn("repoint", F.lit(repoint))


@query(
    "list_refs",
    """SELECT committer AS ref, arg_max(commit_id, ts) AS commit_id, count(*) AS n_commits FROM commits GROUP BY 1""",
)
def _(t):
    return lineage.branch_heads(t.commits, "committer")


@query(
    "dirty_branches",
    """SELECT coalesce(split_part(a.path, '/', 2), split_part(b.path, '/', 2)) AS ref, count(*) AS n_changes
    FROM manifest_main a FULL JOIN manifest_dev b ON a.path = b.path WHERE a.checksum IS DISTINCT FROM b.checksum GROUP BY 1""",
)
def _(t):
    ref = F.split_part("path", F.lit("/"), F.lit(2)).alias("ref")
    return diff.dirty_refs(t.manifest_main.select("*", ref), t.manifest_dev.select("*", ref))


@query("clone_refs", "SELECT o_orderstatus, count(*) AS n FROM orders_dev GROUP BY 1")
def _(t):
    store = _store(t)
    store.create_branch("dev", "main")
    store.overwrite("dev", "orders", t.orders_dev, "edit orders")
    copy = store.clone(t.scratch("clone"))
    return copy.read("orders", "dev").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("clone_manifest", "SELECT 'backup/' || substr(path, 6) AS path, checksum, size_bytes FROM manifest_main")
def _(t):
    return diff.move_prefix(t.manifest_main, "docs/", "backup/")


@query(
    "lineage_edges",
    """SELECT commit_id, 'url' AS kind, 'lake/' || prefix AS source FROM commits
    UNION ALL SELECT commit_id, 'commit', parent_id FROM commits WHERE parent_id IS NOT NULL""",
)
def _(t):
    noted = t.commits.withColumn(
        "metadata",
        F.map_filter(
            F.create_map(
                F.lit("source.url"), F.concat(F.lit("lake/"), "prefix"), F.lit("source.commit"), F.col("parent_id"),
                F.lit("job"), F.col("committer"),
            ),
            lambda k, v: v.isNotNull(),
        ),
    )
    return lineage.lineage_edges(noted)


@query(
    "lineage_upstream",
    """WITH RECURSIVE walk AS (SELECT event_id AS node, event_id AS origin, CAST(0 AS BIGINT) AS steps FROM events
    UNION ALL SELECT node, origin // 3, steps + 1 FROM walk WHERE origin > 0)
    SELECT node, origin, steps FROM walk WHERE origin = 0""",
)
def _(t):
    made_from = F.when(F.col("event_id") > 0, F.floor(F.col("event_id") / 3)).alias("parent")
    return lineage.origins(t.events.select(F.col("event_id").alias("node"), made_from))


@query(
    "commit_ancestry",
    """SELECT commit_id AS node, 'c' || (SELECT min(event_id) FROM events) AS origin,
    CAST(substr(commit_id, 2) AS BIGINT) - (SELECT min(event_id) FROM events) AS steps FROM commits""",
)
def _(t):
    return lineage.origins(t.commits.select(F.col("commit_id").alias("node"), F.col("parent_id").alias("parent")))


@query(
    "lineage_trace",
    """WITH RECURSIVE walk AS (SELECT max(event_id) AS node, CAST(0 AS BIGINT) AS hops FROM events
    UNION SELECT CASE WHEN k = 0 THEN node // 2 ELSE node // 3 END, hops + 1 FROM walk, (VALUES (0), (1)) v(k) WHERE node > 0)
    SELECT node, min(hops) AS hops FROM walk GROUP BY node""",
)
def _(t):
    node = F.col("event_id")
    edges = t.events.where("event_id > 0").select(
        F.explode(F.array(F.floor(node / 2), F.floor(node / 3))).alias("source"), node.alias("target")
    )
    return lineage.upstream(edges, t.events.agg(F.max("event_id").alias("node")))


@query(
    "backfill",
    """SELECT l_returnflag, round(sum(l_quantity + l_extendedprice + l_tax), 2) AS total,
    round(sum((l_quantity + l_extendedprice + l_tax) / 3), 2) AS average FROM lineitem GROUP BY 1""",
)
def _(t):
    cols = ["l_quantity", "l_extendedprice", "l_tax"]
    store = SnapshotStore(t.spark, t.scratch("store"))
    wrong = clean.row_totals(t.lineitem.select("l_orderkey", "l_returnflag", *cols), cols).withColumn("average", F.col("total") / 4)
    store.overwrite("main", "totals", wrong, "derive totals")
    store.create_branch("backfill", "main")
    redo = clean.row_totals(store.read("totals", "backfill").drop("total", "average"), cols)
    store.overwrite("backfill", "totals", redo, "rebuild totals")
    store.merge("backfill", "main")
    return store.read("totals", "main").groupBy("l_returnflag").agg(
        F.round(F.sum("total"), 2).alias("total"), F.round(F.sum("average"), 2).alias("average")
    )


@query(
    "daily_promote",
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, round(sum(value), 2) AS total FROM events WHERE event_id % 13 <> 0 GROUP BY 1",
)
def _(t):
    landed = t.scratch("landing")
    rows = t.events.select(
        "event_id", "event_type", F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    sinks.partitioned(rows, landed, "dt")
    staged = t.spark.read.option("basePath", landed).parquet(landed).withColumn("dt", F.col("dt").cast("string"))
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "events", staged.limit(0), "empty table")
    store.create_branch("staging", "main")
    store.overwrite("staging", "events", staged.na.drop("any"), "clean", partition_by=("dt",))
    store.merge("staging", "main")
    return store.read("events", "main").groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )
