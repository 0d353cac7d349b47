"""Registered queries: feature preparation, text, vectors, masks, experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import aggregates, batches, chunks, clean, features, learning, masks, reindex, vectors
from tablewright.plans.registry import query
from tablewright.session import persist_to_shared
from tablewright.sources.snapshots import SnapshotStore


@query(
    "safe_pandas_udf",
    r"SELECT doc_id, length(text) AS n_bytes FROM documents WHERE length(text) = length(regexp_replace(text, '[^\x{00}-\x{FF}]', '', 'g'))",
)
def _(t):
    encoded = batches.enrich(t.documents.select("doc_id", "text"), "text", lambda s: s.encode("latin-1"), "binary")
    return encoded.select("doc_id", F.length("text").cast("bigint").alias("n_bytes"))


_AREA = "CAST(l_quantity AS BIGINT) + 1 + l_linenumber"


@query(
    "mask_stats",
    f"""SELECT l_orderkey AS image_id, count(*) AS n_masks, CAST(sum({_AREA}) AS BIGINT) AS sum_area, max({_AREA}) AS max_area
    FROM lineitem GROUP BY 1""",
)
def _(t):
    return masks.mask_stats(t.masks)


@query(
    "rle_area",
    """WITH r AS (SELECT l_orderkey AS image_id, l_partkey % 5000 AS lo, l_partkey % 5000 + CAST(l_quantity AS BIGINT) AS hi FROM lineitem
    UNION ALL SELECT l_orderkey, l_suppkey * 100, l_suppkey * 100 + 1 + l_linenumber FROM lineitem)
    SELECT image_id, count(*) AS union_area FROM (SELECT DISTINCT image_id, unnest(generate_series(lo, hi - 1)) AS px FROM r) GROUP BY 1""",
)
def _(t):
    return masks.union_area(t.masks, tile=1024)


@query(
    "rle_box",
    """WITH r AS (SELECT l_orderkey AS image_id, l_linenumber AS mask_no, l_partkey AS part_no, l_suppkey, l_partkey % 5000 AS a0,
    l_partkey % 5000 + CAST(l_quantity AS BIGINT) - 1 AS a1, l_suppkey * 100 AS b0, l_suppkey * 100 + l_linenumber AS b1 FROM lineitem),
    s AS (SELECT *, a0 // 100 <> a1 // 100 OR b0 // 100 <> b1 // 100 AS crosses FROM r)
    SELECT image_id, mask_no, part_no, least(a0, b0) // 100 AS x0, CASE WHEN crosses THEN 0 ELSE least(a0 % 100, b0 % 100) END AS y0,
    greatest(a1, b1) // 100 AS x1, CASE WHEN crosses THEN 99 ELSE greatest(a1 % 100, b1 % 100) END AS y1 FROM s""",
)
def _(t):
    return masks.mask_boxes(t.masks, height=100).drop("encoded_pixels")


@query(
    "batch_transform",
    """SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: (CAST(v AS DOUBLE) - 0.5) / 0.25)), 6) AS total,
    round((CAST(embedding[1] AS DOUBLE) - 0.5) / 0.25, 6) AS first_value FROM embeddings""",
)
def _(t):
    out = batches.normalise_vectors(t.embeddings, "vec_id", "embedding", 0.5, 0.25)
    return out.select(
        "vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v), 6).alias("total"),
        F.round(F.get("embedding", 0), 6).alias("first_value"),
    )


_TEST_SHARE = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


@query("pca_features", "SELECT i, count(*) AS n_rows, true AS explains_its_share, true AS uncorrelated FROM embeddings, range(6) r(i) GROUP BY i")
def _(t):
    """Each component's variance is its explained share of all scaled variance, and components do not correlate."""
    vectors_ = t.embeddings.select("vec_id", "embedding")
    out, explained = learning.pca(vectors_, "embedding", 6)
    dims = vectors_.agg(F.max(F.size("embedding"))).first()[0]  # all vectors have one length
    parts = out.select("components", F.posexplode("components").alias("i", "x"))
    next_ = F.col("components")[(F.col("i") + 1) % 6]
    share = F.element_at(F.array(*map(F.lit, explained)), F.col("i") + 1)
    return parts.groupBy("i", share.alias("share")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.var_samp("x").alias("v"), F.corr("x", next_).alias("r")
    ).select(F.col("i").cast("long").alias("i"), "n_rows", (F.abs(F.col("v") / dims - F.col("share")) < 1e-6).alias("explains_its_share"), (F.abs("r") < 1e-6).alias("uncorrelated"))


@query(
    "train_rf",
    f"""SELECT count(*) AS n_scored, true AS both_known, true AS beats_a_coin FROM labels JOIN documents USING (doc_id)
    WHERE {_TEST_SHARE} >= 0.8""",
)
def _(t):
    rows = t.labels.join(t.documents.select("doc_id", "lang", "source", "n_chars"), "doc_id").withColumn(
        "split", clean.split_label("doc_id")
    )
    model = learning.train_forest(rows.where("split = 'train'"), "quality", ["n_chars", "toxic"], ["lang", "source"])
    scored = model.transform(rows.where("split = 'test'")).select(F.col("quality").alias("label"), F.col("pred").cast("int").alias("pred"))
    scored = persist_to_shared(scored, "scored")
    accuracy = features.binary_metrics(scored).select("accuracy").scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"), (F.min("pred") >= 0).alias("both_known"), (accuracy >= 0.5).alias("beats_a_coin")
    )


@query(
    "promote_best_run",
    """WITH best AS (SELECT run_id FROM runs WHERE status = 'FINISHED' ORDER BY metric DESC, run_id LIMIT 1)
    SELECT doc_id, label, pred, (SELECT run_id FROM best) AS run_id FROM predictions JOIN documents USING (doc_id)
    WHERE 'run-' || source = (SELECT run_id FROM best)""",
)
def _(t):
    store = SnapshotStore(t.spark, t.scratch("store"))
    scored = t.predictions.join(t.documents.select("doc_id", "source"), "doc_id").select(
        "doc_id", "label", "pred", F.concat(F.lit("run-"), "source").alias("run_id")
    )
    store.overwrite("main", "scores", scored.limit(0), "no experiment yet")
    best = aggregates.best_run(t.runs).first()  # one row
    store.create_branch(best["branch"], "main")
    winner = scored.where(F.col("run_id") == best["run_id"])
    store.overwrite(best["branch"], "scores", winner, "scores", metadata={"run": best["run_id"], "metric": str(best["metric"])})
    store.merge(best["branch"], "main")
    return store.read("scores", "main")


@query("shuffle_stable", "SELECT doc_id, md5('42' || doc_id) AS position_key FROM documents ORDER BY position_key")
def _(t):
    key = clean.stable_order("doc_id", "42").alias("position_key")
    return t.documents.select("doc_id", key).orderBy("position_key")


@query(
    "chunk_text",
    """SELECT doc_id, n AS chunk_no, substr(text, 900 * n + 1, 1000) AS chunk FROM (SELECT doc_id, text,
    unnest(generate_series(0, CAST(greatest(ceil((length(text) - 1000) / 900.0), 0) AS BIGINT))) AS n FROM documents WHERE length(text) > 0)""",
)
def _(t):
    return chunks.fixed_chunks(t.documents, "doc_id").select("doc_id", "chunk_no", "chunk")


@query(
    "chunk_text_separators",
    """SELECT doc_id, true AS fits, true AS in_text, true AS starts, true AS ends, true AS covers FROM documents WHERE regexp_matches(text, '[^\\s]')""",
)
def _(t):
    """Per document: no chunk is too long, each stands in the text, the first and last stand at its ends, and together
    they are no shorter than the text without its blanks."""
    cut = chunks.separator_chunks(t.documents, "doc_id").join(t.documents.select("doc_id", "text"), "doc_id")
    bare = F.length(F.regexp_replace("text", r"\s", ""))
    trimmed = F.regexp_replace("text", r"^\s+|\s+$", "")
    return cut.groupBy("doc_id").agg(
        (F.max(F.length("chunk")) <= 1000).alias("fits"), F.min(F.contains("text", "chunk")).alias("in_text"),
        F.startswith(F.any_value(trimmed), F.min_by("chunk", "chunk_no")).alias("starts"),
        F.endswith(F.any_value(trimmed), F.max_by("chunk", "chunk_no")).alias("ends"),
        (F.sum(F.length(F.regexp_replace("chunk", r"\s", ""))) >= F.any_value(bare)).alias("covers"),
    )


_QUERY_VECTOR = "(SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1)"


@query(
    "vector_topk",
    f"""SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), CAST({_QUERY_VECTOR} AS DOUBLE[])), 6) AS distance FROM embeddings
    ORDER BY list_distance(CAST(embedding AS DOUBLE[]), CAST({_QUERY_VECTOR} AS DOUBLE[])), vec_id LIMIT 4""",
)
def _(t):
    query_vector = t.embeddings.agg(F.min_by("embedding", "vec_id").alias("q")).first()["q"]
    return vectors.nearest(t.embeddings, query_vector, k=4).select("vec_id", F.round("distance", 6).alias("distance"))


@query(
    "vector_topk_many",
    """WITH q AS (SELECT CAST(label AS BIGINT) AS query_id, arg_min(embedding, vec_id) AS q FROM embeddings GROUP BY label),
    d AS (SELECT query_id, vec_id, list_distance(CAST(embedding AS DOUBLE[]), CAST(q AS DOUBLE[])) AS distance FROM embeddings, q)
    SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, round(distance, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS r FROM d)
    WHERE r <= 4""",
)
def _(t):
    asked = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("vector"))
    out = vectors.nearest_many(t.embeddings, asked, k=4)
    return out.withColumn("distance", F.round("distance", 6))


@query(
    "answers_by_version",
    """SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, length(a.text) AS version1, length(b.text) AS version2
    FROM documents a FULL JOIN documents_dev b ON a.doc_id = b.doc_id""",
)
def _(t):
    def answers(docs, version):
        return docs.select("doc_id", F.lit(version).alias("version"), F.length("text").cast("bigint").alias("answer"))

    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "answers", answers(t.documents, "version1"), "answers to version 1")
    store.append("main", "answers", answers(t.documents_dev, "version2"), "answers to version 2")
    return store.read("answers", "main").groupBy("doc_id").pivot("version", ["version1", "version2"]).agg(F.max("answer"))


@query(
    "rechunk_changed",
    """SELECT doc_id, n AS chunk_no, substr(text, 900 * n + 1, 1000) AS chunk FROM (SELECT doc_id, text,
    unnest(generate_series(0, CAST(greatest(ceil((length(text) - 1000) / 900.0), 0) AS BIGINT))) AS n FROM documents_dev d
    WHERE NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id = d.doc_id AND o.text = d.text))""",
)
def _(t):
    return chunks.rechunk_changed(t.documents, t.documents_dev, "doc_id").select("doc_id", "chunk_no", "chunk")


def two_text_versions(t) -> SnapshotStore:
    """Documents in a folder per language; on dev the French ones are written anew, and some of them differ."""
    store = SnapshotStore(t.spark, t.scratch("store"))
    columns = ["doc_id", "lang", "text"]
    of = lambda df, keep: store.write(df.where(keep).select(*columns), "documents")
    french = F.col("lang") == "fr"
    rest = of(t.documents, ~F.coalesce(french, F.lit(False)))
    store.commit("main", "load", {"documents": [rest, of(t.documents, french)]})
    store.create_branch("dev", "main")
    store.commit("dev", "new French texts", {"documents": [rest, of(t.documents_dev, french)]})
    return store


_CHUNKS_OF = """SELECT doc_id, n AS chunk_no, substr(text, 900 * n + 1, 1000) AS chunk FROM (SELECT doc_id, text,
    unnest(generate_series(0, CAST(greatest(ceil((length(text) - 1000) / 900.0), 0) AS BIGINT))) AS n FROM {0} WHERE lang = 'fr' AND length(text) > 0)"""


@query(
    "reindex_changed_chunks",
    f"""WITH o AS ({_CHUNKS_OF.format("documents")}), n AS ({_CHUNKS_OF.format("documents_dev")})
    SELECT doc_id, chunk_no, CASE WHEN n.chunk IS NULL THEN 'delete' ELSE 'upsert' END AS op, n.chunk
    FROM n FULL JOIN o USING (doc_id, chunk_no) WHERE n.chunk IS DISTINCT FROM o.chunk""",
)
def _(t):
    """Digests of main are stored first; the new version then reads the folder it adds and digests, no old text."""
    index = reindex.ChunkIndex(two_text_versions(t), "documents", "doc_id")
    index.digests(index.store.tables("main")["documents"], index.store.tables("main")["documents"][0])
    return index.updates("main", "dev")


@query(
    "medallion_stages",
    """SELECT lang, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars, 3 AS n_tags FROM documents
    WHERE length(trim(text)) >= 100 GROUP BY lang""",
)
def _(t):
    store = SnapshotStore(t.spark, t.scratch("store"))
    store.overwrite("main", "bronze", t.documents.select("doc_id", "lang", "text"), "bronze")
    store.tag("bronze-v1", "main")
    silver = store.read("bronze", "bronze-v1").where(F.length(F.trim("text")) >= 100)
    store.overwrite("main", "silver", silver, "silver")
    store.tag("silver-v1", "main")
    gold = store.read("silver", "silver-v1").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text")).cast("bigint").alias("n_chars")
    )
    store.overwrite("main", "gold", gold, "gold")
    store.tag("gold-v1", "main")
    n_tags = store.refs().where("kind = 'tag'").count()
    return store.read("gold", "gold-v1").withColumn("n_tags", F.lit(n_tags))
