"""Operators against brute force on small fixtures, with hot keys forced."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions import paths
from tablewright.operators import aggregates, batches, chunks, clean, dedup, diff, features, gates, learning, lineage, masks, vectors
from tablewright.operators.skew import join_per_key
from tablewright.session import scratch
from tablewright.sources.snapshots import SnapshotStore


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [5, 10**6])
def test_join_per_key(spark, how, hot_rows):
    rnd = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{rnd.randrange(40)}")) for i in range(300)]
    rows = spark.createDataFrame(data, "id int, k string")
    per_key = rows.where("k IS NOT NULL AND k <> 'k1'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    got = join_per_key(rows, per_key, ["k"], "n", "id", how, hot_rows)
    want = rows.join(per_key.drop("n"), "k", how).select("id", "k", "first")
    assert got.columns == ["id", "k", "first"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_salt_takes_part_in_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
        per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        out = join_per_key(rows, per_key, ["k"], "n", "id", "left")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(k#\d+L, _salt#\d+L", plan), plan
    assert out.count() == 1000


def test_diff_between_refs_reads_changed_folders_only(spark):
    store = SnapshotStore(spark, scratch(spark, "store"))
    a = store.write(spark.range(0, 100).selectExpr("id AS k", "1 AS v"), "t")
    b = store.write(spark.range(100, 110).selectExpr("id AS k", "1 AS v"), "t")
    store.commit("main", "load", {"t": [a, b]})
    store.create_branch("dev", "main")
    assert diff.diff_refs(store, "t", "main", "dev", ["k"]).isEmpty()
    c = store.write(spark.range(100, 110).selectExpr("id AS k", "if(id = 105, 2, 1) AS v"), "t")
    store.commit("dev", "change one row", {"t": [a, c]})
    out = diff.diff_refs(store, "t", "main", "dev", ["k"])
    assert [tuple(r) for r in out.collect()] == [(105, "changed", "v")]
    assert not any(a in f for f in out.inputFiles())


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_duplicates(spark, hot_rows):
    data = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "a"), (6, None), (7, "a"), (8, "c")]
    df = spark.createDataFrame(data, "n int, k string")
    assert sorted(r.n for r in dedup.later_duplicates(df, F.col("k"), "n", hot_rows).collect()) == [3, 5, 7]
    assert {r.n: r.survivor for r in dedup.keep_first(df, F.col("k"), "n", hot_rows).collect()} == {
        1: 1, 2: 2, 3: 1, 4: 4, 5: 1, 6: 6, 7: 1, 8: 8,
    }
    assert {r.n: r.n_same for r in dedup.shared_keys(df, F.col("k"), "n", hot_rows).collect()} == {
        1: 4, 2: 1, 3: 4, 4: 1, 5: 4, 6: 1, 7: 4, 8: 1,
    }


def test_origins_of_a_long_chain_and_a_forest(spark):
    chain = spark.range(300).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    assert all(r.origin == 0 and r.steps == r.node for r in lineage.origins(chain).collect())
    forest = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", None), ("y", "gone")], "node string, parent string")
    assert {(r.node, r.origin, r.steps) for r in lineage.origins(forest).collect()} == {
        ("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("x", "x", 0), ("y", "gone", 1),
    }


def test_origins_moves_a_few_times_the_nodes(spark, monkeypatch):
    """Shuffled chains, trees, lost parents and a null node against walking; rows written grow with the nodes alone."""
    rnd = random.Random(4)
    names = [f"n{i}" for i in range(3000)]
    parent = {x: names[i - 1] if 0 < i < 2400 else names[rnd.randrange(i)] if i % 50 else None for i, x in enumerate(names)}
    rows = [*parent.items(), ("lost", "gone"), (None, "n7")]
    want = set()
    for node, up in rows:
        at, steps = node, 0
        while up is not None:
            at, steps, up = up, steps + 1, parent.get(up)
        want.add((node, at, steps))
    rnd.shuffle(rows)
    written = []
    keep = lineage.persist_to_shared
    monkeypatch.setattr(lineage, "persist_to_shared", lambda df, label="cut": written.append(keep(df, label)) or written[-1])
    got = [tuple(r) for r in lineage.origins(spark.createDataFrame(rows, "node string, parent string"), few=200).collect()]
    assert set(got) == want and len(got) == len(want)
    assert sum(df.count() for df in written) < 8 * len(rows)
    with pytest.raises(ValueError, match="cycle"):
        ring = spark.range(300).select(F.col("id").alias("node"), F.pmod(F.col("id") + 1, F.lit(300)).alias("parent"))
        lineage.origins(ring, max_rounds=3, few=20)


def test_origins_rejects_cycles(spark):
    ring = spark.createDataFrame([("a", "b"), ("b", "a")], "node string, parent string")
    with pytest.raises(ValueError, match="cycle"):
        lineage.origins(ring, max_rounds=4)


def test_upstream_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("z", "c"), ("q", "r")], "source string, target string")
    start = spark.createDataFrame([("c",)], "node string")
    assert {(r.node, r.hops) for r in lineage.upstream(edges, start).collect()} == {("c", 0), ("b", 1), ("z", 1), ("a", 2)}


def test_fixed_chunks(spark):
    texts = {1: "", 2: "ab", 3: "x" * 10, 4: "abcdefghijk", 5: "né" * 40}
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    got = {}
    for r in chunks.fixed_chunks(df, "id", size=10, overlap=3).orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.chunk)
    for k, text in texts.items():
        want, at = [], 0
        while text and (at == 0 or at - 7 + 10 < len(text)):
            want.append(text[at : at + 10])
            at += 7
        assert got.get(k, []) == want, k


def test_separator_chunks_cover_the_text(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 12))) for _ in range(400)]
    text = "".join(w + rnd.choice([" ", " ", "\n", "\n\n"]) for w in words)
    df = spark.createDataFrame([(1, text), (2, "z" * 250), (3, ""), (4, "  \n ")], "id int, text string")
    out = chunks.separator_chunks(df, "id", size=100, overlap=20).orderBy("id", "chunk_no").collect()
    mine = [r.chunk for r in out if r.id == 1]
    assert max(map(len, mine)) <= 100 and len(mine) > 5
    seen = set(w for c in mine for w in c.split())
    assert seen == set(words)  # no word is cut, none is lost
    at = 0
    for c in mine:  # chunks follow each other and leave only white space between them
        start = text.index(c, max(0, at - 120))
        assert not text[at:start].strip()
        at = start + len(c)
    assert not text[at:].strip()
    assert "".join(r.chunk for r in out if r.id == 2)[:250].count("z") == 250
    assert not [r for r in out if r.id in (3, 4)]


def test_nearest_vectors(spark):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 6))
    x[7] = x[3]  # a tie
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    d = np.sqrt(((x - x[3]) ** 2).sum(axis=1))
    want = sorted(range(300), key=lambda i: (d[i], i))[:4]
    assert [r.vec_id for r in vectors.nearest(df, x[3].tolist(), 4).collect()] == want
    asked = spark.createDataFrame([(i, x[i].tolist()) for i in (3, 50)], "query_id long, vector array<double>")
    many = vectors.nearest_many(df, asked, 4).where("query_id = 3").orderBy("rank").collect()
    assert [r.vec_id for r in many] == want


def brute_mask(text, height):
    n = list(map(int, text.split()))
    return {p for s, c in zip(n[::2], n[1::2]) for p in range(s - 1, s - 1 + c)}


def test_masks(spark):
    rnd = random.Random(9)
    data = [(k % 4, " ".join(f"{rnd.randrange(1, 900)} {rnd.randrange(1, 40)}" for _ in range(rnd.randrange(1, 5)))) for k in range(60)]
    data.append((0, "1 3 10 5"))
    df = spark.createDataFrame(data, "image_id int, encoded_pixels string")
    pixels = {}
    for k, text in data:
        pixels.setdefault(k, set()).update(brute_mask(text, 100))
    assert {r.image_id: r.union_area for r in masks.union_area(df, tile=64).collect()} == {k: len(v) for k, v in pixels.items()}
    for r in masks.mask_boxes(df, 100).collect():
        px = brute_mask(r.encoded_pixels, 100)
        cols, rws = [p // 100 for p in px], [p % 100 for p in px]
        assert (r.x0, r.x1, r.y0, r.y1) == (min(cols), max(cols), min(rws), max(rws))


def test_metrics(spark):
    pairs = [(1, 1)] * 5 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 10
    df = spark.createDataFrame([(i % 3, y, p) for i, (y, p) in enumerate(pairs)], "k int, label int, pred int")
    m = features.binary_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall) == (15 / 20, 5 / 8, 5 / 7)
    f = features.f1_scores(df).first()
    f1, f0 = 10 / 15, 20 / 25
    assert f.f1_micro == pytest.approx(0.75) and f.f1_weighted == pytest.approx((7 * f1 + 13 * f0) / 20)
    w = {r.label: r.weight for r in features.class_weights(df, "label").collect()}
    assert w == {0: 20 / (2 * 13), 1: 20 / (2 * 7)}
    none = spark.createDataFrame([(1, 0, 0)], "k int, label int, pred int")
    assert features.binary_metrics(none).first().precision == 0.0
    assert features.iou_scores(df, "k").first().iou_pooled == pytest.approx(0.5)


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = features.Scaler.fit(df, ["a", "b"]).apply(df).orderBy("a").collect()
    assert out[0].a_scaled == pytest.approx(-np.sqrt(1.5)) and out[0].b_scaled == 0.0


def test_values_per_key_is_whole_and_bounded(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") % 2500).alias("v"))
    out = aggregates.values_per_key(df, "k", "v", block=100).collect()
    assert max(len(r["values"]) for r in out) < 200
    assert sum(v["count"] for r in out for v in r["values"]) == 3000 == sum(r.n_values for r in out)
    assert {r.n_total for r in out} == {3000} and len({v["value"] for r in out for v in r["values"]}) == 2500


def test_values_per_key_takes_any_type_and_null_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, "y"), (None, "z")], "k string, v string")
    out = aggregates.values_per_key(df, "k", "v", block=1).collect()
    got = sorted((str(r.k), r.n_total, str(v["value"]), v["count"]) for r in out for v in r["values"])
    assert got == [("None", 2, "y", 1), ("None", 2, "z", 1), ("a", 3, "None", 1), ("a", 3, "x", 2)]


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_median_is_exact_whatever_the_sketch(spark, accuracy):
    rnd = np.random.default_rng(3)
    data = [(int(g), float(v)) for g, v in zip(rnd.choice(3, 4000, p=[0.9, 0.099, 0.001]), rnd.integers(0, 900, 4000))] + [(7, None)]
    out = aggregates.dim_aggregates(spark.createDataFrame(data, "g int, v double"), ["g"], "v", accuracy).collect()
    for r in out:
        own = sorted(v for g, v in data if str(g) == r.value and v is not None)
        assert r.median_value == (own[(len(own) + 1) // 2 - 1] if own else None)


def test_many_query_vectors_come_in_blocks(spark):
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(40, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    asked = spark.range(10_500).select(F.col("id").alias("query_id"), F.array(*[F.rand(s) for s in range(3)]).alias("vector"))
    out = vectors.nearest_many(df, asked, 1)
    assert out.count() == 10_500
    some = {r.query_id: np.array(r.vector) for r in asked.where("query_id % 997 = 0").collect()}
    for r in out.where("query_id % 997 = 0").collect():
        assert r.vec_id == int(((x - some[r.query_id]) ** 2).sum(axis=1).argmin())


def test_forest_takes_wide_text_columns(spark):
    df = spark.range(400).select((F.col("id") % 2).cast("double").alias("y"), F.col("id").cast("double").alias("n"), F.concat(F.lit("c"), F.col("id") % 81).alias("t"))
    model = learning.train_forest(df, "y", ["n"], ["t"], trees=2)
    assert model.transform(df).where("pred is not null").count() == 400


def test_nearest_descriptor(spark):
    objs = spark.createDataFrame([("a/b/c/1",), ("a/2",), ("x/3",), ("4",)], "path string")
    desc = spark.createDataFrame([("a/meta.yaml",), ("a/b/meta.yaml",)], "path string")
    for hot_rows in (1, 10**6):
        got = {r.path: r.descriptor for r in gates.nearest_descriptor(objs, desc, "meta.yaml", hot_rows).collect()}
        assert got == {"a/b/c/1": "a/b/meta.yaml", "a/2": "a/meta.yaml", "x/3": None, "4": None}
    top = desc.unionByName(spark.createDataFrame([("meta.yaml",)], "path string"))
    got = {r.path: r.descriptor for r in gates.nearest_descriptor(objs, top, "meta.yaml").collect()}
    assert got["x/3"] == got["4"] == "meta.yaml"


def test_descriptor_rules_strict(spark):
    df = spark.createDataFrame([("d", {"rank": "3"})], "path string, fields map<string,string>")
    rule = [{"name": "rank", "required": True, "type": "number"}, {"name": "team", "type": "string"}]
    assert gates.descriptor_fields(df, rule).isEmpty()
    assert [r.detail for r in gates.descriptor_fields(df, rule, strict=True).collect()] == ["team is absent"]


def test_blocked_pattern_is_unanchored(spark):
    df = spark.createDataFrame([("t", "my_private", "string"), ("t", "name", "string")], "table string, column string, type string")
    assert [r.subject for r in gates.blocked_columns(df, ["private_*"]).collect()] == ["t.my_private"]


def test_paths(spark):
    df = spark.createDataFrame([("a/b/c.tar.gz",), ("top",)], "p string")
    p = F.col("p")
    rows = df.select(paths.parent(p), paths.base_name(p), paths.suffix(p), paths.folders(p)).collect()
    assert tuple(rows[0]) == ("a/b", "c.tar.gz", ".gz", ["a/b", "a", ""])
    assert tuple(rows[1]) == ("", "top", "", [""])


def test_align_schema(spark):
    target = spark.createDataFrame([], "a int, b double, c string").schema
    df = spark.createDataFrame([("2.5", "7", 1), ("x", "y", 2)], "B string, A string, extra int")
    assert [tuple(r) for r in clean.align_schema(df, target).collect()] == [(7, 2.5, None), (None, None, None)]
    assert clean.align_report(df, target) == {"missing": ["c"], "extra": ["extra"]}


def test_bucketize_outside_is_null(spark):
    df = spark.createDataFrame([(0,), (3,), (10,), (11,)], "v int")
    out = [r[0] for r in df.select(clean.bucketize(F.col("v"), [(1, 3, "low"), (7, 10, "high")])).collect()]
    assert out == [None, "low", "high", None]


def test_safe_udf_drops_bad_input(spark):
    df = spark.createDataFrame([(1, "12"), (2, "no"), (3, None)], "id int, v string")
    assert [(r.id, r.v) for r in batches.enrich(df, "v", lambda s: str(int(s) + 1), "string").collect()] == [(1, "13")]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (None, "x", 1.0)], "a int, b string, c double")
    assert {r.column: r.n_missing for r in clean.null_counts(df).collect()} == {"a": 1, "b": 1, "c": 1}


def test_best_run_ties_and_failures(spark):
    df = spark.createDataFrame([("b", 0.9, "FINISHED"), ("a", 0.9, "FINISHED"), ("c", 1.0, "FAILED")], "run_id string, metric double, status string")
    assert aggregates.best_run(df).first().run_id == "a"
    assert aggregates.best_run(df.where("status = 'FAILED'")).isEmpty()


def test_audits_fire(spark):
    t = spark.createDataFrame([("x", 2020), (None, 2021)], "d string, year int")
    assert [(r.subject, r.detail) for r in gates.null_dimensions(t, ["d", "year"]).collect()] == [("d", "1")]
    src = spark.createDataFrame([(2021,)], "year int")
    late = gates.freshness(src, {"old": t.where("year = 2020"), "new": t, "none": t.limit(0)}, F.col("year"))
    assert sorted(r.subject for r in late.collect()) == ["none", "old"]
    want = spark.createDataFrame([("x",), ("z",)], "value string")
    got = {(r.subject, r.detail) for r in gates.membership(t.na.drop(), "d", want).collect()}
    assert got == {("z", "missing")}


def test_median_narrows_a_hot_group_in_rounds(spark):
    rnd = np.random.default_rng(5)
    data = [(None if g == 2 else int(g), int(v)) for g, v in zip(rnd.choice(3, 6000, p=[0.9, 0.05, 0.05]), rnd.normal(0, 900, 6000))]
    data += [(5, 7)] * 300 + [(5, v) for v in range(299)] + [(6, 1), (6, 2)]
    df = spark.createDataFrame(data, "g int, v int")
    out = aggregates.dim_aggregates(df, ["g"], "v", accuracy=10, block=3).collect()  # a coarse sketch leaves much to narrow
    assert len(out) == 5
    for r in out:
        own = sorted(v for g, v in data if (None if g is None else str(g)) == r.value)
        assert (r.n_rows, r.median_value) == (len(own), own[(len(own) + 1) // 2 - 1]), r


@pytest.mark.parametrize("tile", [1, 64, 100, 1024])
def test_union_area_of_masks_on_one_image(spark, tile):
    rnd = random.Random(tile)
    data = [(0, f"{rnd.randrange(1, 3000)} {rnd.choice([0, 1, 63, 64, 65, 700])}") for _ in range(400)]
    data += [(0, "5 64")] * 500 + [(1, None), (2, ""), (3, "1 128 65 64")]
    df = spark.createDataFrame(data, "image_id int, encoded_pixels string")
    got = {r.image_id: r.union_area for r in masks.union_area(df, tile).collect()}
    pixels = set().union(*[brute_mask(text, 1) for k, text in data if k == 0])
    assert got == {0: len(pixels), 3: 128}


def test_union_area_shuffles_one_row_per_tile(spark):
    df = spark.createDataFrame([(0, "1 5")] * 50, "image_id int, encoded_pixels string")
    plan = masks.union_area(df, 1024)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Window" not in plan, plan


def test_typed_descriptor_fields(spark):
    rules = [
        {"name": "pii", "required": True, "type": "boolean"}, {"name": "rank", "type": "number", "choices": [1, 2.5]},
        {"name": "link", "pattern": "^https?:"}, {"name": "tags", "type": "table"}, {"name": "team", "choices": ["3", "it"]},
    ]
    bodies = {
        "good": '{"pii": false, "rank": 2.5, "link": "http://x", "tags": ["a"], "team": "3"}',
        "bare": '{"pii": true}',
        "quoted": '{"pii": "true", "rank": "123", "team": 3}',
        "void": '{"pii": null, "link": 4, "tags": "a"}',
        "off": '{"pii": true, "rank": 3, "link": "ftp://x"}',
        "list": "[]", "torn": '{"pii": ', "none": None, "text": '"pii"',
    }
    df = spark.createDataFrame(list(bodies.items()), "path string, body string")
    got = {}
    for r in gates.typed_fields(df, rules).collect():
        got.setdefault(r.subject, set()).add(r.detail)
    bad = {"not a JSON object"}
    assert got == {
        "quoted": {"pii is not a boolean", "rank is not a number", "rank is not an allowed choice", "team is not an allowed choice"},
        "void": {"pii is required", "link is not text", "tags is not a table"},
        "off": {"rank is not an allowed choice", "link does not match its pattern"},
        "list": bad, "torn": bad, "none": bad, "text": bad,
    }
    absent = {r.detail for r in gates.typed_fields(df.where("path = 'bare'"), rules, strict=True).collect()}
    assert absent == {"rank is absent", "tags is absent", "team is absent"}
