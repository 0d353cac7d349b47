"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import datetime

import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, html_text, licenses, merkle, mixing, near_copies, packing, phrases, quality, repeats, secrets, toxicity, url_lists

LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
# Columns that some operator also makes, with other types.
SCHEMA = "doc_id long, text string, source string, size string, score string, labels int, blob int, kept string, target string, n_words string, host int"
ROWS = [
    (1, "All rights reserved. cc by token = 'abcdefgh12345'", "a"), (1, "All rights reserved. cc by token = 'abcdefgh12345'", "a"),
    (2, "", "a"), (3, None, None), (None, "some words without an id", "b"), (4, LONG, None), (5, " \n\t ", "b"), (6, LONG, "a"),
    (7, "é" * 60, "é"), (8, "one two", "b"), (9, "one two", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "x", 1, 2, "x", "x", "x", 3) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    first = " ".join(LONG.split()[100:115])
    return spark.createDataFrame([("i1", first), ("i1", first), ("i2", None), ("i3", ""), (None, "cc by"), ("i4", "one two")], "item_id string, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (4, 0), (None, 1), (5, None), (6, 0), (6, 0)], "doc_id long, toxic int")


OPERATORS = {
    "licenses": lambda d, i, y: licenses.scan_licenses(d),
    "quality": lambda d, i, y: quality.quality(d),
    "keep_good": lambda d, i, y: quality.keep_good(d),
    "repeats": lambda d, i, y: repeats.remove_repeats(d),
    "near_copies": lambda d, i, y: near_copies.similar_documents(d),
    "keep_one": lambda d, i, y: near_copies.keep_one(d),
    "secrets": lambda d, i, y: secrets.scan_secrets(d)[0],
    "toxicity": lambda d, i, y: toxicity.score_toxicity(d, y),
    "mix_plan": lambda d, i, y: mixing.mix_plan(d),
    "mix": lambda d, i, y: mixing.mix(d),
    "decontaminate": lambda d, i, y: decontaminate.decontaminate(d, i),
    "keep_clean": lambda d, i, y: decontaminate.keep_clean(d, i),
    "manifest": lambda d, i, y: merkle.audit(merkle.build(d, ["doc_id", "source", "text"], tree="source")),
    "phrases": lambda d, i, y: phrases.collocations(d, lang="source", least=1),
    "packing": lambda d, i, y: packing.pack(packing.pieces(d)),
    "sequences": lambda d, i, y: packing.sequences(packing.pack(packing.pieces(d))),
    "html": lambda d, i, y: html_text.extract(d, "text"),
    "urls": lambda d, i, y: url_lists.judge(
        d.withColumn("fetched", F.lit(datetime.date(2024, 1, 1))),
        d.select(F.lit("x").alias("list"), F.col("source").alias("pattern"), F.lit(None).cast("date").alias("day"), F.lit("add").alias("op")), "text"),
}
FEWER = ("phrases", "packing", "sequences", "near_copies", "keep_good", "keep_one", "mix", "keep_clean")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, items, labels, name):
    out = OPERATORS[name](docs, items, labels)
    assert len(set(out.columns)) == len(out.columns) and not [c for c in out.columns if c.startswith("__")]
    rows = out.collect()
    if name not in FEWER:
        assert len(rows) == len(ROWS)
        same = [str(r) for r in rows if r.doc_id == 1]
        assert name in ("mix_plan", "manifest") or len(set(same)) == 1  # equal rows, equal results


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, items, labels, name):
    full = OPERATORS[name](docs, items, labels)
    none = OPERATORS[name](docs.limit(0), items.limit(0), labels.limit(0))
    assert none.collect() == [] and none.columns == full.columns


def test_empty_side_tables(docs, items, labels):
    assert decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").isEmpty()
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1 or score > 0.01").isEmpty()


def test_values_of_odd_rows(docs, items, labels):
    lic = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert (lic[1].n_words, lic[1].n_base, lic[1].first_word, lic[1].last_word, lic[1].base_labels) == (7, 2, 0, 3, "cc-by,reserved")
    assert (lic[3].n_words, lic[3].first_word, lic[3].labels, lic[3].score) == (0, None, "", 0.0) and lic[4].n_words == 40_000
    dec = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.decontaminate(docs, items).collect()}
    assert dec[4] == dec[6] == (40_000, 15, 1, True) and dec[8] == dec[9] == (2, 2, 1, True)
    assert dec[1] == (7, 2, 0, True) and dec[3] == dec[2] == dec[5] == (0, 0, 0, False)
    near = {r.doc: (r.n_shingles, r.component) for r in near_copies.similar_documents(docs).collect()}
    assert near[4] == near[6] == (39_996, 4) and near[8] == near[9] == (1, 8) and near[2] == (0, 2) and near[5] == (0, 5) and None not in near
    cut = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert cut[4].n_removed == 0 and cut[6].n_removed == cut[6].n_bytes and bytes(cut[6].kept) == b"" and cut[6].n_spans == 1
    assert bytes(cut[7].kept).decode() == "é" * 60 and cut[3].n_bytes == 0
    plan = mixing.mix_plan(docs).collect()
    assert {r.source_size for r in plan if r.source is None} == {40_000} and all(r.taken == 0 for r in plan if r.size == 0)
