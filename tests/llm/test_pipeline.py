"""The pipeline: every stage's decision takes effect on what the stage before it kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm import secrets, stages, toxicity
from tablewright.session import persist_to_shared
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(persist_to_shared(stage(spark, out[-1], SF_DIR), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(kept):
    assert all(df.columns == kept[0].columns for df in kept[:-1]) and kept[-1].columns == [*kept[0].columns, "copy"]


def test_toxic_documents_go(spark, kept):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score_toxicity(kept[0], labels)
    assert set(texts(kept[1])) == {r.doc_id for r in scored.where("predicted = 0").collect()}
    assert set(texts(kept[1])) >= {r.doc_id for r in labels.where("toxic = 0").collect()}  # clean documents stay


def test_one_of_each_group_stays(kept):
    before = texts(kept[1])
    assert set(texts(kept[2])) == {i for i, (_, c) in brute.components(before.items()).items() if i == c}


def test_contaminated_documents_go(spark, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    windows = brute.items_windows(items)
    assert set(texts(kept[3])) == {i for i, t in texts(kept[2]).items() if not brute.contamination(t, windows)[1]}


def test_secrets_go_and_documents_stay(kept):
    before, after = texts(kept[3]), texts(kept[4])
    assert set(before) == set(after)
    for i, t in before.items():
        found = brute.secret_spans(t, secrets.RULES)
        assert (after[i] == t) == (not found) and not any(t[a:b] in after[i] for a, _, b in found)
    assert kept[4].where(F.length("text") != F.col("n_chars")).isEmpty()


def test_mix(kept):
    sizes, taken = {}, {}
    for r in kept[4].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.SPACED.findall(r.text))
    for r in kept[5].collect():
        taken[r.source] = taken.get(r.source, 0) + len(brute.SPACED.findall(r.text))
    want = brute.targets(sizes)
    largest = max(len(brute.SPACED.findall(t)) for t in texts(kept[4]).values())
    assert all(abs(taken.get(s, 0) - want[s]) <= 2 * largest for s in want)


def test_run_is_the_stages_in_a_row(spark, kept):
    assert corpus_pipeline.run(spark, SF_DIR).exceptAll(kept[-1]).isEmpty()


def test_null_rows_pass_through_every_stage(spark, kept):
    odd = kept[0].limit(5).unionByName(spark.createDataFrame([(None,) * 5, (10**9, "", None, None, 0)], kept[0].schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = persist_to_shared(stage(spark, odd, SF_DIR), "odd")
        assert out.where("doc_id is null").count() == 1 and out.where(f"doc_id = {10**9}").count() == 1
    assert stages.mix_sources(spark, odd.limit(0), SF_DIR).collect() == []
