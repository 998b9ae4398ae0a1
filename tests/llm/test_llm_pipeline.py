"""The stages of the pipeline on planted and awkward rows."""

import shutil

import pytest
from awkward import PLAIN, awkward_docs, empty_docs

import corpus_pipeline
from gridstats.llm.queries import QUERIES

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with the side tables, where benchmark item 1 is the plain text."""
    folder = tmp_path_factory.mktemp("tables")
    labels = [(i, 1, int(i % 2)) for i in range(1, 12)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(1, PLAIN), (2, None)], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    yield str(folder)
    shutil.rmtree(folder)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, tables, name):
    for docs in (awkward_docs(spark), empty_docs(spark)):
        done = STAGES[name](spark, docs, tables)
        assert done.columns == docs.columns
        assert done.count() <= docs.count()


def test_one_of_each_group_stays(spark, tables):
    kept = [r["doc_id"] for r in STAGES["ngram_jaccard_join"](spark, awkward_docs(spark), tables).collect()]
    assert sorted(k or 0 for k in kept) == [0, 0, 1, 3, 4, 5, 6, 8, 9, 10]


def test_leaks_go(spark, tables):
    kept = {r["doc_id"] for r in STAGES["benchmark_decontamination"](spark, awkward_docs(spark), tables).collect()}
    assert kept == {3, 4, 5, 6, 7, 8, 9, 10, 11, None}


def test_tokens_come_last(spark, tables):
    docs = awkward_docs(spark)
    done = STAGES["bpe"](spark, docs, tables)
    assert done.count() == 14 and done.where("n_tokens <> size(token_ids)").count() == 0


def test_run_drops_toxic_texts_and_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = corpus_pipeline.run(spark, sf_dir)
    ids = {r["doc_id"] for r in done.select("doc_id").collect()}
    assert 0 < len(ids) < docs.count()
    leaked = {r["doc_id"] for r in QUERIES["op4_benchmark_decontamination"](spark, sf_dir).collect()}
    assert not ids & leaked
    assert done.columns == [*docs.columns, "token_ids", "n_tokens"]
