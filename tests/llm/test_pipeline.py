"""The pipeline's stages on odd documents and against plain restatements."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline

from .cases import documents, jaccard_labels, odd_texts, shingle_set, story
from .test_quality import SF


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    documents(spark).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1), (9, 1), (6, 0)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "seven grey geese watch from the far side of an old river"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stage_names():
    assert [name for name, _ in pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "decontamination", "packing"]


def test_stages_keep_columns(spark, folder):
    docs = documents(spark)
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, documents(spark, []), folder).count() == 0
    assert stage(spark, docs, folder).columns == docs.columns
    assert pipeline.run(spark, folder).count() >= 0


def test_one_document_of_each_group(spark, folder):
    rows = odd_texts()
    got = pipeline.near_duplicates(spark, documents(spark), folder).collect()
    sets = [shingle_set(t, 5) for _, t in rows]
    labels = jaccard_labels(sets, 80, 100)
    want = Counter()
    for g in set(labels):
        group = [r for r, x in zip(rows, labels) if x == g]
        ids = [i for i, _ in group if i is not None]
        want[min(ids) if ids else None, len(set(group)) and True] += 1
    assert Counter((r.doc_id, True) for r in got) == want
    assert len(got) == len(set(labels))


def test_repeated_id_with_near_equal_texts(spark, folder):
    """One document of a group stays where they share their id, and of two unlike groups with that id one each."""
    one, two = story(31, 200), story(32, 200)
    rows = [(5, one), (5, one + " more"), (5, one + " and more"), (6, one), (5, two), (5, two + " end"), (5, "  "), (5, "  ")]
    got = [r.text for r in pipeline.near_duplicates(spark, documents(spark, rows), folder).collect()]
    assert sorted(t.startswith(one) + 2 * t.startswith(two) for t in got) == [0, 1, 2]


def test_decontaminated(spark, folder):
    got = pipeline.decontaminated(spark, documents(spark), folder).collect()
    assert len(got) == sum("seven grey geese" not in (t or "") for _, t in odd_texts())


def test_run_on_given_documents(spark):
    """Every piece belongs to a document that all filters keep, and no kept document is missing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = pipeline.run(spark, SF).toPandas()
    kept = docs
    from tickloom.llm.staging import staged

    for name, stage in pipeline.STAGES[:-1]:
        kept = staged(stage(spark, kept, SF), name)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(got.doc_id.unique()) and len(ids) == len(set(ids))
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()
    assert (got.groupby("sequence_id").length.sum() <= 2048).all()
