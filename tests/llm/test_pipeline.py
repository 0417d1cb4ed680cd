"""Every stage of the pipeline, and all of it, on awkward rows."""

import pytest

import corpus_pipeline

from . import edge

ITEM = "a benchmark item of some length that must not be learned from by anyone who is measured with it"


def tables(spark, path, labels=(), items=()):
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def documents(spark):
    more = edge.rows((20, "Some text before. " + ITEM.upper()), (21, edge.SENTENCE + " and a few words more"), (22, "shared line of several words here\nown line of this document only"), (23, "shared line of several words here\nanother line that no one has"))
    return edge.documents(spark).unionByName(spark.createDataFrame(more, edge.SCHEMA))


@pytest.mark.parametrize("number", range(5))
@pytest.mark.parametrize("empty", [False, True])
def test_stage(spark, tmp_path, number, empty):
    name, stage = corpus_pipeline.STAGES[number]
    docs = edge.empty(spark) if empty else documents(spark)
    sf = tables(spark, tmp_path, [] if empty else [(1, 1, 0), (5, 0, 1), (None, 1, 1)], [] if empty else [(1, ITEM), (2, None), (3, "")])
    out = stage(spark, docs, sf)
    if name != "packing":
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r.kind == "k" and r.gone == "g" and r.row == "r" and r.root == 3 for r in rows)
    if empty:
        assert out.count() == 0


def test_whole_run(spark, tmp_path):
    sf = tables(spark, tmp_path, items=[(1, ITEM)])
    documents(spark).write.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf).collect()
    ids = [r.doc_id for r in got if r.start == 0]
    # 6 copies 1, 20 holds the item; null and empty texts stay; rows without id have no copies
    assert 6 not in ids and 20 not in ids and {1, 2, 3, 4, 5, 7, 8, 21, 22, 23} <= set(ids)
    assert ids.count(5) == 1 and ids.count(None) == 2
    assert all(r.length == 1 for r in got if r.doc_id in (2, 3))


def test_whole_run_of_nothing(spark, tmp_path):
    sf = tables(spark, tmp_path)
    edge.empty(spark).write.parquet(f"{sf}/documents.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
