"""Tables that no later step reads are gone before the prefixes of all lines are shuffled."""

import os

from nightloom.llm import paragraph_dedup


def test_large_tables_are_dropped_early(spark, monkeypatch):
    line = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(i, line + (f" more{i}" if i % 2 else "") + f"\nshort {i}") for i in range(6)], "doc_id long, text string")
    seen = []

    def noted(rooted, *rest, pairs=paragraph_dedup.apart_pairs):
        path = rooted.inputFiles()[0].removeprefix("file://")
        seen.extend(name.split("-", 1)[1] for name in os.listdir(os.path.dirname(os.path.dirname(path))))
        return pairs(rooted, *rest)

    monkeypatch.setattr(paragraph_dedup, "apart_pairs", noted)
    rows = paragraph_dedup.repeats(docs).filter("kind = 'paragraph'").collect()
    assert {(r.doc_id, r.place) for r in rows} == {(i, 0) for i in range(6)} and len({r.group_id for r in rows}) == 1
    assert seen.count("classes") == 1 and not {"units", "stars", "cells", "open"} & set(seen)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
