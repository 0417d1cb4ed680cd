from nightloom.llm import exact_dedup


def test_filters_do_not_normalise(spark, tmp_path):
    spark.createDataFrame([(1, "a b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    other = docs.selectExpr("text as sha")
    plain = exact_dedup.normalised(docs)
    joined = plain.join(other, plain.text_sha256 == other.sha)
    for plan in (exact_dedup.fingerprints(docs), joined):
        lines = plan._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert any("regexp_replace" in line for line in lines)
        assert not any("Filter" in line and ("regexp_replace" in line or "sha2" in line) for line in lines)


def test_equal_texts_that_are_huge_as_they_stand(spark):
    wide, long = "a" + " " * exact_dedup.HUGE + "b", "é x\n" * exact_dedup.HUGE
    rows = [(5, "a b"), (4, wide), (3, "a\tb"), (9, long), (8, long.replace("\n", " \t")), (7, long + "y"), (6, None), (2, "")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {3: (3, 3, True), 4: (3, 3, False), 5: (3, 3, False), 8: (8, 2, True), 9: (8, 2, False), 7: (7, 1, True), 6: (2, 2, False), 2: (2, 2, True)}
