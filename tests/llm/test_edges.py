"""Defined results of every operator on awkward rows."""

import zlib

import pytest

from nightloom.llm import decontamination, exact_dedup, html_extraction, jaccard_join, license_scan, line_dedup, packing, paragraph_dedup, sharding, toxicity
from nightloom.llm.queries import tokenizer_path

from . import edge


def test_exact(spark):
    out = exact_dedup.exact_duplicates(edge.documents(spark)).collect()
    assert len(out) == 12
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].keep_id == 1 and by[1][0].group_size == 4 and by[1][0].kept
    assert sorted(r.kept for r in by[5]) == [False, True] and by[5][0].group_size == 2
    assert [r.kept for r in by[6]] == [False, False]
    assert {r.keep_id for r in by[None]} == {1, 2} and not any(r.kept for r in by[None])
    assert by[2][0].group_size == 3 and by[3][0].keep_id == 2  # null counts as empty
    assert by[4][0].group_size == 1  # a single space is a text of its own


def test_sharding(spark):
    out = sharding.shard_documents(edge.documents(spark), 3).collect()
    assert len(out) == 12
    for s in {r.shard for r in out}:
        places = sorted(r.slot for r in out if r.shard == s)
        assert places == list(range(len(places)))
    assert {(r.doc_id, r.size, r.text_crc32) for r in out if r.doc_id == 2} == {(2, 8, 0)}
    one = next(r for r in out if r.doc_id == 8)
    assert one.text_crc32 == zlib.crc32(("ünï " * 3).encode()) and one.size == 8 + len(("ünï " * 3).encode())


def test_packing(spark):
    out = packing.pack(edge.documents(spark), tokenizer_path()).collect()
    assert sum(r.length for r in out if r.doc_id in (2, 3, 4)) == 3  # only the closing id
    pieces = sorted((r.start, r.length, r.doc_tokens) for r in out if r.doc_id == 5)
    assert sum(n for _, n, _ in pieces) == 2 * pieces[0][2]
    for s in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096


def test_jaccard(spark):
    out = jaccard_join.similarity_groups(edge.documents(spark)).collect()
    assert len(out) == 12
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id in (1, 2, 3, 4, 6, 7)} == {(1, 11, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 11, 1), (7, 1, 7)}
    assert {r.component_id for r in out if r.doc_id == 5} == {5}
    assert sorted((r.component_id is None, r.component_id or 0) for r in out if r.doc_id is None) == [(False, 1), (True, 0)]


def test_lines(spark):
    out = line_dedup.without_repeated_lines(edge.documents(spark))
    assert out.columns == edge.documents(spark).columns
    got = out.collect()
    kept = [r.doc_id for r in got]
    assert kept.count(1) == 1 and 6 not in kept and kept.count(None) == 2 and {2, 3, 4, 5, 7, 8} <= set(kept)
    assert all(r.kind == "k" and r.gone == "g" and r.row == "r" for r in got)


def test_paragraphs(spark):
    out = paragraph_dedup.repeats(edge.documents(spark)).collect()
    assert all(r.doc_id is not None for r in out)


def test_decontamination(spark):
    items = spark.createDataFrame([(10, edge.SENTENCE[4:60]), (11, None), (12, "x"), (13, edge.SENTENCE[4:60])], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminations(edge.documents(spark), items).collect()}
    assert found == {(d, i) for d in (1, 6, None) for i in (10, 13)}
    clean = decontamination.decontaminated(edge.documents(spark), items)
    assert clean.columns == edge.documents(spark).columns and clean.count() == 8
    assert decontamination.contaminations(edge.documents(spark), items.limit(0)).count() == 0


def test_licences(spark):
    docs = edge.rows((1, "text\nReleased under the MIT License.\nmore"), (2, None), (3, ""), (4, "LICENSED under: the apache license; Version 2.0"), (4, "x"), (None, "Licensed under CC BY-NC 4.0."))
    got = {(r.doc_id, r.license_id, round(r.dice, 3)) for r in license_scan.scan_documents(spark.createDataFrame(docs, edge.SCHEMA)).collect()}
    assert got == {(1, "MIT", 1.0), (4, "Apache-2.0", 1.0), (None, "CC-BY-NC-4.0", 1.0)}


def test_pages(spark):
    pages = [
        (1, "http://h.example/a", None, "x"), (2, None, "", "x"), (None, "http://h.example/b", "<p>a &amp; b<br>c\n d</p>", "x"),
        (3, "http://h.example/c", "<html><body class='has-sidebar'><nav>menu</nav><div class=ad>buy</div><article><header>T</header><p>one<b> two</p><form>f</form><p>three</article><section class='comments'><article>no</article></section><footer>f", "x"),
        (3, "http://h.example/c", "<style>p{}</style><script>var a='<p>no</p>'</script><div>plain<!-- c --> text</div>&am", "x"),
    ]
    got = html_extraction.main_text(spark.createDataFrame(pages, "page_id long, url string, html string, blocks string")).collect()
    texts = sorted(((r.page_id or 0), r.text, r.n_chars) for r in got)
    assert texts == [(0, "a & b\nc d", 9), (1, "", 0), (2, "", 0), (3, "one two\nthree", 13), (3, "plain text\n&am", 14)]


def test_site_style_tree_removes_what_every_page_says(spark):
    pages = [(i, f"http://site.example/{i}", f"<body><div class='q'>We use things you should accept</div><div class='z'>story {i} of many words</div></body>") for i in range(20)]
    got = html_extraction.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"story {i} of many words" for i in range(20)}


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = edge.documents(spark)
    out = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(out) == 12 and {r.score for r in out} == {0.0}


@pytest.mark.parametrize(
    "run",
    [
        exact_dedup.exact_duplicates, sharding.shard_documents, jaccard_join.similarity_groups, line_dedup.repeated_lines, line_dedup.without_repeated_lines, paragraph_dedup.repeats, license_scan.scan_documents,
        lambda d: packing.pack(d, tokenizer_path()), lambda d: toxicity.score(d, toxicity.fit(d, d.sparkSession.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))),
        lambda d: decontamination.contaminations(d, d.sparkSession.createDataFrame([(1, "some benchmark item text")], "item_id long, text string")),
        lambda d: html_extraction.main_text(d.selectExpr("doc_id as page_id", "source as url", "text as html")),
    ],
)
def test_empty_tables(spark, run):
    assert run(edge.empty(spark)).count() == 0
