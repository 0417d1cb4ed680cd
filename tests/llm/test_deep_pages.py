"""Pages that nest deeply or name their elements at length."""

from nightloom.llm import html_extraction


def texts(spark, htmls):
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_extraction.main_text(pages).collect()}


def test_article_in_many_containers(spark):
    made = [f"<body>{'<div>' * n}<article><p>story {n}</article>{'</div>' * n}<p>beside" for n in (3, 22, 23, 24, 60, 3000)]
    made += ["<body>" + "<section class='wrap wide'>" * 200 + "<main><p>told</main>"]
    assert texts(spark, made) == {**dict(enumerate(f"story {n}" for n in (3, 22, 23, 24, 60, 3000))), 6: "told"}


def test_deep_nodes_stay_apart(spark):
    deep = "<div>" * 40
    made = [f"<body>{deep}<div class='q'>We use things you should accept</div><div class='z'>story {i} of many words</div>" for i in range(20)]
    assert set(texts(spark, made).values()) == {f"story {i} of many words" for i in range(20)}


def test_long_classes_stay_apart(spark):
    same = "wrapper " * 12
    made = [f"<body><div class='{same}q'>We use things you should accept</div><div class='{same}z'>story {i} of many words</div>" for i in range(20)]
    assert set(texts(spark, made).values()) == {f"story {i} of many words" for i in range(20)}
    paths = [p for p, _, _ in html_extraction.blocks("<body>" + "<div>" * 5000 + "a<div>b")[0]]
    assert len(set(paths)) == 2 and max(map(len, paths)) < 500
