"""The style tree against a plain version of it, and names that are only a prior."""

import math
import random
from collections import Counter, defaultdict

import pytest

from nightloom.llm import html_extraction

STORY = "a long story of many words that goes on for quite a while, as stories do, until it ends at last"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><nav>menu</nav><div class='content header-less'><p>{STORY}</p><p>and more</p></div><footer>foot</footer>", f"{STORY}\nand more"),
        (f"<body><div class='post more-space'><p>{STORY}</div><div class='side'>short</div>", STORY),
        (f"<main><section class='notice-board'><p>{STORY}</section><section class='share'>share it</section></main>", STORY),
        (f"<article><header class='x'><h1>The title</h1><p>by someone</p></header><p>{STORY}</p></article><header><h1>The site</h1></header>", f"The title\n{STORY}"),
        (f"<body><p><a title='x>link</a> {STORY}</p>", f"link {STORY}"),
        (f"<div class='content more'><p>{STORY}</p><div class='related'>{STORY} {STORY}</div><div class='social'>tell all</div></div>", STORY),
        (f"<div class='ad'>{STORY} {STORY}</div><p>few words", "few words"),
        (f"<div class='comments'>{STORY} {STORY}</div><p>few words", "few words"),
        (f"<div class='comment-thread-x'>{STORY} {STORY}</div><p>few words", "few words"),
        (f"<div class='ad-slot ads_2'>{STORY} {STORY}</div><p>few words", "few words"),
        (f"<body><nav>menu</nav><div class='post ad-free'><p>{STORY}</p></div>", STORY),
        (f"<body><div class='article-body promo-2020'><p>{STORY}</p></div><div class='promo-big'>buy</div>", STORY),
        (f"<body><div id='cookie-recipes'><p>{STORY}</p></div><div id='cookie-notice'>We use them</div>", STORY),
        (f"<body><div class='related-work'><p>{STORY}</p></div><div class='related-articles'>{STORY} {STORY}</div>", STORY),
        (f"<body><form id='aspnetForm'><div class='content'><p>{STORY}</p></div><nav>menu</nav></form>", STORY),
        (f"<body><p>{STORY}</p><form class='login'><label>Your name</label></form>", STORY),
    ],
)
def test_names_are_a_prior(page, text):
    assert "\n".join(t for _, k, t in html_extraction.blocks(page)[0] if k) == text


def entropy(counts):
    m = sum(counts.values())
    return 1.0 if m <= 1 else -sum(n / m * math.log(n / m) for n in counts.values()) / math.log(m)


def test_tree_against_brute_force(spark):
    rng = random.Random(12)
    pages = []
    for i in range(120):
        part = lambda: rng.choice(["<div class='q'>We use things</div>", f"<div class='z'>{rng.randrange(40)}<p>two</div>", "<section id=s><p>x<p>y</section>", f"<p>{rng.randrange(9)}"])
        pages.append((i, f"http://h{i % 3}.example/{i}", "<body>" + "".join(part() for _ in range(rng.randrange(5)))))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.host, r.path): (r.occurrences, r.content, r.presentation, r.importance) for r in html_extraction.style_tree(html_extraction.parsed(df)).collect()}
    content, shown = defaultdict(Counter), defaultdict(Counter)
    for i, _, page in pages:
        found, nodes = html_extraction.blocks(page)
        for p, k, t in found:
            assert 0 < k < 1
            content[f"h{i % 3}.example", p][t] += 1
        for p, c in nodes:
            shown[f"h{i % 3}.example", p][c] += 1
    assert set(got) == set(content)
    for key, (n, c, p, importance) in got.items():
        assert n == sum(content[key].values())
        assert c == pytest.approx(entropy(content[key]), abs=1e-9) and p == pytest.approx(entropy(shown[key]), abs=1e-9)
        assert importance is None if n < html_extraction.PAGES else importance == pytest.approx(0.8 * c + 0.2 * p, abs=1e-9)


def test_entropy_overrules_a_name(spark):
    """A branch that its name calls furniture stays where it tells each page's story, one that no name calls so goes where it is the same."""
    pages = [(i, f"http://site.example/{i}", f"<body><div class='post more-space'>story {i} {STORY}</div><div class='abc'>We use things</div>") for i in range(20)]
    pages += [(100 + i, f"http://same.example/{i}", f"<body><div class='more'>{STORY}</div><div class='abc'>story {i}</div>") for i in range(20)]
    got = {r.page_id: r.text for r in html_extraction.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"story {i} {STORY}" for i in range(20)}, **{100 + i: f"story {i}" for i in range(20)}}


def test_pages_of_a_host_are_dealt_out(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://site.example/{i}", f"<body><div class='q'>We use things</div><p>story {i}") for i in range(20)], "page_id long, url string, html string")
    monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", -1)
    assert {r.text for r in html_extraction.main_text(pages).collect()} == {f"story {i}" for i in range(20)}
