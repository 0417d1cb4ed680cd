"""Lines and paragraphs that are too short to be compared with others are still grouped where they are equal."""

import random

import pyarrow as pa

from nightloom.llm import line_dedup, paragraph_dedup
from nightloom.llm.kernels import shingle_sets

TEXTS = [(1, "All rights reserved.\n\nalpha one\n---"), (2, "other\nALL rights reserved\n\n---"), (3, "all Rights reserved\nbeta two three four five six seven eight nine"), (4, "x\nBeta two three four five six seven eight nine\nlast")]


def test_short_lines(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = {(r.doc_id, r.line, r.keep_doc_id, r.keep_line, r.kept) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {(1, 0, 1, 0, True), (2, 1, 1, 0, False), (3, 0, 1, 0, False), (3, 1, 3, 1, True), (4, 1, 3, 1, False)}
    left = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs).collect()}
    assert left == {1: TEXTS[0][1], 2: "other\n\n---", 3: "beta two three four five six seven eight nine", 4: "x\nlast"}


def test_short_paragraphs(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got = {(r.doc_id, r.kind, r.place, r.keep_doc_id, r.removed) for r in paragraph_dedup.repeats(docs).collect()}
    same = {(1, "paragraph", 3, 1, False), (2, "paragraph", 3, 1, True), (3, "paragraph", 1, 3, False), (4, "paragraph", 1, 3, True)}
    assert got == same | {(2, "paragraph", 1, 2, False), (3, "paragraph", 0, 2, True)}


def test_short_paragraphs_that_differ(spark):
    """Groups of lines of 4 to 19 words are the components of all pairs of Jaccard similarity 0.75 or more."""
    rng = random.Random(4)
    lines = []
    for g in range(150):
        base = [f"w{g}x{i}" for i in range(rng.randint(4, 18))]
        lines += [base, [*base, "more"], [f"first{g}", *base][:19], [*base[:-1], "other"], base[1:]]
    lines = sorted({" ".join(x) for x in lines})
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(lines))]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    want = {}
    for i in range(len(lines)):
        want.setdefault(find(i), set()).add(i)
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    assert len(want) > 80 and min(len(lines[i].split()) for g in want for i in g) < 9
    got = {}
    for r in paragraph_dedup.repeats(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect():
        got.setdefault(r.group_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == want
