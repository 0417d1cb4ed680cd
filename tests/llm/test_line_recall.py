"""How many pairs of lines within the edit similarity are compared at all, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from nightloom.llm import line_dedup
from nightloom.llm.kernels import edit_similar

from .test_stages import prose


def pairs(rng, words, kind, share):
    """A line of so many words and a copy with a share of its words replaced, or of its characters edited."""
    while True:
        base = prose(rng, words)
        if kind == "words":
            copy = base.split()
            for i in rng.sample(range(words), max(1, round(share * words))):
                copy[i] = prose(rng, 1)
            copy = " ".join(copy)
        else:
            copy = list(base)
            for i in rng.sample(range(len(copy)), max(1, round(share * len(copy)))):
                copy[i] = rng.choice(["", "k", copy[i] + "k"])
            copy = "".join(copy)
        if copy != base and len(copy.split()) >= line_dedup.SHORTEST and edit_similar(base, copy, line_dedup.LEAST):
            return base, copy


def compared(made):
    texts = [t for pair in made for t in pair]
    wanted = pa.RecordBatch.from_pydict({"wanted": [[{"line": 0, "id": i}] for i in range(len(texts))], "text": texts})
    table = pa.Table.from_batches(line_dedup._features([wanted]))
    hashed = pa.Table.from_batches(line_dedup._hashed([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})]))
    assert hashed["doc_id"].to_pylist() == table["id"].to_pylist()
    hashed = hashed.set_column(hashed.schema.get_field_index("id"), "id", table["id"])
    near = {i: set() for i in range(len(texts))}
    for batch in line_dedup._keyed(hashed.combine_chunks().to_batches()):
        for cell, i in zip(batch["cell"].to_pylist(), batch["id"].to_pylist(), strict=True):
            near[i].add(cell)
    letters, chars = table["letters"].to_pylist(), table["chars"].to_pylist()
    found = []
    for i in range(0, len(texts), 2):
        assert chars[i : i + 2] == [len(line_dedup.normalised(t)) for t in texts[i : i + 2]]
        ok = False
        for cell in near[i] & near[i + 1]:
            pair = table.slice(i, 2).append_column("cell", pa.array([cell, cell]))
            rows = line_dedup.Rows(pair.to_batches(), "letters")
            ok |= len(rows.similar(np.array([0]), np.array([1]), line_dedup.LEAST)) > 0
        found.append(ok)
        counts = [np.frombuffer(x, np.uint8) for x in letters[i : i + 2]]
        assert line_dedup._letters(*counts, np.int64(chars[i]), np.int64(chars[i + 1]), line_dedup.LEAST)  # refuses no pair that is similar
    return float(np.mean(found))


@pytest.mark.parametrize(
    ("words", "kind", "share", "least"),
    [(6, "words", 0.15, 0.98), (10, "words", 0.1, 0.98), (20, "words", 0.05, 0.98), (20, "words", 0.1, 0.97), (30, "words", 0.1, 0.94), (50, "words", 0.06, 0.96), (100, "words", 0.05, 0.96), (100, "words", 0.1, 0.8), (20, "characters", 0.05, 0.4), (50, "characters", 0.02, 0.8)],
)
def test_recall_of_changed_lines(words, kind, share, least):
    rng = random.Random(7)
    assert compared([pairs(rng, words, kind, share) for _ in range(300)]) >= least


def test_every_word_of_a_long_line_counts():
    rng = random.Random(8)
    h = np.array([rng.getrandbits(64) for _ in range(200_000)], np.uint64)
    got, n = line_dedup.simhashes(np.concatenate([h, h[:7]]), np.array([0, len(h)]), np.array([len(h), len(h) + 7]))
    for s, part in zip(got.tolist(), (h, h[:7]), strict=True):
        ones = [int((part >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
        assert s == sum((2 * k > len(part)) << b for b, k in enumerate(ones))
    assert n.tolist() == [200_000, 7]


def test_frequent_phrases_are_cut_up(spark):
    """Lines that share a frequent phrase only do not meet; their near copies still do."""
    rng = random.Random(9)
    lines = ["considering everything rather carefully " + prose(rng, 12) for _ in range(400)]
    copies = [line.rsplit(" ", 1)[0] + " changed" for line in lines[:40]]
    docs = spark.createDataFrame(list(enumerate(lines + copies)), "doc_id long, text string")
    got = {r.doc_id: r.keep_doc_id for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {i: i % 400 for i in [*range(40), *range(400, 440)]}
    work = line_dedup.Workspace(spark, "test")
    classes = work.keep(docs.mapInArrow(line_dedup._hashed, line_dedup.LINE), "classes")
    largest = [c.groupBy("cell").count().agg({"count": "max"}).first()[0] for c in (line_dedup.keyed(classes), line_dedup.cut_up(line_dedup.keyed(classes), classes, work, 4, 16))]
    assert largest[0] >= 400 and largest[1] <= 8


def groups_of(spark, docs, most=line_dedup.MOST):
    out = line_dedup.line_groups(docs, line_dedup.Workspace(spark, "test"), most=most)
    return {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line) for r in out.collect()}


def test_near_copies_beside_a_frequent_phrase(spark):
    """Four changed characters leave only the first words of a line as they are, which many other lines have as well."""
    rng = random.Random(10)
    phrase = "considering everything rather carefully "
    lines = [phrase + prose(rng, 36) for _ in range(1500)]
    copies = []
    for line in lines[:30]:
        text = list(line)
        for i in (line.index(w, len(line) * k // 5) for k, w in enumerate(" " * 4, 1)):
            text[i + 1] = "k" if text[i + 1] != "k" else "z"
        copies.append("".join(text))
    docs = spark.createDataFrame(list(enumerate(lines + copies)), "doc_id long, text string")
    got = groups_of(spark, docs)
    assert got == {(i, 0): (i % 1500, 0) for i in [*range(30), *range(1500, 1530)]}
    assert groups_of(spark, docs, 100) == got  # cells dealt out


@pytest.mark.parametrize("most", [line_dedup.MOST, 20])
def test_all_pairs_of_a_cell(spark, most):
    """Groups against every pair of every cell: families of lines that drift apart, of which no leader finds all."""
    rng = random.Random(11)
    lines = []
    for _ in range(6):
        line = ("considering everything rather carefully " + prose(rng, 16)).split()
        for _ in range(40):
            other = list(rng.choice(lines[-20:]).split()) if lines and rng.random() < 0.5 else list(line)
            for i in rng.sample(range(4, len(other)), 2):
                other[i] = prose(rng, 1)
            lines.append(" ".join(other))
    lines = sorted(set(lines))
    hashed = pa.Table.from_batches(line_dedup._hashed([pa.RecordBatch.from_pydict({"doc_id": list(range(len(lines))), "text": lines})])).combine_chunks()
    where = dict(zip(hashed["id"].to_pylist(), hashed["doc_id"].to_pylist(), strict=True))
    simhash = dict(zip(hashed["doc_id"].to_pylist(), hashed["simhash"].to_numpy().view(np.uint64).tolist(), strict=True))
    cells = {}
    for batch in line_dedup._keyed(hashed.to_batches()):
        for cell, i in zip(batch["cell"].to_pylist(), batch["id"].to_pylist(), strict=True):
            cells.setdefault(cell, set()).add(where[i])
    root = list(range(len(lines)))
    met = {(a, b, cell & 1) for cell, some in cells.items() for a in some for b in some if a < b}
    for a, b, segment in met:
        if (simhash[a] ^ simhash[b]).bit_count() <= (line_dedup.DIFFERENT if segment else line_dedup.CLOSE) and edit_similar(lines[a], lines[b], line_dedup.LEAST):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = [new if r == old else r for r in root]
    want = {(i, 0): (r, 0) for i, r in enumerate(root) if root.count(r) > 1}
    assert len(set(want.values())) > 3
    assert groups_of(spark, spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), most) == want


def test_words_side_by_side_never_find_too_much():
    """within() may miss, but what it takes is within the edit distance."""
    rng = random.Random(12)
    taken = 0
    for _ in range(2000):
        x = [rng.choice(["a", "bb", "abc", "dddd"]) for _ in range(rng.randrange(1, 12))]
        y = list(x)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(y) + 1)
            y[k : k + rng.randrange(3)] = [rng.choice(["a", "bb", "eee"]) for _ in range(rng.randrange(3))]
        y = y or ["a"]
        one, two, least = " ".join(x), " ".join(y), rng.choice([0.5, 0.7, 0.85])
        ok = edit_similar(one, two, least) > 0
        found = line_dedup.near_copies(one, two, least)
        assert ok or not found
        taken += found
    assert taken > 500
