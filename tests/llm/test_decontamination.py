"""Recall of the search for benchmark items against brute force, over the whole range of similarities that it promises."""

import random

import numpy as np
import pyarrow as pa
import pytest

from nightloom.llm import decontamination
from nightloom.llm.kernels import edit_search

from .test_stages import prose


def edited(rng, text, rate):
    s = list(text)
    for _ in range(int(rate * len(s))):
        p = rng.randrange(len(s))
        s[p] = rng.choice(["", "q", s[p] + "z"])
    return "".join(s)


def every_second_word(rng, text, rate):
    words = text.split()
    for i in range(0, len(words), 2):
        p = rng.randrange(len(words[i]))
        words[i] = words[i][:p] + "q" + words[i][p + 1 :]
    return " ".join(words)


def searched(texts, docs):
    items = decontamination.Items(list(enumerate(texts)))
    return [{m[0]: m[1] for m in found} for found in items.search(pa.array(docs), decontamination.LEAST)]


@pytest.mark.parametrize(
    ("change", "rate", "words", "least"),
    [(edited, 0.0, 40, 1.0), (edited, 0.1, 40, 1.0), (edited, 0.18, 40, 0.97), (edited, 0.22, 40, 0.95), (edited, 0.25, 40, 0.9), (edited, 0.2, 20, 0.9), (edited, 0.1, 8, 0.9), (every_second_word, 0, 40, 0.98)],
)
def test_recall(change, rate, words, least):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(words * 3 // 4, words * 5 // 4)) for _ in range(60)]
    docs, want = [], []
    while len(docs) < 150:
        i = rng.randrange(len(texts))
        copy = " ".join(change(rng, texts[i], rate).split())
        if 1 - edit_search(texts[i], copy)[0] / len(texts[i]) >= decontamination.LEAST:
            docs.append(prose(rng, 40) + " " + copy + " " + prose(rng, 40))
            want.append(i)
    found = searched(texts, docs + [prose(rng, 100) for _ in range(100)])
    assert np.mean([w in f for w, f in zip(want, found[:150], strict=True)]) >= least
    assert not any(found[150:])
    for f, d in zip(found, docs, strict=False):  # what is reported is within the threshold, by its best place
        for i, similarity in f.items():
            assert similarity >= decontamination.LEAST and abs(similarity - (1 - edit_search(texts[i], d)[0] / len(texts[i]))) < 1e-9


def test_tiny_and_repeated_items():
    long = "the capital of france is a city called paris, as most people know well"
    texts = ["Paris", "42", long, long.upper(), "", " ", "paris", "an answer of few words"]
    found = searched(texts, ["in PARIS  there are 42 ways", "comparison 142", long, "Answer: an answr of few words.", None, ""])
    assert [set(f) for f in found] == [{0, 1, 6}, set(), {2, 3}, {7}, set(), set()]


def test_many_common_grams(monkeypatch):
    rng = random.Random(6)
    texts = [prose(rng, 40) for _ in range(30)]
    docs = [prose(rng, 30) + " " + rng.choice(texts) for _ in range(40)]
    want = searched(texts, docs)
    monkeypatch.setattr(decontamination, "HELD", 50)
    assert searched(texts, docs) == want and all(want)


def test_tables_are_bounded():
    rng = random.Random(4)
    texts = [prose(rng, 40) for _ in range(300)]
    items = decontamination.Items(list(enumerate(texts)))
    size = sum(x.nbytes for g in items.kinds.values() for x in (g.code, g.begin, g.item, g.place, g.first))
    assert size < 100 * sum(map(len, texts)) + (1 << 18)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    rng = random.Random(5)
    texts = [prose(rng, 12) for _ in range(9)]
    docs = spark.createDataFrame([(i, "x " + t) for i, t in enumerate(texts)] + [(99, "clean text of a few words")], "doc_id long, text string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "item_id long, text string")
    blocks = decontamination.item_blocks
    monkeypatch.setattr(decontamination, "item_blocks", lambda b: blocks(b, 200))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminations(docs, items).collect()}
    assert got == {(i, j) for i in range(9) for j in (i, i + 9)}
    assert [r.doc_id for r in decontamination.decontaminated(docs, items).collect()] == [99]
