"""Cells of many lines that share a phrase and no more: what is compared in them, and that no similar pair is lost."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest

from nightloom.llm import line_dedup
from nightloom.llm.kernels import edit_distance


def crowd(rng, n):
    """Lines of documents, all with one phrase before them, and copies with some words changed."""
    texts = pa.parquet.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    found = sorted({line_dedup.normalised(x) for t in texts if t for x in t.split("\n") if len(x.split()) > 20})
    lines = ["one two three four " + x for x in rng.sample(found, n)]
    for x in rng.sample(lines, n // 10):
        w = x.split(" ")
        for _ in range(max(1, len(w) // rng.choice([8, 12, 30]))):
            w[rng.randrange(4, len(w))] = "other"
        lines.append(" ".join(w))
    return list(dict.fromkeys(lines))


def batch(texts):
    ends = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    lines = line_dedup.Lines(np.frombuffer("".join(texts).encode(), np.uint8), ends)
    chars, letters = lines.sizes()
    hashed, cell = line_dedup.simhashes(lines.words, lines.begin, lines.end)[0], pa.array(np.full(len(texts), 77))
    names = ["unit", "cell", "id", "simhash", "chars", "letters", "text", "cells"]
    return pa.RecordBatch.from_arrays([cell, cell, pa.array(np.arange(len(texts))), pa.array(hashed.view(np.int64)), pa.array(chars), letters, pa.array(texts), pa.array([[77]] * len(texts))], names), hashed


def parts(n, links):
    root = np.arange(n)
    for a, b in links:
        root[root == root[b]] = root[a]
    return {frozenset(np.flatnonzero(root == r).tolist()) for r in np.unique(root)}


@pytest.mark.parametrize("n", [480, 700])
def test_links_of_a_crowd_against_all_pairs(n, monkeypatch):
    texts = crowd(random.Random(n), n)
    assert len(texts) >= line_dedup.CROWD
    rows, hashed = batch(texts)
    compared = []
    monkeypatch.setattr(line_dedup, "edits_within", lambda a, b, most, f=line_dedup.edits_within: compared.extend(a) or f(a, b, most))
    out = next(line_dedup._linked(0.85)(iter([rows])))
    near = [(i, j) for i in range(len(texts)) for j in range(i) if int(hashed[i] ^ hashed[j]).bit_count() <= line_dedup.DIFFERENT and abs(len(texts[i]) - len(texts[j])) <= 0.15 * max(len(texts[i]), len(texts[j]))]
    most = lambda i, j: int(max(len(texts[i]), len(texts[j])) * 0.15 + 1e-9)
    similar = [(i, j) for i, j in near if edit_distance(texts[i], texts[j], most(i, j)) <= most(i, j)]
    assert parts(len(texts), similar) == parts(len(texts), zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True))
    assert len(similar) >= n // 20
    assert len(compared) < 0.25 * (len(near) - len(similar))  # of pairs that are not similar few are laid side by side


def test_runs_refuse_no_similar_pair():
    rng = random.Random(5)
    for _ in range(300):
        x = list("".join(rng.choice("ab ") for _ in range(rng.randint(1, 300))))
        y, edits = list(x), rng.randint(0, 30)
        for _ in range(edits):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "ü", "😀"])
        for chars, bits in line_dedup.RUNS.items():
            a, b = line_dedup.run_bits(["".join(x), "".join(y)], chars, bits)
            assert max(np.bitwise_count(a & ~b).sum(), np.bitwise_count(b & ~a).sum()) <= chars * edits
