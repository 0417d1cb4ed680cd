"""Lines that share a long passage only meet in many large cells, and are compared once."""

import random

import numpy as np
import pyarrow as pa
import pytest

from nightloom.llm import kernels, line_dedup

CELLS = [11, 23, 37, 41]


def test_each_pair_is_compared_in_one_cell(monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 7)))
    passage = " ".join(word() for _ in range(90))
    texts = [" ".join(word() for _ in range(30)) + " " + passage for _ in range(80)]
    for i in range(40):  # runs of letters moved so that no word stays: similar, but no copy by its words
        x = list(texts[i])
        x[0:120:8] = rng.choices("uvwx", k=15)
        texts.append("".join(x))
    wanted = pa.array([[{"line": 0, "id": i + 1, "cells": CELLS}] for i in range(len(texts))], pa.list_(pa.struct([("line", pa.int32()), ("id", pa.int64()), ("cells", pa.list_(pa.int64()))])))
    rows = next(line_dedup._features(iter([pa.RecordBatch.from_arrays([wanted, pa.array(texts)], ["wanted", "text"])])))
    batches = []
    for c in CELLS:
        cell = pa.array([c] * len(rows), pa.int64())
        batches.append(pa.RecordBatch.from_arrays([cell, cell, *rows.columns], ["unit", "cell", *rows.schema.names]))
    compared = []

    def counted(one, two, most):
        compared.extend(frozenset(p) for p in zip(one, two, strict=True))
        return kernels.edits_within(one, two, most)

    monkeypatch.setattr(line_dedup, "edits_within", counted)
    links = [(texts[a - 1], texts[b - 1]) for batch in line_dedup._linked(0.85)(iter(batches)) for a, b in zip(*batch.to_pydict().values(), strict=True)]
    assert len(compared) == len(set(compared)) > 100  # not in each of the cells
    assert all(kernels.edit_similar(a, b, 0.85) for a, b in links)
    table = line_dedup.Rows(batches[:1], "letters")
    x, y = zip(*[(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts))], strict=True)
    near = table.similar(np.array(x), np.array(y), 0.85)
    place = [texts[i - 1] for i in table.id.tolist()]
    up = {t: t for t in texts}

    def find(t):
        while up[t] != t:
            t = up[t]
        return t

    for a, b in links:
        up[find(a)] = find(b)
    want = [(place[x[i]], place[y[i]]) for i in near.tolist() if kernels.edit_similar(place[x[i]], place[y[i]], 0.85)]
    assert want and all(find(a) == find(b) for a, b in want)


@pytest.mark.parametrize("alphabet", ["abcd é", "abcdefgh漢字🙂"])
def test_distances_side_by_side(alphabet):
    rng = random.Random(5)
    one, two, most = [], [], []
    for _ in range(1500):
        a = [rng.choice(alphabet) for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 129, 200]))]
        b = [x if rng.random() < 0.8 else rng.choice(alphabet) * rng.randrange(3) for x in a]
        one.append("".join(a))
        two.append("".join(b))
        most.append(max(0, kernels.edit_distance(one[-1], two[-1], 1 << 30) + rng.choice([-20, -1, 0, 1])))
    want = [kernels.edit_distance(*x) <= x[2] for x in zip(one, two, most, strict=True)]
    assert kernels.edits_within(one, two, most).tolist() == want and 200 < sum(want) < 1400
