"""Against brute force over all pairs, with groups large enough for every path of the join."""

import random

import numpy as np
import pyarrow as pa

from nightloom.llm.jaccard_join import Sketches, parity_sketch, similarity_groups, sketch_distance
from nightloom.llm.kernels import shingle_sets


def prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def brute(docs):
    sets = [set(s.tolist()) for s in shingle_sets(pa.array([t for _, t in docs]))]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {docs[i][0]: docs[find(i)][0] for i in range(len(docs))}


def check(spark, docs):
    docs = sorted(docs)
    got = {r.doc_id: r.component_id for r in similarity_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == brute(docs)


def test_one_large_group_of_near_copies(spark):
    """Copies with few to many edits: some linked with the middle, some only with each other, some with none."""
    rng = random.Random(3)
    base = prose(rng, 70)
    docs = []
    for d in range(420):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 3, 4, 4, 5])):
            words[rng.randrange(len(words))] = prose(rng, 1)[0]
        docs.append((d, " ".join(words)))
    check(spark, docs)


def test_thresholds_small_sets_and_shared_passages(spark):
    rng = random.Random(4)
    passage, docs = prose(rng, 25), []
    for _ in range(60):
        docs.append((len(docs), " ".join(prose(rng, 40) + passage + prose(rng, 30))))
    for n in range(1, 24):  # sets of every small size, with one word changed at each place
        base = prose(rng, n)
        docs.append((len(docs), " ".join(base)))
        for i in range(n):
            docs.append((len(docs), " ".join(base[:i] + ["zz"] + base[i + 1 :])))
            docs.append((len(docs), " ".join(base[:i] + base[i + 1 :])))
        docs.append((len(docs), " ".join(base).upper() + " \n"))
    check(spark, docs)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(40)]
    bits = [parity_sketch(s) for s in sets]
    many = Sketches(bits)
    for a in range(40):
        for b, far in zip(range(40), many.distance(a, np.arange(40)), strict=True):
            assert far == sketch_distance(bits[a], bits[b]) <= len(np.setxor1d(sets[a], sets[b]))


def test_sets_do_not_depend_on_the_slices(monkeypatch):
    texts = pa.array(["one", "", "one two three four five six seven", None, "a b", "one two three four five six seven eight", " "])
    whole = [s.tolist() for s in shingle_sets(texts)]
    for size in (1, 10, 40):
        monkeypatch.setattr("nightloom.llm.kernels.SLICE_BYTES", size)
        assert [s.tolist() for s in shingle_sets(texts)] == whole
