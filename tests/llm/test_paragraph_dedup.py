import random

import numpy as np
import pyarrow as pa

from nightloom.llm.kernels import shingle_sets
from nightloom.llm.paragraph_dedup import _units, repeats

SCHEMA = "doc_id long, text string, n_chars string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def groups(rows, kind):
    out = {}
    for r in rows:
        if r.kind == kind:
            out.setdefault(r.group_id, set()).add(r.doc_id)
    return out


def test_passages_and_paragraphs(spark):
    rng = random.Random(5)
    passages = [prose(rng, 51) for _ in range(12)]
    docs, holders = [], {}
    for d in range(120):
        words = prose(rng, rng.randint(60, 160)).split()
        if d < 60:
            at = rng.randrange(len(words))
            words[at:at] = passages[d % 12].split()
            holders.setdefault(d % 12, set()).add(d)
        docs.append((d, " ".join(words), None))
    base = prose(rng, 60).split()
    for d in range(200, 206):  # near copies of one paragraph, every other word pair of the rest differs
        near = list(base)
        near[d - 195] = "changed%d" % d
        docs.append((d, prose(rng, 30) + "\n" + " ".join(near), None))
    docs += [(300, None, None), (301, "", None), (None, "x", None), (302, prose(rng, 20000), None)]
    rows = repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    found = groups(rows, "passage")
    for held in holders.values():
        assert any(held <= g for g in found.values())
    assert {r.doc_id for r in rows if r.kind == "passage"} <= set(range(60)) | set(range(200, 206))
    for held in holders.values():  # all but the first holder lose the passage
        assert {r.doc_id for r in rows if r.kind == "passage" and r.removed} >= held - {min(held)}
        assert not any(r.removed for r in rows if r.doc_id == min(held))
    assert set(range(200, 206)) in groups(rows, "paragraph").values()


def test_every_pair_that_bands_should_find(spark):
    """Brute force over a small fixture: paragraphs well above the threshold are grouped, those below are not."""
    rng = random.Random(9)
    docs = []
    for g in range(15):
        base = prose(rng, 80).split()
        for c in range(3):
            copy = list(base)
            for _ in range(g % 5):
                copy[rng.randrange(len(copy))] = prose(rng, 1)
            docs.append((len(docs), " ".join(copy), None))
    sets = list(shingle_sets(pa.array([t for _, t, _ in docs])))

    def jaccard(a, b):
        n = len(np.intersect1d(sets[a], sets[b]))
        return n / (len(sets[a]) + len(sets[b]) - n)

    found = groups(repeats(spark.createDataFrame(docs, SCHEMA)).collect(), "paragraph")
    of = {d: g for g, members in found.items() for d in members}
    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            if jaccard(a, b) >= 0.85:
                assert of.get(a) is not None and of.get(a) == of.get(b)
            if a // 3 != b // 3 and a in of and b in of:
                assert of[a] != of[b]


def test_empty_table(spark):
    assert repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_at_the_threshold(spark):
    """Pairs of paragraphs of Jaccard similarity 0.75 to 0.8 are found, those below 0.75 are not joined."""
    rng = random.Random(6)
    jaccard = lambda a, b: (lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y)))(*shingle_sets(pa.array([a, b])))
    docs, near, far = [], [], []
    while len(near) < 150 or len(far) < 50:
        base = prose(rng, rng.randint(40, 120)).split()
        copy = list(base)
        for i in rng.sample(range(len(copy)), max(1, round(len(copy) * rng.choice([0.02, 0.03, 0.04])))):
            copy[i] = prose(rng, 1)
        a, b = " ".join(base), " ".join(copy)
        kept = near if 0.75 <= (j := jaccard(a, b)) <= 0.8 else far if 0.6 <= j < 0.75 else None
        if kept is not None and len(kept) < (150 if kept is near else 50):
            kept.append((len(docs), len(docs) + 1))
            docs += [(len(docs), a, None), (len(docs) + 1, b, None)]
    found = groups(repeats(spark.createDataFrame(docs, SCHEMA)).collect(), "paragraph").values()
    assert np.mean([any(set(p) <= g for g in found) for p in near]) >= 0.95
    assert not any(set(p) <= g for p in far for g in found)


def test_pairs_that_no_band_has(spark):
    """Pairs of Jaccard similarity 0.75 or more whose signatures have no band in common are found as well."""
    rng = random.Random(13)
    docs = []
    for _ in range(2500):
        base = prose(rng, 40).split()
        copy = list(base)
        copy[rng.randrange(7, 33)] = prose(rng, 1)
        docs += [(len(docs), " ".join(base), None), (len(docs) + 1, " ".join(copy), None)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _, _ in docs], "text": [t for _, t, _ in docs]})
    bands = {d: b for units in _units(iter([batch])) for p, d, b in zip(units["passage"].to_pylist(), units["doc_id"].to_pylist(), units["bands"].to_pylist(), strict=True) if not p}
    sets = list(shingle_sets(batch["text"]))
    missed = [(a, a + 1) for a in range(0, len(docs), 2) if not any(x == y for x, y in zip(bands[a], bands[a + 1], strict=True)) and 4 * len(np.intersect1d(sets[a], sets[a + 1])) >= 3 * len(np.union1d(sets[a], sets[a + 1]))]
    assert len(missed) >= 20
    some = {d for pair in missed for d in pair} | set(range(100))
    found = groups(repeats(spark.createDataFrame([r for r in docs if r[0] in some], SCHEMA)).collect(), "paragraph").values()
    assert all(set(p) in found for p in missed)
