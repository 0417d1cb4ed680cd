import numpy as np
import pyarrow as pa
import pytest

from nightloom.llm import jaccard_join, kernels, paragraph_dedup

TEXTS = ["", None, " \n", "a b", "one two three four five", "a a a a a a a", "x", " ".join(f"w{i % 37}" for i in range(300)), *[" ".join(f"{t}-{i * i % 23}" for i in range(20 + t)) for t in range(40)]]


def sets(k):
    """Text by text."""
    out = []
    for text in TEXTS:
        hashed, _, _, _ = kernels.words(np.frombuffer((text or "").encode(), np.uint8), np.array([0, len((text or "").encode())]))
        n = len(hashed)
        one = set()
        for i in range(max(n - k + 1, 0)):
            run = np.zeros(1, np.uint64)
            for j in range(k):
                run = kernels.mix(run + hashed[i + j : i + j + 1] * kernels._ODD + np.uint64(j + 1))
            one.add(int(run[0]))
        if 0 < n < k:
            run = np.zeros(1, np.uint64)
            for j in range(n):
                run = kernels.mix(run + hashed[j : j + 1] * kernels._ODD + np.uint64(j + 1001))
            one.add(int(run[0]))
        out.append(sorted(one))
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_lists_are_the_sets_of_the_texts(k):
    got = [flat[a:b].tolist() for flat, begin in kernels.shingle_lists(pa.array(TEXTS), k) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    assert got == sets(k) == [s.tolist() for s in kernels.shingle_sets(pa.array(TEXTS), k)]


@pytest.mark.parametrize("cells", [2, 4, 8])
def test_sketches_of_many_sets_at_once(cells):
    flat, begin = next(kernels.shingle_lists(pa.array(TEXTS)))
    assert jaccard_join.parity_sketches(flat, begin, cells).to_pylist() == [jaccard_join.parity_sketch(np.array(s, np.uint64), cells) for s in sets(5)]


def test_no_call_for_each_text(monkeypatch):
    """Sets, sketches and prefixes of a batch are made together."""

    def refuse(*_):
        raise AssertionError

    monkeypatch.setattr(jaccard_join, "parity_sketch", refuse)
    monkeypatch.setattr(jaccard_join, "shingle_sets", refuse)
    monkeypatch.setattr(np, "unique", lambda x, _unique=np.unique, **more: refuse() if x.dtype == np.uint64 else _unique(x, **more))
    counts = type("Counts", (), {"value": np.full(jaccard_join.COUNTERS, 3, np.uint32)})
    for s in sets(5)[::2]:
        counts.value[[x % jaccard_join.COUNTERS for x in s]] = 1000  # frequent ones, whose sketches travel
    batch = pa.RecordBatch.from_pydict({"text": pa.array(TEXTS), "doc_id": pa.array(range(len(TEXTS))), "root": pa.array([0] * len(TEXTS))})
    out = pa.Table.from_batches(jaccard_join._prefixes(5, 75, counts)([batch])).to_pylist()
    monkeypatch.undo()
    assert any(r["sketch"] for r in out)
    for i, s in enumerate(sets(5)):
        mine = [r for r in out if r["doc_id"] == i]
        n = len(s)
        need = min(n, n - (n * 75 + 99) // 100 + (jaccard_join.SHARED if n >= jaccard_join.NEARLY_LARGE else 1))
        often = [min(int(counts.value[x % jaccard_join.COUNTERS]), (1 << 20) - 1) for x in s]
        first = sorted(range(n), key=lambda x: (often[x] << 44 | s[x] >> 20, x))[:need]
        assert [r["token"] % 2**64 for r in mine] == [s[x] for x in first]
        assert [r["shape"] for r in mine] == [(n << 32) + x for x in range(need)]
        limit = 4 * int(counts.value.mean()) + 16
        assert [r["sketch"] for r in mine] == [jaccard_join.parity_sketch(np.array(s, np.uint64), 4) if often[x] >= limit else None for x in first]


def test_units_have_no_call_for_each_paragraph(monkeypatch):
    units = lambda: pa.Table.from_batches(paragraph_dedup._units([pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(TEXTS))), "text": pa.array(TEXTS)})])).to_pylist()
    monkeypatch.setattr(np, "unique", lambda x, _unique=np.unique, **more: _unique(x, **more) if x.dtype != np.uint64 else pytest.fail("unique"))
    lines = {r["doc_id"]: r for r in units() if not r["passage"] and r["bands"]}
    want = {i: s for i, (t, s) in enumerate(zip(TEXTS, sets(5), strict=True)) if len((t or "").split()) >= paragraph_dedup.SHORTEST}
    assert {i: (r["n"], r["sketch"]) for i, r in lines.items()} == {i: (len(s), jaccard_join.parity_sketch(np.array(s, np.uint64), 8)) for i, s in want.items()}
