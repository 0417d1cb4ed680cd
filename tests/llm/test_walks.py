import numpy as np
import pytest

from nightloom.llm import decontamination


class Counted:
    def __init__(self, table):
        self.table, self.n = table, 0

    def __getitem__(self, k):
        self.n += 1
        return self.table[k]


@pytest.mark.parametrize("size", [16, 64])
@pytest.mark.parametrize("back", [False, True])
def test_all_walks_step_side_by_side(monkeypatch, size, back):
    rng = np.random.default_rng(3)
    a = rng.integers(97, 100, 2000).astype(np.uint8)
    b = a.copy()
    edits = rng.integers(0, 2000, 250)
    b[edits] = rng.integers(97, 100, 250)
    x = rng.integers(200, 1800, 150)
    y = x + rng.integers(0, 2, 150)
    steps = Counted(decontamination._STEP)
    monkeypatch.setattr(decontamination, "_STEP", steps)
    got = decontamination.alike(a, x, b, y, size, 8, back)
    assert steps.n <= 2 * size  # each step once, not once for each walk
    by_step = steps.table.reshape(-1, decontamination.WALKS, 256)

    def met(i, j):
        for walk in range(decontamination.WALKS):
            p, q, equal = i, j, []
            for s in range(2 * size):
                equal.append(a[p] == b[q])
                p, q = (p - by_step[s, walk, a[p]], q - by_step[s, walk, b[q]]) if back else (p + by_step[s, walk, a[p]], q + by_step[s, walk, b[q]])
            if any(all(equal[s] for s in places) for places in decontamination._READ[size, 8][walk :: decontamination.WALKS]):
                return True
        return False

    want = [met(i, j) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    assert 0 < sum(want) < len(want) and got.tolist() == want
