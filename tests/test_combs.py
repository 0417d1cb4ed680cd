"""Planted combs with missing and false peaks."""

import random

import pytest

from nightloom.operators import combs


def planted(rng, count, sign, missing=0.10, false=0.05):
    """[(position, rough number, true mode or None)]: spacing that grows along the order, jitter, and a rough solution that is off."""
    first, peaks = rng.randrange(2000, 9000), []
    x, spacing = 30.0, 9.0
    for k in range(count):
        mode = first + sign * k
        if rng.random() >= missing:
            peaks.append((x + rng.gauss(0, 0.05), mode + rng.uniform(-0.3, 0.3) + 0.1, mode))
        if rng.random() < false:
            share = rng.uniform(0.25, 0.75)
            peaks.append((x + share * spacing, mode + sign * share, None))
        x += spacing
        spacing *= 1.0015
    return peaks


@pytest.mark.parametrize("seed", range(3))
def test_every_number_is_right(spark, seed):
    rng = random.Random(seed)
    orders = {o: planted(rng, rng.choice([60, 150, 400]), rng.choice([1, -1])) for o in range(12)}
    rows = [(o, x, r) for o, peaks in orders.items() for x, r, _ in peaks]
    rng.shuffle(rows)
    out = combs.mode_numbers(spark.createDataFrame(rows, "o int, x double, rough double"), ["o"], "x", "rough").collect()
    true = {(o, x): m for o, peaks in orders.items() for x, _, m in peaks}
    got = {(r.o, r.x): r.mode for r in out}
    assert len(got) == len(out)
    assert all(true[p] == m for p, m in got.items()), [(p, m, true[p]) for p, m in got.items() if true[p] != m][:5]
    wanted = sum(m is not None for m in true.values())
    assert len(got) >= 0.995 * wanted


def test_small_orders(spark):
    rows = [(0, 5.0, 10.2), (1, 5.0, 10.0), (1, 9.0, 11.0), (2, None, 4.0), (2, 1.0, None), (3, 1.0, 7.0), (3, 1.0, 7.0), (3, 2.0, 8.0), (3, 3.0, 9.0)]
    out = combs.mode_numbers(spark.createDataFrame(rows, "o int, x double, rough double"), ["o"], "x", "rough").collect()
    assert sorted((r.o, r.x, r.mode) for r in out) == [(1, 5.0, 10), (1, 9.0, 11), (3, 1.0, 7), (3, 2.0, 8), (3, 3.0, 9)]
