import random

import pytest
from pyspark.sql import functions as F

from nightloom.operators import registry


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_next_in_type_against_a_loop(spark, width):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(200), i, rng.choice([None, 1.5, 2.5])) for i in range(300)] + [("c", 5, 999, 1.0)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v double")
    bucket = None if width is None else F.floor(F.col("t") / width)
    got = sorted(((r.i, r.next_i, r.next_v) for r in registry.next_in_type(df, ["k"], ["t", "i"], ["i", "v"], bucket).collect()), key=str)
    want = []
    for k in {r[0] for r in rows}:
        line = sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3])
        want += [(a[2], b[2], b[3]) for a, b in zip(line, line[1:], strict=False)]
    assert got == sorted(want, key=str)
