"""Master flats against arrays."""

import numpy as np
from pyspark.sql import functions as F

from nightloom.operators import masters


def test_master_flat_of_known_response(spark):
    """The response of each orderlet comes out relative to its most frequent value; dim and foreign pixels are 1."""
    rng = np.random.default_rng(1)
    rows, cols, n = 12, 40, 9
    orderlet = np.repeat([0, 1, 2], 4)[:, None] * np.ones((1, cols), int)
    lamp = 100 + np.arange(cols) * np.ones((rows, 1))
    usual = np.array([1.0, 0.8, 1.3])[orderlet]
    response = np.where(rng.random((rows, cols)) < 0.6, 1.0, rng.uniform(0.7, 1.4, (rows, cols)))
    response[5, 5], response[9, 3], response[9, 4] = 0.001, 5.0, 0.05
    bias, dark = rng.uniform(0, 50, (rows, cols)), rng.uniform(0, 2, (rows, cols))
    lamp[6, 6] = 0.0
    data = []
    for f in range(n):
        t = 1.0 + f
        image = (usual * response * (100 + np.arange(cols)) + dark) * t + bias
        if f == 3:
            image[7, 7] += 1e6  # a cosmic ray
        data += [(f, r, c, float(image[r, c]), t) for r in range(rows) for c in range(cols)]
    plane = lambda a, name, kind="double": spark.createDataFrame([(r, c, a[r, c].item()) for r in range(rows) for c in range(cols)], f"row int, col int, {name} {kind}")
    frames = spark.createDataFrame(data, "frame int, row int, col int, data double, exptime double")
    out = masters.master_flat(frames, plane(bias, "bias"), plane(dark, "dark"), plane(lamp, "lamp"), plane(orderlet, "orderlet", "int"), ["row", "col"], 10.0, 2.1)
    got = {(r.row, r.col): r for r in out.collect()}
    assert len(got) == rows * cols
    for r in range(rows):
        for c in range(cols):
            dim = usual[r, c] * response[r, c] * (100 + c) < 10
            odd = not 0.1 <= response[r, c] <= 2.5
            want = 1.0 if orderlet[r, c] == 0 or dim or odd or lamp[r, c] == 0 else response[r, c]
            assert abs(got[r, c].flat - want) < 1e-9, (r, c)
    assert got[7, 7].n == n - 1
    few = masters.few_samples(out).first()
    assert few.percent == 100.0 and few.few


def test_most_frequent(spark):
    rows = [("a", 0.101), ("a", 0.099), ("a", 0.5), ("b", 0.204), ("b", 0.31), ("c", None)]
    out = masters.most_frequent(spark.createDataFrame(rows, "k string, v double"), ["k"], "v")
    assert {r.k: r.mode for r in out.collect()} == {"a": 0.1, "b": 0.2}
    assert out.filter(F.col("mode").isNull()).count() == 0
