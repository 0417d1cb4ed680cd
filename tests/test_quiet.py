"""Quiet files over batches, and sequences settled value by value."""

import datetime as dt
import math
import random

import numpy as np
import pytest

from nightloom.operators import sequences
from nightloom.streaming import ingest, quiet

START = dt.datetime(2024, 1, 1)
SCHEMA = "path string, kind string, at timestamp"


@pytest.fixture()
def store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, quiet.PROVIDER)
    yield
    spark.conf.set(name, before)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def follow(spark, folder, batches, restart):
    """Feeds a batch at a time; with restart every batch is a new run from the checkpoint."""

    def run():
        stream = ingest.file_stream(spark, f"{folder}/in", SCHEMA, newest_first=False, per_batch=1)
        out = quiet.quiet_files(stream, "path", "kind", "at")
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for rows in batches:
        spark.createDataFrame([(p, k, at(s)) for p, k, s in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if restart:
            run()
    if not restart:
        run()
    got = spark.read.schema("path string, changed timestamp, kind string").parquet(f"{folder}/out").collect()
    return sorted((r.path, (r.changed - START).total_seconds(), r.kind) for r in got)


@pytest.mark.parametrize("restart", [False, True])
def test_late_changes_deletions_and_transfers(spark, store, tmp_path, restart):
    batches = [
        [("/d/a.fits", "created", 0), ("/d/a.fits", "modified", 2), ("/d/b.fits", "created", 1), ("/d/.c.fits.Xy1", "created", 1), ("/d/e.fits", "created", 2)],
        [("/d/b.fits", "modified", 3.5), ("/d/e.fits", "deleted", 4), ("/d/f.fits", "opened", 4)],  # b changes before it is quiet, e goes
        [("/d/g.fits", "created", 20)],
        [("/d/c.fits", "moved", 21), ("/d/g.fits", "deleted", 22), ("/d/a.fits", "modified", 22)],  # a again
        [("/d/h.fits", "created", 60), (None, "created", 60)],
        [("/d/i.fits", "created", 63), ("/d/h.fits", "modified", 63)],  # exactly three seconds are not enough
        [("/d/j.fits", "created", 90)],
    ]
    want = [("/d/a.fits", 2, "modified"), ("/d/a.fits", 22, "modified"), ("/d/b.fits", 3.5, "modified"), ("/d/c.fits", 21, "moved"), ("/d/h.fits", 63, "modified"), ("/d/i.fits", 63, "created")]
    assert follow(spark, str(tmp_path), batches, restart) == want


def test_batches_do_not_matter(spark, store, tmp_path):
    rng = random.Random(1)
    rows = sorted(((f"/d/{rng.randrange(6)}.fits", rng.choice(["created", "modified", "moved", "modified", "deleted"]), i + rng.choice([0.0, 0.25, 0.5])) for i in range(80)), key=lambda r: r[2])
    cuts = sorted(rng.sample(range(1, 80), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 80], strict=True)]
    want = []
    for i, (p, k, s) in enumerate(rows):
        later = next((r[2] for r in rows[i + 1 :] if r[0] == p), None)
        if k != "deleted" and (later - s > 3 if later is not None else s + 3.001 <= rows[-1][2]):
            want.append((p, s, k))
    assert follow(spark, str(tmp_path / "one"), [rows], False) == sorted(want)
    assert follow(spark, str(tmp_path / "many"), parts, False) == sorted(want)


def test_state_is_what_is_not_over(spark, store, tmp_path):
    transfers = [(f"/d/.t{i}.fits.x", "created", 0) for i in range(20)]  # never end
    batches = [[*transfers, ("/d/a.fits", "modified", 0), ("/d/a.fits", "created", 0)], [("/d/z.fits", "created", 60)], [("/d/z.fits", "modified", 61)]]
    for rows in batches:
        spark.createDataFrame([(p, k, at(s)) for p, k, s in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    out = quiet.quiet_files(ingest.file_stream(spark, f"{tmp_path}/in", SCHEMA, newest_first=False, per_batch=1), "path", "kind", "at")
    query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # z
    got = [tuple(r) for r in spark.read.schema("path string, changed timestamp, kind string").parquet(f"{tmp_path}/out").collect()]
    assert got == [("/d/a.fits", START, "modified")]


def test_names(spark):
    rows = spark.createDataFrame([("/a/.x.fits.k3J",), ("/a/x.fits",), (".x.fits.Q",), ("/a.b/c",)], "p string")
    got = [(r.f, r.d) for r in rows.select(quiet.final_path(rows.p).alias("f"), quiet.is_partial(rows.p).alias("d")).collect()]
    assert got == [("/a/x.fits", True), ("/a/x.fits", False), ("x.fits", True), ("/a.b/c", False)]


def settled(values):
    """Value by value, as plain numbers."""
    v, n = list(values), len(values)
    for _ in range(n // 4):
        off, instead = [], []
        for i in range(n):
            a, b = (i + 1, i + 2) if i == 0 else (i - 1, i - 2) if i == n - 1 else (i - 1, i + 1)
            mean = (v[a] + v[b]) / 2
            options = [v[i] - mean, v[i] - v[a]] + ([v[i] - v[b]] if 0 < i < n - 1 else [])
            off.append(min(options, key=abs))
            instead.append(mean if 0 < i < n - 1 else v[i] - off[-1])
        middle = float(np.median(off))
        sigma = sequences.MAD_SIGMA * float(np.median([abs(o - middle) for o in off]))
        w = max(range(n), key=lambda i: (abs(off[i]), -i))
        near = v[max(0, w - 3) : w + 4]
        if abs(off[w]) <= sequences.outlier_limit(n) * sigma or v[w] not in (max(near), min(near)):
            break
        v[w] = instead[w]
    return v


def test_neighbours_replaced_against_a_loop(spark):
    rng = random.Random(2)
    rows, want, changed = [], {}, 0
    for g in range(40):
        n = rng.choice([1, 2, 3, 4, 5, 8, 30, 61])
        v = [100 + 10 * math.sin(i / 5) + rng.gauss(0, 1) for i in range(n)]
        for _ in range(n // 10 + (n > 3)):
            v[rng.randrange(n)] += rng.choice([-80, 60, 300])
        if g % 5 == 0 and n > 20:
            v[10:14] = [500.0, 510.0, 505.0, 500.0]  # a plateau stays
        rows += [(g, i, x) for i, x in enumerate(v)]
        want[g] = settled(v)
        changed += sum(a != b for a, b in zip(v, want[g], strict=True))
    rows += [(0, 100, None), (1, 100, float("nan"))]
    rng.shuffle(rows)
    out = sequences.neighbours_replaced(spark.createDataFrame(rows, "g int, i int, x double"), ["g"], ["i"], "x").collect()
    assert len(out) == len(rows) and changed > 40
    got = {}
    for r in sorted(out, key=lambda r: (r.g, r.i)):
        if r.x is not None and r.x == r.x:
            got.setdefault(r.g, []).append(r.settled)
    assert got == want


def test_outlier_limit():
    for n in (4, 50, 3000):
        assert math.erfc(sequences.outlier_limit(n) / 3 / math.sqrt(2)) == pytest.approx(1 / n)
