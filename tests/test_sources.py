import random

import pytest
from pyspark.sql import functions as F

from nightloom.functions import scalars as S
from nightloom.operators import asof, ingest, registry, sequences, statistics
from nightloom.sources import observations as O
from nightloom.streaming import ingest as streams
from nightloom.streaming import tracking


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_lists(spark, tmp_path):
    (tmp_path / "valid.csv").write_text("TAG, start, stop, path\n1.0, 2024-01-01 00:00:00, 2024-02-01 00:00:00, a\n2.0, 2024-01-15 00:00:00, 2024-03-01 00:00:00, b\n")
    rows = O.read_validity(spark, str(tmp_path / "valid.csv"))
    at = spark.createDataFrame([(1, "2024-01-20"), (2, "2024-01-14 23:59:59"), (3, "2025-01-01")], "k int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r.k: r.path for r in asof.within_interval(at, rows, "t", "start", "stop", "path", "path").collect()}
    assert got == {1: "b", 2: "a", 3: None}


def test_catalog_problems(spark, tmp_path):
    (tmp_path / "c.csv").write_text("keyword|datatype|description|unit\nA|int|x|s\nB|number|x|s\nC|float||s\nA|int|y|s\n")
    got = {(r.keyword, r.problem) for r in O.problems_of_catalog(O.read_catalog(spark, str(tmp_path / "c.csv"))).collect()}
    assert got == {("B", "unknown type"), ("C", "blank field"), ("A", "repeated keyword")}


def test_checksums(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    files = spark.read.format("binaryFile").load(str(tmp_path / "f.bin")).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("path"), "content")
    stored = spark.createDataFrame([("f.bin", "900150983cd24fb0d6963f7d28e17f72")], "path string, checksum string")
    assert O.checksums(files, stored).first()["matches"]


@pytest.mark.parametrize(("raw", "value"), [("-nan", None), ("nan", None), (" 1.5 ", 1.5), ("x", None), ("-999", None), (None, None)])
def test_clean_number(spark, raw, value):
    assert one(spark, O.clean_number(F.lit(raw).cast("string"))) == value


def test_degrees(spark):
    assert one(spark, S.degrees(F.lit("-00:30:00"))) == pytest.approx(-0.5)
    assert one(spark, S.degrees(F.lit("12:00:00"), 15.0)) == pytest.approx(180.0)


def test_observation_time(spark):
    assert str(one(spark, S.observation_time(F.lit("KP.20240102.03661.05")))) == "2024-01-02 01:01:01"
    assert str(one(spark, S.observation_time(F.lit("KP.2024.1.5")))) == "2000-01-01 00:00:00"


def test_clipped_stack_of_a_known_stack(spark):
    """Four frames of 2 x 3 pixels counting up, one of them replaced by an outlier."""
    rows = [(r, c, float(f * 6 + r * 3 + c)) for f in range(4) for r in range(2) for c in range(3)]
    rows = [(r, c, 42.0 if (r, c, v) == (1, 2, 23.0) else v) for r, c, v in rows]
    got = {(r.row, r.col): r for r in statistics.clipped_stack(spark.createDataFrame(rows, "row int, col int, v double"), ["row", "col"], "v", 2.5).collect()}
    assert got[(0, 0)].n == 4 and got[(0, 0)].mean == pytest.approx(9.0)
    assert got[(1, 2)].center == pytest.approx(14.0)


def test_asof_over_empty_buckets(spark):
    left = spark.createDataFrame([(1, "2024-06-01"), (1, "2023-01-01"), (2, "2024-06-01")], "k int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    right = spark.createDataFrame([(1, "2023-01-02", "a"), (1, "2025-12-31", "b")], "k int, t string, v string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    right = right.select("k", "t", F.struct("t", "v").alias("s"))
    both = asof.asof_after(asof.asof_before(left, right, ["k"], "t", "s"), right, ["k"], "t", "s")
    got = {(r.k, str(r.t)[:10]): (r.before and r.before.v, r.after and r.after.v) for r in both.collect()}
    assert got == {(1, "2024-06-01"): ("a", "b"), (1, "2023-01-01"): (None, "a"), (2, "2024-06-01"): (None, None)}


def test_greedy_bins_of_unequal_steps(spark):
    rows = spark.createDataFrame([(1, float(t), float(t), 1.0) for t in (0, 4, 9, 10, 19, 20, 35)], "k int, t double, v double, e double")
    got = [(r.bin, r.n) for r in sequences.greedy_bins(rows, ["k"], "t", "v", "e", 10.0).orderBy("bin").collect()]
    assert got == [(0, 3), (1, 2), (2, 1), (3, 1)]


def test_intervals_keep_every_row(spark):
    """Rows that are alike stay apart, and a long list gives what a short one gives."""
    rng = random.Random(3)
    rows = [(i, rng.randrange(100), rng.randrange(100), f"p{i}") for i in range(60)]
    intervals = spark.createDataFrame(rows, "row int, start int, stop int, path string")
    times = [rng.randrange(-5, 105) for _ in range(300)] + [7, 7, 7]
    df = spark.createDataFrame([(t,) for t in times], "t int")
    for lower, upper in ((">=", "<"), (">", "<"), (">=", "<=")):
        want = []
        for t in times:
            held = [r for r in rows if (t > r[1] or (t == r[1] and lower == ">=")) and (t < r[2] or (t == r[2] and upper == "<="))]
            want.append((t, max(held)[3] if held else None))
        for nested in (asof.NESTED_ROWS, -1):
            asof.NESTED_ROWS, before = nested, asof.NESTED_ROWS
            got = [(r.t, r.path) for r in asof.within_interval(df, intervals, "t", "start", "stop", "path", "path", lower=lower, upper=upper).collect()]
            asof.NESTED_ROWS = before
            assert sorted(got, key=str) == sorted(want, key=str)


def test_greedy_bins_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(g, rng.uniform(0, 50) if rng.random() < 0.5 else float(rng.randrange(50)), rng.uniform(0, 9), rng.choice([0.0, 1.0, 2.0])) for g in range(4) for _ in range(40 * g + 1)]
    got = {(r.g, r.bin): (r.n, round(r.mean, 9)) for r in sequences.greedy_bins(spark.createDataFrame(rows, "g int, t double, x double, e double"), ["g"], "t", "x", "e", 1.5).collect()}
    want = {}
    for g in range(4):
        bins, open_ = [], None
        for _, t, x, e in sorted(r for r in rows if r[0] == g and r[3] > 0):
            if open_ is None or t >= open_ + 1.5:
                open_ = t
                bins.append([])
            bins[-1].append((x, e))
        want |= {(g, i): (len(b), round(sum(x / e**2 for x, e in b) / sum(1 / e**2 for _, e in b), 9)) for i, b in enumerate(bins)}
    assert got == want


def test_ingest_batches(spark, tmp_path):
    """A stream of listings keeps a registry; a batch that is repeated changes nothing, and nulls replace values."""
    schema = "obs long, read_l0 timestamp_ntz, total double"
    way = ingest.Ingest("obs", ["l0"], ["read_l0"], lambda rows: rows.select("obs", F.col("l0").alias("read_l0"), "total"))
    listing = lambda *rows: spark.createDataFrame(rows, "obs long, l0 string, total double").withColumn("l0", F.col("l0").cast("timestamp_ntz"))
    each = way.batches(spark, str(tmp_path / "registry"), schema)
    batches = [listing((1, "2024-01-01", 1.0), (2, "2024-01-01", 2.0)), listing((1, "2024-01-02", None), (2, "2024-01-01", 9.0), (3, "2024-01-01", 3.0))]
    for number, batch in enumerate(batches):
        each(batch, number)
    each(batches[1], 1)
    got = {r.obs: r.total for r in registry.newest_version(spark, str(tmp_path / "registry"), schema, 99).collect()}
    assert got == {1: None, 2: 2.0, 3: 3.0}


def test_ingest_stream(spark, tmp_path):
    schema = "obs long, read_l0 timestamp_ntz, total double"
    spark.createDataFrame([(i, "2024-01-01", float(i)) for i in range(20)], "obs long, l0 string, total double").withColumn("l0", F.col("l0").cast("timestamp_ntz")).repartition(3).write.parquet(str(tmp_path / "in"))
    way = ingest.Ingest("obs", ["l0"], ["read_l0"], lambda rows: rows.select("obs", F.col("l0").alias("read_l0"), "total"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), "obs long, l0 timestamp_ntz, total double", per_batch=1)
    streams.run_batches(stream, way.batches(spark, str(tmp_path / "registry"), schema), str(tmp_path / "checkpoint")).awaitTermination()
    assert registry.newest_version(spark, str(tmp_path / "registry"), schema, 99).count() == 20


def test_tracked_stream_is_the_batch_fold(spark, tmp_path):
    rng = random.Random(6)
    rows = [(k, n, float(rng.randrange(60)), 30.0) for n in range(6) for k in range(4) for _ in range(3)]
    schema = "k int, night int, x double, first double"
    for n in range(6):  # one file a night, in order
        spark.createDataFrame([r for r in rows if r[1] == n], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = streams.file_stream(spark, str(tmp_path / "in"), schema, newest_first=False, per_batch=1)
    out = streams.into_table(tracking.tracked(stream, "k", "night", "x", "first", 9.0), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = sequences.tracked(spark.createDataFrame(rows, schema), ["k"], "night", "x", F.first("first"), 9.0)
    assert sorted(map(tuple, out.collect())) == sorted((r.k, r.step, r.position, r.met) for r in batch.collect())
