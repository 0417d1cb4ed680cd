"""Brute force, round trips and held-out accuracy for the operators that SQL does not express, and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from nightloom.llm import line_dedup, packing, sharding, toxicity
from nightloom.llm.kernels import edit_distance, edit_search, edit_similar
from nightloom.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_distances():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        most = rng.randint(0, 12)
        assert edit_distance(a, b, most) == min(levenshtein(a, b), most + 1)
        if a:
            assert edit_search(a, b)[0] == min(levenshtein(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))


def test_lines_against_brute_force(spark):
    """Lines that are equal or differ by one word are in one group, and groups are connected by pairs within the edit similarity."""
    rng = random.Random(2)
    lines = []
    for _ in range(40):
        base = prose(rng, rng.randint(5, 60)).split()
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            if rng.random() < 0.6:
                copy[rng.randrange(len(copy))] += rng.choice(["x", "", "yy"])
            lines.append(" ".join(copy).capitalize() + rng.choice([".", "!", ""]))
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 3 : i * 3 + 3])) for i in range((len(lines) + 2) // 3)]
    got = {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line) for r in line_dedup.repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    places = [((d, k), line_dedup.normalised(line)) for d, t in docs for k, line in enumerate(t.split("\n"))]

    def groups(linked):
        root = {p: p for p, _ in places}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i, (a, x) in enumerate(places):
            for b, y in places[i + 1 :]:
                if linked(x, y):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
        return {p: find(p) for p in root}

    similar = lambda x, y: edit_similar(x, y, line_dedup.LEAST) > 0
    one_word = lambda x, y: len(x.split()) == len(y.split()) and sum(u != v for u, v in zip(x.split(), y.split(), strict=True)) <= 1
    sure, possible = groups(lambda x, y: x == y or (one_word(x, y) and similar(x, y))), groups(similar)
    found = {p: got.get(p, p) for p, _ in places}
    assert any(p != q for p, q in sure.items())
    for p, q in sure.items():
        assert found[p] == found[q]
    for p, q in found.items():
        assert possible[p] == possible[q]
    for p in got:  # the first of each group stays
        assert got[p] == min(q for q in found if found[q] == found[p])


def test_packing_round_trip(spark):
    """The pieces of every document, in order, are its ids; sequences are full but for the last few."""
    rows = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pieces = {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for d, parts in pieces.items():
        parts.sort(key=lambda r: r.start)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4")
        assert ids.tolist() == [*tokenizer.encode(texts[d], add_special_tokens=False).ids, 2]
        assert [r.start for r in parts] == np.concatenate([[0], np.cumsum([r.length for r in parts])[:-1]]).tolist()
        assert {r.doc_tokens for r in parts} == {len(ids)}
    full = {}
    for r in rows:
        full[r.sequence_id] = full.get(r.sequence_id, 0) + r.length
    assert all(n & (n - 1) == 0 and n <= 4096 for n in full.values())  # no padding at all
    steps = {}
    for r in rows:
        steps.setdefault(r.window, {}).setdefault(r.step_group, set()).add(r.sequence_id)
    for w, groups in steps.items():  # all groups of a window but its last have the same number of sequences
        sizes = [len(groups[g]) for g in sorted(groups)]
        assert set(sizes[:-1]) <= {16 * 4096 // w} and sizes[-1] <= 16 * 4096 // w


def test_step_groups_are_balanced(spark):
    docs = spark.range(0, 1500, numPartitions=7).selectExpr("id as doc_id", "repeat('word ', cast(40 + id * 7919 % 1500 as int)) as text")
    rows = packing.pack(docs, tokenizer_path(), ids=False, step_tokens=8 * 4096).groupBy("window", "step_group").agg({"length": "sum"}).orderBy("window", "step_group").collect()
    by = {}
    for r in rows:
        by.setdefault(r.window, []).append(r[2])
    assert all(set(v[:-1]) <= {8 * 4096} for v in by.values()) and sum(len(v) > 1 for v in by.values()) >= 2


def test_other_tokenizers(spark):
    import public_tokenizers
    from pathlib import Path

    rng = random.Random(11)
    texts = ["Hello World.  THE end,\n\n of Naïve stories", "", " x\ty ", *[prose(rng, 30).title() for _ in range(20)]]
    for path in sorted(Path(public_tokenizers.__file__).parent.glob("*.json")):
        try:
            plain = Tokenizer.from_file(str(path))
        except Exception:
            continue  # a vocabulary in another format
        plain.encode_special_tokens = True
        words = packing.WordTokenizer(str(path))
        assert [x.tolist() for x in words.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)], path


def test_word_tokenizer_is_exact():
    rng = random.Random(4)
    words = packing.WordTokenizer(tokenizer_path())
    odd = ["".join(rng.choice("abcXYZ.,'’!?0129éÉİß́ẞ<|>sStREéç٣½ \t\n") for _ in range(rng.randint(0, 30))) for _ in range(800)] + ["<|startoftext|> a<|endoftext|>.", "It's. DON'T, x.,", ""]
    for ids, e in zip(words.encode(odd), words.plain.encode_batch(odd, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids


def test_shards_are_even_and_maps_are_versioned(spark, tmp_path):
    docs = spark.range(20000).selectExpr("id as doc_id", "repeat('x', cast(id % 700 as int)) as text")
    path = str(tmp_path / "map")
    out = sharding.shard_documents(docs, 24, map_path=path).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in out]
    assert len(sizes) == 24 and max(sizes) / min(sizes) < 1.01
    old = sharding.load_map(spark, path)
    grown = sharding.rebalanced(old, [(s, b, n) for _, s, _, b, n in old], 25)
    sharding.save_map(spark, grown, path)
    assert {r[0] for r in sharding.load_map(spark, path)} == {2}
    before, after = ({s: k for _, s, k, _, _ in m} for m in (old, grown))
    moved = [s for s in before if before[s] != after[s]]
    assert moved and all(after[s] == 24 for s in moved)  # only into the new shard
    load = [sum(b for _, _, k, b, _ in grown if k == s) for s in range(25)]
    assert max(load) / (sum(load) / 25) < 1.05


def test_a_map_is_used_again(spark, tmp_path):
    path, used = str(tmp_path / "map"), []
    make = lambda n, more="": spark.range(n).selectExpr("id as doc_id", f"repeat('x', cast(id % 700 as int){more}) as text")
    for docs, shards in ((make(300), 4), (make(300), 4), (make(8000), 4), (make(8000), 5), (make(8000), 3)):
        out = sharding.shard_documents(docs, shards, map_path=path).collect()
        assert len(out) == docs.count() and {r.shard for r in out} == set(range(shards))
        sizes = [sum(r.size for r in out if r.shard == s) for s in range(shards)]
        assert shards * max(sizes) / sum(sizes) < 1.1
        for s in range(shards):
            assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
        used.append((out[0].map_version, {r.virtual_slot: r.shard for r in out}))
    assert [v for v, _ in used] == [1, 1, 2, 3, 4]
    grown = [(a, b) for s, a in used[2][1].items() if (b := used[3][1][s]) != a]
    assert grown and {b for _, b in grown} == {4}  # a new shard takes slots, no other gets any


def test_a_hot_row_and_a_hot_text_are_spread(spark):
    docs = spark.range(6000).selectExpr("if(id < 2000, 7, id) as doc_id", "if(id < 4000, 'same text', concat('text ', id)) as text")
    out = sharding.shard_documents(docs, 6).groupBy("shard").agg({"size": "sum", "slot": "max", "*": "count"}).toPandas()
    assert out["sum(size)"].max() / out["sum(size)"].min() < 1.05 and (out["max(slot)"] + 1 == out["count(1)"]).all()


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = QUERIES["op2_toxicity"](spark, sf).filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    ranks, n = out.score.rank(), int(out.toxic.sum())
    auc = (ranks[out.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(out) - n))
    assert auc > 0.95 and ((out.predicted == 1) & (out.toxic == 0)).mean() < 0.01
    assert out.score.between(0, 1).all()
    assert docs.count() == QUERIES["op2_toxicity"](spark, sf).count()


def test_pipeline_stages(spark):
    """Each stage on all that the stage before it kept, against a plain version of what it decides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas()) if name == "packing" else spark.createDataFrame(stage(spark, docs, SF).collect(), before.schema)
        kept[name] = before, docs
        if name != "packing":
            assert docs.columns == columns
    before, after = kept["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in toxicity.score(before, model).filter("predicted = 0").select("doc_id").collect()}
    before, after = kept["line_dedup"]
    gone = {(r.doc_id, r.line) for r in line_dedup.repeated_lines(before).filter("not kept").collect()}
    want = {}
    for r in before.collect():
        left = [x for i, x in enumerate((r.text or "").split("\n")) if (r.doc_id, i) not in gone]
        if "".join(left).strip() or not any(d == r.doc_id for d, _ in gone):
            want[r.doc_id] = "\n".join(left)
    assert {r.doc_id: r.text for r in after.collect()} == want
    before, after = kept["benchmark_decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = lambda t: " ".join(t.lower().split())
    left = {r.doc_id for r in after.collect()}
    for r in before.collect():
        if any(plain(i) in plain(r.text) for i in items):
            assert r.doc_id not in left
    before, after = kept["packing"]
    assert {r[0] for r in after.select("doc_id").collect()} == {r[0] for r in before.select("doc_id").collect()}
