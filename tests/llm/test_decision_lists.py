"""Counts against brute force, the learned list on labelled kinds of junk, and its defined results."""

import random
import re

import pytest

from nightloom.llm import decision_lists as rules
from nightloom.llm.workspace import Workspace

from . import edge

SCHEMA = "doc_id long, text string, rule string, counts int, bad int"


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, one by one."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def counted(spark, texts):
    docs = spark.createDataFrame([(i, t, "r", 1, 2) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in rules.text_counts(docs).collect()}


def test_counts_against_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(300):
        vocabulary = [rng.choice(["a", "bé", "𝛼x", "#", "*b", "c|", "D", "e."]) + str(rng.randrange(rng.choice([1, 3, 40]))) for _ in range(12)]
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\t", "\r\n", "\x0b", " \n \n"]) for _ in range(rng.randrange(80))))
    texts += [None, "", " \n\t", "a " * 9, "a " * 8, "a " * 7, "no-break space", "a\nb\na\n\n\nb \na", edge.LONG, "x y " * 3000]
    got = counted(spark, texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text), repr(text)[:200]


def test_windows_of_equal_hash_are_compared_as_words(spark):
    """Hashes alone do not make two windows equal."""
    words = [f"w{i}" for i in range(20)]
    got = spark.createDataFrame([(words, [7] * 13), ([*words[:8], *words[:8]], [7] * 9)], "w array<string>, h array<long>")
    from pyspark.sql import functions as F

    assert [r[0] for r in got.select(rules.repeated_words(F.col("w"), F.col("h"))).collect()] == [0, 16]


def sample(rng, kind):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 90))]
    if kind == "symbols":
        words = [w + rng.choice(["###", "***"]) for w in words]
    if kind == "echo":
        words = [w for w in words for _ in range(5)]
    if kind == "capitals":
        words = [w.upper() + "!!" for w in words]
    return " ".join(words)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(5)
    kinds = [rng.choice(["clean"] * 6 + ["symbols", "echo", "capitals"]) for _ in range(900)]
    docs = spark.createDataFrame([(i, sample(rng, k), "r", 1, 2) for i, k in enumerate(kinds)], SCHEMA).cache()
    labels = spark.createDataFrame([(i, int(k == "clean")) for i, k in enumerate(kinds) if i % 3], "doc_id long, quality int")
    return docs, labels, kinds


def test_unseen_documents(spark, learned):
    docs, labels, kinds = learned
    out = {r.doc_id: r for r in rules.judged(docs, labels).collect()}
    assert len(out) == 900
    unseen = [i for i in range(900) if i % 3 == 0]
    assert all(out[i].kept for i in unseen if kinds[i] == "clean")
    assert not any(out[i].kept for i in unseen if kinds[i] != "clean")
    assert all((r.rule > 0) == (not r.kept and not r.base_failed) for r in out.values())


def test_rules_are_ordered_conditions(spark, learned):
    docs, labels, _ = learned
    found = rules.fit(rules.text_counts(docs), labels, Workspace(spark, "test"))
    assert 2 <= len(found.rules) <= rules.RULES
    assert all(1 <= len(r.conditions) <= rules.CONDITIONS and r.bad >= rules.SUPPORT for r in found.rules)
    assert all(re.fullmatch(r"\w+ (>=|<) \d+( and \w+ (>=|<) \d+)*  \(\d+ bad, \d+ good\)", str(r)) for r in found.rules)


def test_statistics_against_brute_force(spark):
    rng = random.Random(6)
    names = list(rules.LEVELS)
    rows = [(rng.randrange(2), rng.randrange(2), *[rng.randrange(5) for _ in names]) for _ in range(200)]
    got = rules.statistics(spark.createDataFrame(rows, ["bad", "prune", *names]))
    for k in range(len(names)):
        for level in range(5):
            for bad in (0, 1):
                for prune in (0, 1):
                    assert got[k, level, bad, prune] == sum(r[0] == bad and r[1] == prune and r[k + 2] == level for r in rows)
    assert got.sum() == 200 * len(names)


def test_the_first_condition_has_the_highest_gain(spark):
    import math

    rng = random.Random(7)
    names = list(rules.LEVELS)
    rows = [(int(rng.random() < 0.4), 0, *[rng.randrange(9) for _ in names]) for _ in range(300)]
    condition, cover = rules.best_condition(rules.statistics(spark.createDataFrame(rows, ["bad", "prune", *names])))
    before = math.log2(sum(r[0] for r in rows) / len(rows))

    def gain(k, least, bound):
        inside = [r[0] for r in rows if (r[k + 2] >= bound) == least]
        return sum(inside) * (math.log2(sum(inside) / len(inside)) - before) if sum(inside) >= rules.SUPPORT else 0

    best = max(gain(k, least, bound) for k in range(len(names)) for least in (True, False) for bound in range(10))
    assert gain(names.index(condition.level), condition.least, condition.bound) == pytest.approx(best)
    assert cover[1, 0] >= rules.SUPPORT


@pytest.mark.parametrize("kind", ["none", "one class", "conflicts", "nulls"])
def test_labels_that_teach_nothing(spark, learned, kind):
    docs, _, kinds = learned
    rows = {
        "none": [],
        "one class": [(i, 1) for i in range(900)],
        "conflicts": [(i, q) for i in range(900) for q in (0, 1)],
        "nulls": [(i, None) for i in range(900)] + [(None, 0)],
    }[kind]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    out = rules.judged(docs, labels).collect()
    assert len(out) == 900 and {r.rule for r in out} == {0}
    assert all(r.kept != r.base_failed for r in out)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, 0), (None, 1)], "doc_id long, quality int")
    out = rules.judged(edge.documents(spark), labels).collect()
    assert len(out) == 12
    by = {r.doc_id: r for r in out}
    assert by[2].n_words == by[3].n_words == by[4].n_words == 0 and by[2].base_failed and not by[2].kept
    assert by[5].n_words == 40_000 and by[5].kept
    assert rules.judged(edge.empty(spark), labels).count() == 0
