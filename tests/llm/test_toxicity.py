"""Features against a plain version of them, and labels that cannot be learned from."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from nightloom.llm import toxicity

from . import edge

WORDS = [*toxicity.INSULTS[:12], *toxicity.SECOND_PERSON[:6], "hello", "World", "THE", "2024", "end.", "really!", "what?", "naïve", "müll", "st0pid", "1diot", "well-known", "a,b"]


def plain(text):
    """What each feature says, word by word."""
    raw = text.encode()
    pieces = [re.findall(rb"[A-Za-z'\x80-\xff]+", w) for w in raw.split()]
    words = [w.lower() for ws in pieces for w in ws]  # bytes.lower() leaves all but A-Z alone
    insults, second = ({w.encode() for w in ws} for ws in (toxicity.INSULTS, toxicity.SECOND_PERSON))
    hit, you = [w in insults for w in words], [w in second for w in words]
    near = [h and any(you[max(0, i - toxicity.NEAR) : i + toxicity.NEAR + 1]) for i, h in enumerate(hit)]
    n, size = max(len(words), 1), max(len(raw), 1)
    count = lambda kind: sum(c in kind for c in raw)
    upper, lower = count(range(65, 91)), count(range(97, 123))
    return {
        "words": math.log1p(len(words)), "insults": sum(hit) / n, "second_person": sum(you) / n, "insults_near_second_person": sum(near) / n, "capitals": upper / max(upper + lower, 1),
        "exclamations": raw.count(b"!") / size, "questions": raw.count(b"?") / size, "digits": count(range(48, 58)) / size, "beyond_ascii": count(range(128, 256)) / size, "insult_count": math.log1p(sum(hit)),
        "punctuation": sum(32 < c < 127 and not chr(c).isalnum() for c in raw) / size,
    }


def test_features_against_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(40))) for _ in range(200)] + ["", None, " \n"]
    got = toxicity.features(pa.array(texts), toxicity.Lexicon())
    assert np.isfinite(got).all()
    for row, text in zip(got, texts, strict=True):
        for name, value in plain(text or "").items():
            assert row[toxicity.FEATURES.index(name)] == pytest.approx(value, abs=1e-12), (name, text)


def test_features_do_not_depend_on_the_slices(monkeypatch):
    rng = random.Random(2)
    texts = pa.array([" ".join(rng.choice(WORDS) for _ in range(rng.randrange(60))) for _ in range(80)])
    lexicon = toxicity.Lexicon(toxicity.hashes(["hello", "world"]), np.array([1.5, 2.5]))
    whole = toxicity.features(texts, lexicon)
    monkeypatch.setattr("nightloom.llm.kernels.SLICE_BYTES", 300)
    assert np.allclose(whole, toxicity.features(texts, lexicon))


@pytest.mark.parametrize("toxic", [0, 1])
def test_labels_of_one_class(spark, toxic):
    docs = edge.documents(spark)
    labels = spark.createDataFrame([(i, toxic) for i in range(9)], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).withColumn("held_out", toxicity.held_out()).collect()
    assert len(out) == 12 and {(r.score, r.predicted) for r in out} == {(0.0, 0)} and all(r.held_out is not None for r in out)
