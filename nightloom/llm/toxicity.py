"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are rates over a whole text: hits of a fixed lexicon and of one learned from labels (whole words and
word beginnings), hits near a second-person word, capitals, punctuation, digits and obfuscated spellings.  The
labelled rows are split by crc32(doc_id) mod 5: 0 is never learned from, 1 and 2 give the learned lexicon, 3 the
trees and 4 the calibration, so that no part is judged on rows that it was made from.

Each part is fitted on at most FIT_ROWS labelled rows, those with the smallest hash of doc_id.  All texts are
scored, whole.

Defined results: null and empty texts are scored like any text without words; labels that are null or have no
document are not used, several labels of a doc_id count as their largest; rows that repeat a doc_id are scored
each; without labels of both classes every score is 0; extra columns are not used; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, mix, slices, words
from .workspace import Workspace

FIT_ROWS = 8000
LEARNED = 400
BEGINNINGS = (4, 5, 6)  # bytes
NEAR = 5  # words

#: Insults, in English, German, French and Spanish.
INSULTS = """
stupid idiot idiots idiotic moron morons moronic trash pathetic disgusting worthless clown clowns loser losers scum dumb dumbass fool fools
imbecile jerk creep filth filthy vermin parasite coward garbage ugly hate shut
dumm idioten trottel abschaum arschloch versager widerlich wertlos müll
imbécile débile minable ordure salaud connard nul
estúpido idiota imbécil basura asqueroso patético perdedor escoria
""".split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu toi te ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()

FEATURES = [
    "words", "insults", "insults_obfuscated", "second_person", "insults_near_second_person", "capitals", "capital_words", "exclamations", "questions",
    "punctuation", "digits", "obfuscated_words", "repeated_letters", "beyond_ascii", "insult_count", "learned", "learned_count", "learned_weight", "learned_near_second_person",
    "beginnings", "beginnings_count", "beginnings_weight", "strongest",
]

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LETTER[ord("'")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SWAP = np.arange(256, dtype=np.uint8)
for _a, _b in zip("013457@$!|", "oieastasil", strict=True):
    _SWAP[ord(_a)] = ord(_b)


def hashes(terms: list[str]) -> np.ndarray:
    data = " ".join(terms).encode()
    return np.sort(words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])


def beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
    """A hash of the first k bytes of every word longer than that, else 0."""
    ok = ends - starts > k
    at = np.where(ok, starts, 0)
    h = np.zeros(len(starts), np.uint64)
    for i in range(k):
        h = mix(h + LOWER[data[np.minimum(at + i, len(data) - 1)]] + np.uint64(i * 977 + k))
    return np.where(ok, h, np.uint64(0))


def _among(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each x is in the sorted array known, and where."""
    if not len(known):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return known[at] == x, at


def _squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with digits and signs read as the letters they stand for, other signs left out."""
    swapped = _SWAP[data]
    keep = _LETTER[swapped] | _SPACE[data]
    count = np.concatenate(([0], np.cumsum(keep)))
    return swapped[keep], count[offsets]


@dataclass
class Lexicon:
    """Sorted hashes with a weight each; words and beginnings of words are kept apart."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    word_weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    start_weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


def terms(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct word hashes and distinct hashes of word beginnings."""
    for _, data, offsets in slices(texts):
        plain = np.where(_LETTER[data], data, np.uint8(32))
        h, starts, ends, at = words(plain, offsets)
        begun = [beginnings(plain, starts, ends, k) for k in BEGINNINGS]
        for a, b in zip(at[:-1], at[1:], strict=True):
            begin = np.unique(np.concatenate([x[a:b] for x in begun]))
            yield np.unique(h[a:b]), begin[begin != 0]


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row of FEATURES for each text."""
    insults, second = hashes(INSULTS), hashes(SECOND_PERSON)
    out = []
    for _, data, offsets in slices(texts):
        n = len(offsets) - 1
        size = np.maximum(np.diff(offsets), 1)

        def per_text(flags: np.ndarray, offsets=offsets) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(flags)))
            return total[offsets[1:]] - total[offsets[:-1]]

        upper = (data >= 65) & (data <= 90)
        lower = (data >= 97) & (data <= 122)
        digit = (data >= 48) & (data <= 57)
        sign = (data > 32) & (data < 127) & ~upper & ~lower & ~digit
        plain = np.where(_LETTER[data], data, np.uint8(32))
        h, starts, ends, at = words(plain, offsets)
        count = np.maximum(np.diff(at), 1)

        def per_words(x: np.ndarray, at=at) -> np.ndarray:
            total = np.concatenate(([0.0], np.cumsum(x)))
            return total[at[1:]] - total[at[:-1]]

        hit = _among(h, insults)[0]
        you = _among(h, second)[0]
        owner = np.repeat(np.arange(n), np.diff(at))
        nearest = np.flatnonzero(you)

        def near(flags: np.ndarray, nearest=nearest, owner=owner) -> np.ndarray:
            """Those flagged words that stand at most NEAR words from a second-person word of the same text."""
            where = np.flatnonzero(flags)
            ok = np.zeros(len(flags), bool)
            if len(nearest):
                right = np.minimum(np.searchsorted(nearest, where), len(nearest) - 1)
                for p in (nearest[right], nearest[np.maximum(right - 1, 0)]):
                    ok[where] |= (np.abs(p - where) <= NEAR) & (owner[p] == owner[where])
            return ok

        squeezed, moved = _squeezed(data, offsets)
        hidden, _, _, hidden_at = words(squeezed, moved)
        found = np.concatenate(([0], np.cumsum(_among(hidden, insults)[0])))
        found = found[hidden_at[1:]] - found[hidden_at[:-1]]
        raw, raw_starts, raw_ends, raw_at = words(data, offsets)

        def share(flags: np.ndarray, a=raw_starts, b=raw_ends) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(flags)))
            return total[b] - total[a]

        letters, odd = share(_LETTER[data]), share(digit | np.isin(data, np.frombuffer(b"@$*#!|%&", np.uint8)))
        mixed = np.concatenate(([0], np.cumsum((letters > 0) & (odd > 0))))
        mixed = mixed[raw_at[1:]] - mixed[raw_at[:-1]]
        capital = (share(upper) == letters) & (letters >= 2)
        capital = np.concatenate(([0], np.cumsum(capital)))
        capital = capital[raw_at[1:]] - capital[raw_at[:-1]]
        again = np.zeros(len(data), bool)
        if len(data) > 2:
            again[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & _LETTER[data[2:]]
        known, where = _among(h, lexicon.words)
        weight = np.where(known, lexicon.word_weights[where], 0.0) if len(lexicon.words) else np.zeros(len(h))
        begun, begun_weight = np.zeros(len(h), bool), np.zeros(len(h))
        for k in BEGINNINGS:
            ok, where = _among(beginnings(plain, starts, ends, k), lexicon.starts)
            if len(lexicon.starts):
                begun_weight = np.maximum(begun_weight, np.where(ok, lexicon.start_weights[where], 0.0))
            begun |= ok
        strongest = np.zeros(n)
        np.maximum.at(strongest, owner, np.maximum(weight, begun_weight))
        insult = per_words(hit)
        columns = [
            np.log1p(np.diff(at)), insult / count, np.maximum(found - insult, 0) / count, per_words(you) / count, per_words(near(hit)) / count, per_text(upper) / np.maximum(per_text(upper | lower), 1), capital / count,
            per_text(data == 33) / size, per_text(data == 63) / size, per_text(sign) / size, per_text(digit) / size, mixed / count, per_text(again) / size, per_text(data >= 128) / size, np.log1p(insult),
            per_words(known) / count, np.log1p(per_words(known)), per_words(weight) / count, per_words(near(known | begun)) / count,
            per_words(begun) / count, np.log1p(per_words(begun)), per_words(begun_weight) / count, strongest,
        ]
        out.append(np.stack(columns, 1))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The columns keep of docs and features array<double>."""
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch["text"], lexicon)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in keep], flat], [*keep, "features"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(task, f"{kinds}, features array<double>")


def learned_lexicon(labelled: DataFrame) -> Lexicon:
    """Words and word beginnings that toxic texts have far more often, from rows (toxic, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch["toxic"].to_numpy(zero_copy_only=False)
            kinds: dict[tuple[bool, int], list[np.ndarray]] = {}
            for t, (w, b) in zip(toxic, terms(batch["text"]), strict=True):
                kinds.setdefault((False, int(t)), []).append(w)
                kinds.setdefault((True, int(t)), []).append(b)
            for (start, t), all_of in kinds.items():
                x, n = np.unique(np.concatenate(all_of), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), start)), pa.array(x.astype(np.int64)), pa.array(n * t), pa.array(n * (1 - t))], ["start", "term", "pos", "neg"])

    counts = labelled.select("toxic", "text").mapInArrow(task, "start boolean, term long, pos long, neg long")
    counts = counts.groupBy("start", "term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter("pos >= 4")
    size = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    p, n = size.get(1, 0), size.get(0, 0)
    odds = F.log((F.col("pos") + 0.5) / F.lit(p + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(n + 1.0))
    best = counts.withColumn("odds", odds).filter("odds > 2").orderBy(F.desc(F.col("odds") * F.sqrt("pos")), "start", "term").limit(LEARNED).collect()
    made = []
    for start in (False, True):
        some = sorted((np.uint64(r["term"] & (2**64 - 1)), r["odds"]) for r in best if r["start"] is start)
        made += [np.array([x for x, _ in some], np.uint64), np.array([y for _, y in some], float)]
    return Lexicon(*made)


@dataclass
class Model:
    lexicon: Lexicon
    trees: object = None
    calibration: object = None


def fold(doc_id: str = "doc_id"):
    """crc32 of the id's text mod 5, null without an id."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5


def held_out(doc_id: str = "doc_id"):
    """Whether the row's label is never learned from by its fold; a row without an id has no label and is in no fold."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learns from documents whose fold is not 0; rows is the most labelled rows that each part uses."""
    spark = docs.sparkSession
    known = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("part", F.when(fold() == 0, None).when(fold() <= 2, 0).when(fold() == 3, 1).otherwise(2)).filter("part is not null")
    chosen = None
    for part in range(3):
        some = known.filter(F.col("part") == part).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    work = Workspace(spark, "toxicity")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = work.keep(plain.join(F.broadcast(chosen), "doc_id"), "sample")  # at most 3 * rows rows are broadcast
    sizes = {tuple(r[:2]): r[2] for r in sample.groupBy("part", "toxic").count().collect()}
    lexicon = learned_lexicon(sample.filter("part = 0"))
    model = Model(lexicon)
    if not all((1, t) in sizes for t in (0, 1)):
        return model
    ready = work.keep(with_features(sample.filter("part > 0"), lexicon, ["doc_id", "part", "toxic"]), "features")
    ready = ready.select("part", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("vector"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=25, maxDepth=3, stepSize=0.2, maxBins=64, seed=7, minInstancesPerNode=2)
    model.trees = trees.fit(ready.filter("part = 1"))
    rest = ready.filter("part = 2")
    if all((2, t) in sizes for t in (0, 1)):
        scored = model.trees.transform(rest).select("label", vector_to_array("probability")[1].alias("raw_score"))
        model.calibration = IsotonicRegression(featuresCol="raw_score", labelCol="label").fit(scored)
    return model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns keep, score, predicted and raw_score for each row.

    score is the calibrated value; raw_score is what the trees say, which orders rows within a step of the calibration.
    """
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    columns = ["doc_id", *keep]
    if model.trees is None:
        return rows.select(*columns, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0.0).alias("raw_score"))
    ready = with_features(rows, model.lexicon, columns).withColumn("vector", array_to_vector("features"))
    scored = model.trees.transform(ready).select(*columns, vector_to_array("probability")[1].alias("raw_score"))
    value = F.col("raw_score")
    if model.calibration is not None:
        scored = model.calibration.setPredictionCol("calibrated").transform(scored)
        value = F.col("calibrated")
    value = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
    return scored.select(*columns, value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), "raw_score")
