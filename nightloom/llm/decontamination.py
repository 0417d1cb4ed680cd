"""Benchmark decontamination by embedded edit distance.

Texts are normalised (A-Z lower-cased, runs of white space one space).  Windows of a text and of an item face each
other where they have a gram in common, wherever in the item it stands, and where further grams of the item are on
about the same diagonal.  Windows run forwards and backwards from there, in powers of two up to the item's length.
The CGK random walk reads a window with a shared random rule that repeats or advances at each step; strings at a
small edit distance give sequences at a small Hamming distance.  Sampled positions of those sequences are compared,
in as many tables as the target recall asks for; positions that the common gram fills anyway are not sampled.  What
meets an item in any table of any window is verified: the item's edit distance to its best place in the text.

The items are a set of stated queries, searched in blocks of bounded size; every text is read whole.

Defined results: null and empty texts match nothing; items of fewer than TINY bytes are found where they stand
exactly, as whole words; items without words are not searched; items of equal text are each reported; rows that
repeat a doc_id are searched each; extra columns are kept where rows are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, WHITE, edit_search, slices
from .workspace import bound_batches

LEAST = 0.8  # edit similarity, by the item's length
RECALL = 0.95  # of a window whose embedding differs in SPREAD of its places
SPREAD = 0.25
BITS = {8: 3, 16: 7, 32: 8, 64: 8, 128: 8, 256: 8}  # places of an embedding that a table reads; fewer of short windows
WALKS = 4
SIZES = tuple(BITS)
TINY = 8  # bytes
SHORT = 64  # bytes of an item up to which its grams are short
GRAMS = {True: 5, False: 8}  # bytes of a gram, of short and of other items
MET = 16  # bytes of an item for each gram that is to be found on about one diagonal
BLOCK_BYTES = 8 << 20
PER_GRAM = 8  # cells of the table in which grams are looked up
GRAM = 4
TABLES = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - SPREAD) ** BITS[128]) / WALKS) * WALKS
PAIRS = 2_000  # windows that are read at once
HELD = 400_000  # common grams that are looked at at once, where they are not all of one text

_random = np.random.default_rng(20240229)
_STEP = _random.integers(0, 2, (WALKS, 2 * SIZES[-1], 256)).astype(np.int64)  # of each walk, step and byte: stay or advance
_STEP = np.ascontiguousarray(_STEP.transpose(1, 0, 2)).reshape(2 * SIZES[-1], WALKS * 256)  # by step, one walk after the other
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _places(size: int, gram: int) -> list[np.ndarray]:
    """For each table the steps at which the walk over a window of this size is read, those beyond its gram."""
    steps = np.arange(min(2 * gram, 2 * size - 2 * BITS[size]), 2 * size)
    return [np.sort(_random.choice(steps, BITS[size], replace=False)) for _ in range(TABLES)]


def _wanted(places: list[np.ndarray]) -> list[list[tuple[int, int]]]:
    """For each step up to the last that is read the (walk, table of the walk) that read it."""
    out = [[] for _ in range(max(int(t[-1]) for t in places) + 1)]
    for i, t in enumerate(places):
        for s in t.tolist():
            out[s].append((i % WALKS, i // WALKS))
    return out


_READ = {(c, q): _places(c, q) for c in SIZES for q in GRAMS.values()}
_WANTED = {k: _wanted(places) for k, places in _READ.items()}


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, and one space for each run of white space that does not begin a text."""
    white = WHITE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(white[1:] & white[:-1])
    count = np.concatenate(([0], np.cumsum(keep)))
    plain = np.where(white, 32, LOWER[data].astype(np.uint8)).astype(np.uint8)
    return plain[keep], count[offsets]


def gram_codes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the size bytes, at most 8, that begin at each byte."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    code = np.zeros(len(data) - size + 1, "<u8")
    more = np.concatenate((data, np.zeros(8, np.uint8)))
    for i in range(min(8, len(code))):  # eight bytes from each byte on are one number
        some = code[i::8]
        some[:] = more[i : i + 8 * len(some)].view("<u8")
    code &= np.uint64((1 << 8 * size) - 1)
    code *= _MULTIPLY
    return code ^ (code >> np.uint64(29))


def alike(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, size: int, gram: int, back: bool) -> np.ndarray:
    """Whether the embeddings of the windows of this size at a[x] and b[y] agree in all places of some table.

    Backwards, windows end at x and y.  A walk of 2 * size steps advances by size on average.
    """
    n, met = len(x), np.zeros(len(x), bool)
    reach = np.arange(2 * size) * (-1 if back else 1)
    read = np.concatenate((a.take(x[:, None] + reach, mode="clip"), b.take(y[:, None] + reach, mode="clip"))).ravel()  # what a walk can read at all, which stays in the cache
    # all walks of all pairs step side by side, first those over a, then those over b
    pair, walk = np.tile(np.arange(n), WALKS), np.repeat(np.arange(WALKS), n)
    p, turn = np.concatenate((pair, pair + n)) * (2 * size), np.tile(walk * 256, 2)
    ok = np.ones((TABLES // WALKS, len(pair)), bool)  # tables of each walk whose places are all equal so far
    bound = np.searchsorted(walk, np.arange(WALKS + 1)).tolist()
    for s, wanted in enumerate(_WANTED[size, gram]):
        byte = read.take(p)
        if wanted:
            equal = byte[: len(pair)] == byte[len(pair) :]
            for w, i in wanted:
                ok[i, bound[w] : bound[w + 1]] &= equal[bound[w] : bound[w + 1]]
        p += _STEP[s].take(turn + byte)
        if s % 8 == 7 and not (left := ok.any(axis=0)).all():
            pair, walk, ok = pair[left], walk[left], ok[:, left]
            if not len(pair):
                break
            left = np.tile(left, 2)
            p, turn = p[left], turn[left]
            bound = np.searchsorted(walk, np.arange(WALKS + 1)).tolist()
    met[pair[ok.any(axis=0)]] = True
    return met


class Grams:
    """Where the grams of the items stand: (item, place) for each, sorted by their codes."""

    def __init__(self, items: list[tuple[int, np.ndarray]], size: int):
        self.size = size
        codes = [gram_codes(x, size) for _, x in items]
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code, self.begin = np.unique(code[order], return_index=True)
        self.begin = np.append(self.begin, len(code))
        self.item = np.repeat([i for i, _ in items], [len(c) for c in codes]).astype(np.int32)[order] if codes else np.zeros(0, np.int32)
        self.place = np.concatenate([np.arange(len(c)) for c in codes]).astype(np.int32)[order] if codes else np.zeros(0, np.int32)
        # the first bits of a code say where those codes begin that have them, or -1; most grams of a text are told to be absent by one look
        bits = max(16, (PER_GRAM * len(code)).bit_length())
        self.shift = np.uint64(64 - bits)
        cell = (self.code >> self.shift).astype(np.int64)
        self.first = np.full(1 << bits, -1, np.int32)
        self.first[cell[::-1]] = np.arange(len(cell), dtype=np.int32)[::-1]
        self.longest = int(np.bincount(cell).max(initial=0))  # codes of one cell

    def hits(self, plain: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Byte, item and place in the item of every gram that texts have in common with an item, for runs of texts with about HELD of them."""
        code = gram_codes(plain, self.size)
        which = self.first.take((code >> self.shift).astype(np.int64))
        met = np.flatnonzero(which >= 0)
        which, code = which.take(met), code.take(met)
        for _ in range(self.longest - 1):
            which += (self.code.take(which) < code) & (which < len(self.code) - 1)
        equal = self.code.take(which) == code if len(met) else np.zeros(0, bool)
        met, which = met[equal], which[equal]
        left = self.begin.take(which)
        count = self.begin.take(which + 1) - left
        total = np.concatenate(([0], np.cumsum(count)))
        first = np.searchsorted(met, at)  # of each text
        i = 0
        while i < len(at) - 1:
            j = max(i + 1, int(np.searchsorted(total[first], total[first[i]] + HELD, "right")) - 1)
            some = slice(first[i], first[j])
            n = count[some]
            where = np.repeat(left[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(met[some], n), self.item[where].astype(np.int64), self.place[where].astype(np.int64)
            i = j


class Items:
    """Normalised items with their grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.texts, self.grams, self.tiny = [], [], [], {}
        data, begin = [], [0]
        for item_id, text in items:
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            plain, _ = squeezed(raw, np.array([0, len(raw)]))
            plain = np.frombuffer(plain.tobytes().strip(), np.uint8)
            text = plain.tobytes().decode("utf-8", "replace")
            if len(plain) < TINY:
                if len(plain):
                    self.tiny.setdefault(text, []).append(item_id)
                continue
            self.ids.append(item_id)
            self.texts.append(text)
            self.grams.append([text[i : i + GRAM] for i in range(len(text) - GRAM + 1)])
            data.append(plain)
            begin.append(begin[-1] + len(plain))
        self.data, self.begin = np.concatenate([*data, np.zeros(1, np.uint8)]), np.array(begin)
        self.sizes = np.diff(self.begin)
        self.kinds = {short: Grams([(i, x) for i, x in enumerate(data) if (len(x) < SHORT) == short], q) for short, q in GRAMS.items()}
        self.word = re.compile("(?<![^ ])(?:" + "|".join(re.escape(t) for t in sorted(self.tiny, key=len, reverse=True)) + ")(?![^ ])") if self.tiny else None

    def starts(self, plain: np.ndarray, at: np.ndarray, short: bool, least: float) -> np.ndarray:
        """Rows (text, item, byte where the item would begin) of what meets an item in a table."""
        found = [self.met(plain, at, GRAMS[short], least, *hits) for hits in self.kinds[short].hits(plain, at)]
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def met(self, plain: np.ndarray, at: np.ndarray, gram: int, least: float, pos: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """starts() for the grams that stand at these bytes, of these items."""
        text = np.searchsorted(at, pos, "right") - 1
        inside = pos + gram <= at[np.minimum(text + 1, len(at) - 1)]
        pos, item, place, text = (x[inside] for x in (pos, item, place, text))
        # grams of one item on about one diagonal of one text
        slack = (self.sizes[item] * (1 - least)).astype(np.int64) + 4
        width = len(plain) + 2 * int(self.sizes.max(initial=0)) + 16
        key = (text * len(self.ids) + item) * width + pos - place + int(self.sizes.max(initial=0)) + 8
        order = np.lexsort((pos, key))
        key, pos, item, place, text, slack = (x[order] for x in (key, pos, item, place, text, slack))
        enough = np.searchsorted(key, key + slack, "right") - np.searchsorted(key, key - slack, "left") >= np.maximum(self.sizes[item] // MET, 1)
        key, pos, item, place, text = (x[enough] for x in (key, pos, item, place, text))
        # of a run of grams, windows go forwards from its first one and backwards from its last
        follows = np.zeros(len(pos) + 1, bool)
        follows[1:-1] = (key[1:] == key[:-1]) & (pos[1:] - pos[:-1] <= gram)
        met = np.zeros(len(pos), bool)
        fits = np.zeros(len(pos), bool)
        for size in SIZES:
            if size <= gram:
                continue
            for back in (False, True):
                room = (place + gram >= size) if back else (place + size <= self.sizes[item])
                fits |= room
                room = np.flatnonzero(room & ~met & ~(follows[1:] if back else follows[:-1]))
                for i in range(0, len(room), PAIRS):
                    some = room[i : i + PAIRS]
                    x, y = pos[some], self.begin[item[some]] + place[some]
                    if back:
                        x, y = x + gram - 1, y + gram - 1
                    met[some] = alike(plain, x, self.data, y, size, gram, back)
        met |= ~fits  # no window fits into the item beside its gram
        return np.stack([text[met], item[met], pos[met] - place[met]], 1)

    def search(self, texts: pa.Array, least: float) -> Iterator[list[tuple[int, float, int]]]:
        """Per text its matches (item_id, similarity, first character of the normalised text)."""
        for _, data, offsets in slices(texts):
            plain, at = squeezed(data, offsets)
            found = [self.starts(plain, at, short, least) for short, grams in self.kinds.items() if len(grams.code)]
            candidates: dict[int, list[tuple[int, int]]] = {}
            for doc, item, start in np.concatenate(found).tolist() if found else ():
                candidates.setdefault(doc, []).append((item, start))
            for doc in range(len(offsets) - 1):
                matches = self.verified(plain, at, doc, candidates.get(doc, ()), least)
                yield sorted(matches + self.exact(plain, at, doc)) if self.tiny else matches

    def exact(self, plain: np.ndarray, at: np.ndarray, doc: int) -> list[tuple[int, float, int]]:
        """The tiny items that stand in the text as whole words."""
        first: dict[str, int] = {}
        text = plain[int(at[doc]) : int(at[doc + 1])].tobytes().decode("utf-8", "replace")
        for m in self.word.finditer(text):
            first.setdefault(m.group(), m.start())
        return [(i, 1.0, p) for t, p in first.items() for i in self.tiny[t]]

    def verified(self, plain: np.ndarray, at: np.ndarray, doc: int, candidates: list[tuple[int, int]] | tuple, least: float) -> list[tuple[int, float, int]]:
        best: dict[int, tuple[float, int]] = {}
        places: list[tuple[int, int, int]] = []  # item, first and last start; starts nearer than the slack share a place
        for item, start in candidates:
            if places and places[-1][0] == item and start - places[-1][1] <= len(self.texts[item]) * (1 - least):
                places[-1] = item, places[-1][1], start
            else:
                places.append((item, start, start))
        for item, low, high in places:
            text = self.texts[item]
            if best.get(item, (0.0, 0))[0] == 1.0:
                continue
            slack = int(len(text) * (1 - least)) + 8
            a = max(int(at[doc]), low - slack)
            b = min(int(at[doc + 1]), high + int(self.sizes[item]) + slack)
            window = plain[a:b].tobytes().decode("utf-8", "ignore")
            grams = {window[i : i + GRAM] for i in range(len(window) - GRAM + 1)}
            if sum(map(grams.__contains__, self.grams[item])) < len(text) - GRAM + 1 - GRAM * int(len(text) * (1 - least) + 1e-9):
                continue  # each edit spoils GRAM of the item's grams at most
            d, end = edit_search(text, window)
            similarity = 1 - d / len(text)
            if similarity >= least and similarity > best.get(item, (0.0, 0))[0]:
                before = len(plain[int(at[doc]) : a].tobytes().decode("utf-8", "ignore"))
                best[item] = similarity, before + max(0, end - len(text))
        return [(self.ids[i], s, p) for i, (s, p) in sorted(best.items())]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about block_bytes, however many there are; their tables take some 50 times as much."""
    bound_batches(benchmark.sparkSession)
    items = benchmark.filter("text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    for k in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()]


MATCH = "doc_id long, item_id long, similarity double, start long"


def contaminations(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, similarity, start) for each item that a document holds, at its best place."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for block in item_blocks(benchmark):
        items = docs.sparkSession.sparkContext.broadcast(Items(block))

        def task(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, *m) for d, found in zip(batch["doc_id"].to_pylist(), items.value.search(batch["text"], least), strict=True) for m in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.int64()))], ["doc_id", "item_id", "similarity", "start"])

        part = plain.mapInArrow(task, MATCH)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs that hold no item, with all their columns."""
    out = docs
    for block in item_blocks(benchmark):
        items = docs.sparkSession.sparkContext.broadcast(Items(block))

        def task(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not found for found in items.value.search(batch["text"], least)], pa.bool_()))

        out = out.mapInArrow(task, docs.schema)
    return out
