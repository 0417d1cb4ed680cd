"""Line deduplication by SimHash.

Lines are normalised: A-Z lower-cased, every digit 0, everything but letters and digits a space.  Equal
normalised lines are one class, however short.  Each class of at least SHORTEST words has a 64-bit SimHash of its
words, cut into BLOCKS blocks: two hashes that differ in at most CLOSE bits agree in at least
BLOCKS - CLOSE of them, so lines are joined on every such choice of blocks.  Changed words move more bits than that;
so lines are also joined on segments of their words (segment_keys), one of which a few edits leave as it is, and
there the Hamming bound is DIFFERENT.  Pairs within the bound whose lengths and counts of letters the edit similarity
admits are verified by it, and each connected group of lines keeps its first occurrence by (doc_id, line).

In each cell every two lines that no chain of similar lines joins yet are compared, where their texts lie; only the
links that join something leave the task.  A cell of more than MOST lines is dealt out by length into parts, which are
compared each for itself and then, where they hold lines that are still apart, every two that can have lines in common.

Defined results: null and empty texts have no lines; lines without words stay; rows that repeat a doc_id are
one document and get the same verdict; rows without doc_id stay as they are; extra columns are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kernels import edits_within, mix, slices, words
from .workspace import Workspace

SHORTEST = 5  # words of a line that is compared with lines that differ
BLOCKS, CLOSE = 3, 1
DIFFERENT = 16  # bits, of lines that have a segment in common
SKIP = 7  # words of a line whose segments are all its words but one
LEAST_WORDS = 4  # of a segment
MOST = 8192  # lines of a cell that one task compares
SAMPLE, HOT = 16, 16  # cut_up(): a cell that has HOT lines among one class in SAMPLE is cut up
BROADCAST_ROWS = 100_000  # of 16 bytes
MANY = 256  # lines of a unit that are looked at where they lie, one line beside all others
CROWD = 512  # lines of a unit in which each meets several that only share a phrase with it, so that its runs are worth their making
RUNS = {5: 16384, 3: 4096}  # characters of a run, for long and short lines, and bits that tell which runs a line of a crowd has
VERIFIED = 4096  # pairs whose texts are taken at once
ALIKE = 8  # bits, of most copies
HELD = 4 << 20  # characters of pairs that wait for their exact distance
RESYNC = 3  # words that within() skips to find the next common one
SEEN = 1 << 20  # lines that a task remembers, so that a line that is repeated everywhere is not sent everywhere
PART = 60_000  # words that 16-bit counters can add up
LEAST = 0.85  # edit similarity

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PAIR = 0xC2B2AE3D27D4EB4F
_BITS = np.array_split(np.arange(64), BLOCKS)
_MASKS = [np.uint64(sum(1 << int(b) for i in choice for b in _BITS[i])) for choice in combinations(range(BLOCKS), BLOCKS - CLOSE)]
_ODDS = np.arange(1, len(_MASKS) + 1, dtype=np.uint64) * _ODD
_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[48:58] = 48
_PLAIN[128:] = np.arange(128, 256)

#: Letters, digits and all others are counted, once a character; white space and further bytes of a character are not.
LETTERS = 28
_LETTER = np.full(256, LETTERS, np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[48], _LETTER[192:] = 26, 27

LINE = "doc_id long, line int, id long, simhash long, n int, segments array<long>"
FEATURES = "id long, text string, simhash long, chars int, letters binary, cells array<struct<cell: long, size: int>>"


#: For each half byte four 16-bit lanes, of which those of its set bits are 1.
_LANES = np.array([sum(((v >> i) & 1) << (16 * i) for i in range(4)) for v in range(16)], np.uint64)


def simhashes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit SimHash of the words h[begin:end] of each line, and how many words it is made from.

    A word that repeats the one before it does not count again, so that a line of one word over and over has
    that word once.  64 counters are kept as 16-bit lanes of 16 sums, which are added up in parts of PART words.
    """
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[begin] = True
    count = np.concatenate(([0], np.cumsum(new)))
    a, n = count[begin], count[end] - count[begin]
    words = h[new]
    index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
    flat, first = words[index], np.cumsum(n) - n
    parts = -(-n // PART)
    line = np.cumsum(parts) - parts
    part = np.repeat(first, parts) + (np.arange(parts.sum()) - np.repeat(line, parts)) * PART
    out = np.zeros(len(begin), np.uint64)
    for nibble in range(16):
        lanes = np.add.reduceat(_LANES[((flat >> np.uint64(4 * nibble)) & np.uint64(15)).astype(np.int64)], part)
        for i in range(4):
            ones = np.add.reduceat(((lanes >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64), line)
            out |= (2 * ones > n).astype(np.uint64) << np.uint64(4 * nibble + i)
    return out, n


def segment_keys(flat: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Line and key of the segments of each line, bags of words of which an edit elsewhere leaves one as it is.

    flat are the words of lines of n words each.  A line of up to SKIP words has all its words but one; a longer one
    its first, middle and last k words, k the largest power of two up to n / 2, and its first and last k / 2, k / 4
    and so on, down to LEAST_WORDS.
    """
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(flat + _ODD))))
    end = np.cumsum(n)
    begin = end - n
    few = n <= SKIP
    at = np.repeat(few, n)
    line = np.repeat(np.arange(len(n)), n)[at]
    lines, keys = [line], [mix((total[end] - total[begin])[line] - mix(flat[at] + _ODD) + (n[line] - 1).astype(np.uint64) * _ODD)]
    line = np.flatnonzero(few)  # a line that has one word less
    lines.append(line)
    keys.append(mix((total[end] - total[begin])[line] + n[line].astype(np.uint64) * _ODD))
    line = np.flatnonzero(~few)
    a, b, size = begin[line], end[line], n[line]
    k = 1 << (np.frexp(size.astype(float))[1] - 2)
    segments = [(a + (size - k) // 2, k)]
    while k.max(initial=0) >= LEAST_WORDS:
        segments += [(a, k), (b - k, k)]
        k = k // 2
    for i, (first, length) in enumerate(segments):
        ok = length >= LEAST_WORDS
        lines.append(line[ok])
        keys.append(mix((total[first + length] - total[first] + (length * 4 + (2 if i == 0 else i & 1)).astype(np.uint64) * _ODD)[ok]))
    return np.concatenate(lines), np.concatenate(keys) | np.uint64(1)


class Lines:
    """The lines that have words, of texts that lie one after another in data."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        breaks = np.flatnonzero(data == 10)
        self.cuts = np.unique(np.concatenate([offsets, breaks + 1]))
        self.plain = _PLAIN[data]
        self.words, self.starts, self.ends, at = words(self.plain, self.cuts)
        self.long = np.flatnonzero(np.diff(at))
        self.begin, self.end = at[self.long], at[self.long + 1]
        self.text = np.searchsorted(offsets, self.cuts[self.long], "right") - 1
        self.line = np.searchsorted(breaks, self.cuts[self.long]) - np.searchsorted(breaks, offsets[self.text])
        self.n = self.end - self.begin

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """A key of all words, the SimHash, how many words that is made from, and the keys of the segments."""
        n = self.n
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        flat = self.words[index + np.repeat(self.begin, n)]
        key = np.add.reduceat(mix(flat + (index.astype(np.uint64) + np.uint64(1)) * _ODD), np.cumsum(n) - n)
        hashed, made_from = simhashes(self.words, self.begin, self.end)
        line, segment = segment_keys(flat, n)
        segment = segment[np.argsort(line, kind="stable")].astype(np.int64)
        segments = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.bincount(line, minlength=len(n))))).astype(np.int32)), pa.array(segment))
        return mix(key + n.astype(np.uint64)).view(np.int64), hashed.view(np.int64), made_from.astype(np.int32), segments

    def sizes(self) -> tuple[np.ndarray, pa.Array]:
        """Characters of each normalised line, and its counts of letters, up to 255: smaller differences refuse no pair."""
        plain, n = self.plain, len(self.long)
        count = np.concatenate(([0], np.cumsum((plain != 32) & (plain & 0xC0 != 0x80))))
        chars = count[self.ends[self.end - 1]] - count[self.starts[self.begin]] + self.n - 1
        of = np.repeat(np.arange(len(self.cuts)), np.diff(np.append(self.cuts, len(plain))))
        number = np.full(len(self.cuts), n)
        number[self.long] = np.arange(n)
        letters = np.bincount(number[of] * (LETTERS + 1) + _LETTER[plain], minlength=(n + 1) * (LETTERS + 1)).reshape(-1, LETTERS + 1)[:n, :LETTERS]
        letters = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LETTERS), n, [None, pa.py_buffer(np.minimum(letters, 255).astype(np.uint8).tobytes())])
        return chars.astype(np.int32), letters.cast(pa.binary())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["doc_id"].to_numpy()
        for base, data, offsets in slices(batch["text"]):
            lines = Lines(data, offsets)
            if len(lines.long):
                key, hashed, made_from, segments = lines.keys()
                arrays = [pa.array(ids[base + lines.text]), pa.array(lines.line.astype(np.int32)), pa.array(key), pa.array(hashed), pa.array(made_from), segments]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "line", "id", "simhash", "n", "segments"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each line, once a task: even ones of blocks of its SimHash, odd ones of its segments."""
    seen = np.zeros(0, np.int64)
    for batch in batches:
        ids, first = np.unique(batch["id"].to_numpy(), return_index=True)
        new = ~np.isin(ids, seen, assume_unique=True)
        seen = np.concatenate([seen, ids[new]]) if len(seen) < SEEN else ids[new]
        batch, ids = batch.take(pa.array(first[new])), ids[new]
        s = batch["simhash"].to_numpy().view(np.uint64)
        key = np.concatenate([mix((s & m) + odd) for odd, m in zip(_ODDS, _MASKS, strict=True)]) & ~np.uint64(1)
        segments = batch["segments"].flatten().to_numpy().view(np.uint64)
        at = np.repeat(np.arange(len(s)), pc.list_value_length(batch["segments"]).to_numpy())
        at = np.concatenate([np.tile(np.arange(len(s)), len(_MASKS)), at])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key, segments]).view(np.int64)), pa.array(ids[at])], ["cell", "id"])


def _near_enough(cell: np.ndarray, s: np.ndarray, t: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether lines of SimHash s and t, and n and m characters, that meet in a cell may be similar."""
    longer = np.maximum(n, m)
    return (np.bitwise_count(s ^ t) <= np.where(cell & 1, DIFFERENT, CLOSE)) & (longer - np.minimum(n, m) <= longer * (1 - least) + 1e-9)


def _letters(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether lines of n and m characters and these counts of letters can have the similarity: an edit takes one and gives one."""
    change = a.astype(np.int16) - b
    return np.maximum(np.maximum(change, 0).sum(-1), np.maximum(-change, 0).sum(-1)) <= np.maximum(n, m) * (1 - least) + 1e-9


def run_bits(texts: list[str], chars: int, bits: int) -> np.ndarray:
    """A bit for each run of so many characters of each text; equal runs of one text are told apart by their number.

    Bits that only one of two texts has are as many as the runs that only it has, or fewer.
    """
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    n = max(len(codes) - chars + 1, 0)
    run = np.zeros(n, np.uint64)
    for i in range(chars):
        run = mix(run + codes[i : n + i] + _ODD)
    inside = text[:n] == text[len(text) - n :]
    run, text = run[inside], text[:n][inside]
    order = np.lexsort((run, text))
    run, text = run[order], text[order]
    at = np.arange(len(run))
    first = np.concatenate(([True], (run[1:] != run[:-1]) | (text[1:] != text[:-1])))[: len(run)]
    bit = mix(run + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)) % np.uint64(bits)
    out = np.zeros((len(texts), bits), np.uint8)
    out[text, bit.astype(np.int64)] = 1
    return np.packbits(out, axis=1).view(np.uint64)


class Rows:
    """A partition's rows (cell, id, simhash, chars and more), by unit and within it by distance from the middle.

    A unit is a cell or a part of it.  Its middle has the bits that most of its SimHashes have; its first row is the
    variant that the others have come from or lie around.
    """

    def __init__(self, batches: list[pa.RecordBatch], *more: str):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, cell, s = (table[c].to_numpy() for c in ("id", "cell", "simhash"))
        unit = table["unit"].to_numpy() if "unit" in table.column_names else cell
        order = np.argsort(unit, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], unit[order][1:] != unit[order][:-1])))
        size = np.diff(np.append(begin, len(unit)))
        middle = np.zeros(len(begin), np.uint64)
        for bit in range(64):
            ones = np.add.reduceat((s.view(np.uint64)[order] >> np.uint64(bit) & np.uint64(1)).astype(np.int64), begin)
            middle |= (2 * ones > size).astype(np.uint64) << np.uint64(bit)
        far = np.zeros(len(cell), np.uint8)
        far[order] = np.bitwise_count(s.view(np.uint64)[order] ^ np.repeat(middle, size))
        order = np.lexsort((mix(ids.view(np.uint64)), far, unit))
        self.unit, self.cell, self.id = unit[order], cell[order], ids[order]
        self.simhash, self.chars = table["simhash"].to_numpy()[order].view(np.uint64), table["chars"].to_numpy()[order]
        if "letters" in more:
            self.letters = np.frombuffer(b"".join(table["letters"].to_pylist()), np.uint8).reshape(-1, LETTERS)[order]
        for name in ("root", "side"):
            if name in more:
                setattr(self, name, table[name].to_numpy()[order])
        self.crowd = np.repeat((size >= CROWD) & ("text" in more), size)
        if "text" in more:
            self.order, self.texts, self.cells = order, table["text"], table["cells"]
            self.met: dict[int, set[int]] = {}
            self.place = np.cumsum(self.crowd) - 1
            self.known, self.runs = np.zeros(len(unit), bool), {k: np.empty((int(self.crowd.sum()), bits // 64), np.uint64) for k, bits in RUNS.items()}

    def text(self, at: np.ndarray) -> list[str]:
        return self.texts.take(pa.array(self.order[at])).to_pylist()

    def own(self, x: int, y: int) -> int:
        """The one of their common cells in which these two lines are to be compared; pairs of the same cells are dealt out over these."""
        one, two = self._cells(x), self._cells(y)
        close = int(self.simhash[x] ^ self.simhash[y]).bit_count() <= CLOSE
        pair = (int(self.id[x]) ^ int(self.id[y])) * _PAIR
        return min((c for c in one & two if close or c & 1), key=lambda c: (c ^ pair) * _PAIR & 0xFFFFFFFFFFFFFFFF)

    def _cells(self, x: int) -> set[int]:
        if x not in self.met:
            self.met[x] = set(self.cells[int(self.order[x])].as_py())
        return self.met[x]

    def similar(self, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
        """Indices of those pairs that are to be compared."""
        at = np.flatnonzero(_near_enough(self.cell[x], self.simhash[x], self.simhash[y], self.chars[x], self.chars[y], least))
        for i in range(0, len(at), 1 << 14):
            some = at[i : i + (1 << 14)]
            a, b = x[some], y[some]
            ok = _letters(self.letters[a], self.letters[b], self.chars[a], self.chars[b], least)
            crowd = ok & self.crowd[a]
            if crowd.any():
                ok[crowd] = self._runs_in_common(a[crowd], b[crowd], least)
            at[i : i + (1 << 14)] = np.where(ok, some, -1)
        return at[at >= 0]

    def beside(self, p: int, end: int, least: float) -> np.ndarray:
        """Those of the rows p + 1 .. end of the unit that row p is near enough to."""
        rest = slice(p + 1, end)
        return np.flatnonzero(_near_enough(self.cell[p], self.simhash[p], self.simhash[rest], self.chars[p], self.chars[rest], least)) + p + 1

    def _runs_in_common(self, x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
        """Whether lines of crowds can have the similarity: an edit takes as many runs as a run has characters at most, and gives as many."""
        new = np.unique(np.concatenate([x, y]))
        new = new[~self.known[new]]
        for i in range(0, len(new), 1 << 10):
            some = new[i : i + (1 << 10)]
            texts = self.text(some)
            for k, bits in RUNS.items():
                self.runs[k][self.place[some]] = run_bits(texts, k, bits)
        self.known[new] = True
        most, left = np.maximum(self.chars[x], self.chars[y]) * (1 - least) + 1e-9, np.arange(len(x))
        for k, runs in self.runs.items():
            ok = np.zeros(len(left), bool)
            for i in range(0, len(left), 1 << 12):
                some = left[i : i + (1 << 12)]
                a, b = runs[self.place[x[some]]], runs[self.place[y[some]]]
                ok[i : i + (1 << 12)] = np.maximum(np.bitwise_count(a & ~b).sum(axis=1), np.bitwise_count(b & ~a).sum(axis=1)) <= k * most[some]
            left = left[ok]
        return np.isin(np.arange(len(x)), left)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those rows (cell, id) of a partition that do not have a cell to themselves, once each, and how many rows the cell has."""
    parts = list(batches)
    if parts:
        cell, ids = (np.concatenate([b[c].to_numpy() for b in parts]) for c in ("cell", "id"))
        order = np.lexsort((ids, cell))
        cell, ids = cell[order], ids[order]
        new = np.concatenate(([True], (cell[1:] != cell[:-1]) | (ids[1:] != ids[:-1])))
        cell, ids = cell[new], ids[new]
        same = cell[1:] == cell[:-1]
        keep = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        cell, ids = cell[keep], ids[keep]
        begin = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))[: len(cell)])
        size = np.diff(np.append(begin, len(cell)))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ids), pa.array(np.repeat(size, size).astype(np.int32))], ["cell", "id", "size"])


#: Words to skip in one and the other line where they differ, the fewest first.
_SKIPS = sorted(((p, q) for p in range(RESYNC + 1) for q in range(RESYNC + 1) if p + q), key=lambda s: (max(s), abs(s[0] - s[1])))


def near_copies(x: str, y: str, least: float) -> bool:
    """Whether within() tells that the edit similarity of two normalised lines is least or more."""
    return within(x.split(" "), y.split(" "), int(max(len(x), len(y)) * (1 - least) + 1e-9))


def within(x: list[str], y: list[str], most: int) -> bool:
    """Whether runs of words, laid side by side greedily, already differ by at most this many edits of characters; if not, they may still."""
    i = j = 0
    n, m = len(x), len(y)
    while i < n or j < m:
        if i < n and j < m and x[i] == y[j]:
            i += 1
            j += 1
            continue
        for p, q in _SKIPS:
            if i + p < n and j + q < m and x[i + p] == y[j + q]:
                break
        else:
            p, q = n - i, m - j
        one, two = sum(map(len, x[i : i + p])) + p, sum(map(len, y[j : j + q])) + q  # each with a space
        most -= max(one, two) - (p > 0 and q > 0)
        if most < 0:
            return False
        i += p
        j += q
    return True


def _linked(least: float, apart: bool = False):
    """Similar lines (a, b) of one unit of a partition's rows (unit, cell, id, simhash, chars, letters, text, cells), as many as join what is joined.

    Of every two lines of a unit, one after another, those are compared that no link found before joins.  With apart, lines
    of one root are joined already, and only those of different sides meet.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        rows = Rows(parts, "letters", "text", *(("root", "side") if apart else ()))
        begin = np.flatnonzero(np.concatenate(([True], rows.unit[1:] != rows.unit[:-1])))
        end = np.append(begin[1:], len(rows.unit))
        of = np.repeat(np.arange(len(begin)), end - begin)
        label = np.unique(rows.root, return_inverse=True)[1] if apart else np.arange(len(of))
        live, nth = np.flatnonzero(end - begin > 1), 0
        a, b, hard, held = [], [], [], 0
        joined = np.ones(len(begin), bool)  # units that may be one since it was last asked

        def join(p, q):
            joined[of[p]] = True
            unit = label[begin[of[p]] : end[of[p]]]
            unit[unit == label[q]] = label[p]
            a.append(rows.id[p])
            b.append(rows.id[q])

        def settle():
            """Joins those hard pairs that are similar; they wait for each other to be compared side by side."""
            left = [h for h in hard if label[h[0]] != label[h[1]]]
            hard.clear()
            close = edits_within([h[2] for h in left], [h[3] for h in left], [int(max(len(h[2]), len(h[3])) * (1 - least) + 1e-9) for h in left])
            for (p, q, *_), ok in zip(left, close.tolist(), strict=True):
                if ok and label[p] != label[q]:
                    join(p, q)

        while len(live):
            n = end[live] - begin[live] - nth - 1
            many = n >= MANY
            found = [(p, rows.beside(p, e, least)) for p, e in zip((begin[live[many]] + nth).tolist(), end[live[many]].tolist(), strict=True)]
            n = n[~many]
            x = np.repeat(begin[live[~many]] + nth, n)
            y = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + x + 1
            x = np.concatenate([x, *[np.full(len(q), p) for p, q in found]])
            y = np.concatenate([y, *[q for _, q in found]])
            open_ = label[x] != label[y]
            if apart:
                open_ &= rows.side[x] != rows.side[y]
            x, y = x[open_], y[open_]
            near = rows.similar(x, y, least)
            x, y = x[near], y[near]
            order = np.lexsort((np.bitwise_count(rows.simhash[x] ^ rows.simhash[y]), x))
            for i in range(0, len(order), VERIFIED):
                some = order[i : i + VERIFIED]
                for p, q, one, two in zip(x[some].tolist(), y[some].tolist(), rows.text(x[some]), rows.text(y[some]), strict=True):
                    if label[p] == label[q]:
                        continue
                    # most copies need no exact distance; other pairs are compared in one of their common cells only, where
                    # alone it is tried whether words tell copies of very different SimHashes
                    alike = int(rows.simhash[p] ^ rows.simhash[q]).bit_count() <= ALIKE
                    if alike and near_copies(one, two, least):
                        join(p, q)
                    elif rows.own(p, q) != rows.cell[p]:
                        continue
                    elif not alike and near_copies(one, two, least):
                        join(p, q)
                    else:
                        hard.append((p, q, one, two))
                        held += len(one) + len(two)
                        if held >= HELD:
                            settle()
                            held = 0
            nth += 1
            live = live[end[live] - begin[live] > nth + 1]
            some = live[joined[live]]
            joined[some] = False
            if len(some):  # units that are one by now are done
                n = end[some] - begin[some]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[some], n)
                first = np.cumsum(n) - n
                one = some[np.minimum.reduceat(label[at], first) == np.maximum.reduceat(label[at], first)]
                live = live[~np.isin(live, one)]
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return task


def normalised(line: str) -> str:
    raw = np.frombuffer(line.encode("utf-8", "replace"), np.uint8)
    return " ".join(_PLAIN[raw].tobytes().decode("utf-8", "replace").split())


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FEATURES of the wanted lines [(line, id)] of each document."""
    for batch in batches:
        ids, texts, at = [], [], []
        wants = batch["wanted"].flatten()
        cells = wants.field("cells") if wants.type.get_field_index("cells") >= 0 else pa.nulls(len(wants))
        n = 0
        for wanted, text in zip(batch["wanted"].to_pylist(), batch["text"].to_pylist(), strict=True):
            lines = text.split("\n")
            for w in wanted:
                if w["line"] < len(lines):
                    ids.append(w["id"])
                    texts.append(normalised(lines[w["line"]]))
                    at.append(n)
                n += 1
        texts = pa.array(texts, pa.string())
        for base, data, offsets in slices(texts):
            lines = Lines(data, offsets)
            if len(lines.long):
                hashed, _ = simhashes(lines.words, lines.begin, lines.end)
                chars, letters = lines.sizes()
                text = pa.array(base + lines.text)
                arrays = [pa.array(ids, pa.int64()).take(text), texts.take(text), pa.array(hashed.view(np.int64)), pa.array(chars), letters, cells.take(pa.array(at, pa.int64()).take(text))]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "text", "simhash", "chars", "letters", "cells"])


def keyed(lines: DataFrame) -> DataFrame:
    return lines.select("id", "simhash", "segments").mapInArrow(_keyed, "cell long, id long")


def cut_up(cells: DataFrame, lines: DataFrame, work: Workspace, sample: int = SAMPLE, hot: int = HOT) -> DataFrame:
    """Cells with those of very many lines replaced by one cell for each further segment of their lines.

    Lines that are similar have several segments in common, lines that only begin or end with the same phrase do not;
    so the pairs of a cell do not grow with the square of the phrase's frequency.  Frequent cells are found in a
    sample of the lines.
    """
    often = keyed(lines.filter(F.pmod("id", F.lit(sample)) == 0)).distinct().groupBy("cell").agg(F.count("*").alias("often")).filter(F.col("often") >= hot)
    often = work.keep(often, "often")
    n = often.count()
    if not n:
        return cells
    marked = cells.join(F.broadcast(often) if n <= BROADCAST_ROWS else often, "cell", "left")
    frequent = work.keep(marked.filter("often is not null").select("cell", "id").distinct(), "frequent")
    segments = lines.select("id", "segments").join(frequent.select("id").distinct(), "id").dropDuplicates(["id"])
    wide = frequent.join(segments.select("id", F.explode("segments").alias("segment")), "id").filter("segment <> cell")
    return marked.filter("often is null").drop("often").unionByName(wide.select((F.xxhash64("cell", "segment").bitwiseOR(1)).alias("cell"), "id"))


def dealt_out(rows: DataFrame, least: float, most: int) -> DataFrame:
    """Rows of cells of more than most lines with band and part: similar lines of a cell are in the same or neighbouring bands of lengths."""
    width = -math.log(min(max(least, 0.01), 0.99)) * 1.000001
    banded = rows.withColumn("band", F.floor(F.log(F.col("chars")) / width).cast("int"))
    parts = banded.groupBy("cell", "band").agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    return banded.join(parts, ["cell", "band"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")


def facing(rows: DataFrame, regions: DataFrame, work: Workspace) -> DataFrame:
    """Units of two parts each that can have similar lines in common, of rows with band and part, where roots are still apart."""
    rooted = rows.join(regions, "id", "left").withColumn("root", F.coalesce("root", "id"))
    open_cells = rooted.groupBy("cell").agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r <> s").select("cell")
    rooted = work.keep(rooted.join(open_cells, "cell"), "rooted")
    ends = rooted.groupBy("cell", "band", "part").agg(F.min("root").alias("r"), F.max("root").alias("s"))
    one, two = (ends.select("cell", *[F.col(c).alias(f"{c}{i}") for c in ("band", "part", "r", "s")]) for i in (1, 2))
    met = one.join(two, "cell").filter("band2 = band1 + 1 or band2 = band1 and part1 < part2").filter("least(r1, r2) <> greatest(s1, s2)")
    sides = F.explode(F.array(*[F.struct(F.col(f"band{i}").alias("band"), F.col(f"part{i}").alias("part"), F.lit(i).alias("side")) for i in (1, 2)]))
    sides = met.select("cell", F.xxhash64("cell", "band1", "part1", "band2", "part2").alias("unit"), sides.alias("of")).select("cell", "unit", "of.band", "of.part", "of.side")
    return sides.join(rooted, ["cell", "band", "part"])


def line_groups(docs: DataFrame, work: Workspace, least: float = LEAST, most: int = MOST) -> DataFrame:
    """(doc_id, line, group_id, keep_doc_id, keep_line) for each line of a group that has several occurrences."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null")
    lines = work.keep(plain.mapInArrow(_hashed, LINE), "lines")
    # short lines, and lines of a few words over and over, are told apart exactly or not at all
    compared = lines.filter(F.col("n") >= SHORTEST)
    shared = keyed(compared).repartition("cell").mapInArrow(_shared, "cell long, id long, size int")
    met = work.keep(shared.groupBy("id").agg(F.collect_list(F.struct("cell", "size")).alias("cells")), "met")  # cells of one line
    # where its text can be read, any place of one document: two numbers, which are hashed and not sorted
    first = compared.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.min_by("line", "doc_id").alias("line")).join(met, "id")
    # the texts that any comparison can need, once for each class
    wanted = first.select("doc_id", F.struct("line", "id", "cells").alias("w")).groupBy("doc_id").agg(F.collect_list("w").alias("wanted"))  # lines of one document
    texts = plain.join(wanted, "doc_id").select("wanted", "text").mapInArrow(_features, FEATURES)
    texts = work.keep(texts, "texts")
    if texts.count() > met.count():  # a doc_id that is repeated gives its lines twice
        texts = work.keep(texts.dropDuplicates(["id"]), "texts")
    work.drop(met)
    cells = texts.select("id", "simhash", "chars", "letters", "text", F.col("cells.cell").alias("cells"), F.explode("cells").alias("c"))
    cells = cells.select("c.cell", "id", "simhash", "chars", "letters", "text", "cells", "c.size")
    units = cells.filter(F.col("size") <= most).drop("size").withColumn("unit", F.col("cell"))
    large = None
    if not texts.filter(F.exists("cells", lambda c: c["size"] > most)).isEmpty():
        large = work.keep(dealt_out(cells.filter(F.col("size") > most).drop("size"), least, most), "large")
        units = units.unionByName(large.withColumn("unit", F.xxhash64("cell", "band", "part")).drop("band", "part"))
    linked = work.keep(units.repartition("unit").mapInArrow(_linked(least), "a long, b long"), "linked")
    groups = components(linked, work)
    if large is not None:
        more = work.keep(facing(large, groups, work).repartition("unit").mapInArrow(_linked(least, True), "a long, b long"), "more")
        groups = components(linked.union(more), work)
    placed = work.keep(lines.select("doc_id", "line", "id").join(groups, "id", "left").select("doc_id", "line", F.coalesce("root", "id").alias("group_id")), "placed")
    # first how often, which needs no order; then the first of those that stand several times
    often = placed.groupBy("group_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("group_id")
    several = placed.join(often, "group_id").groupBy("group_id").agg(F.min(F.struct("doc_id", "line")).alias("keep"), F.max(F.struct("doc_id", "line")).alias("last")).filter("keep <> last")
    several = work.keep(several, "several")  # both sides of the join are dealt out for it, so that a large group can be split
    work.only(placed, several)
    return placed.join(several, "group_id").select("doc_id", "line", "group_id", F.col("keep.doc_id").alias("keep_doc_id"), F.col("keep.line").alias("keep_line"))


def repeated_lines(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """line_groups() and kept: whether this occurrence stays."""
    found = line_groups(docs, Workspace(docs.sparkSession, "lines"), least)
    return found.withColumn("kept", (F.col("doc_id") == F.col("keep_doc_id")) & (F.col("line") == F.col("keep_line")))


def without_repeated_lines(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs with the repeated lines taken out of text; rows that have no text left by this are dropped."""
    gone = repeated_lines(docs, least).filter("not kept").groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("line").alias("gone"))  # lines of one document
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))  # whatever the other columns are called
    joined = rows.join(gone, F.col("doc_id") == F.col("gone_id"), "left")
    joined = joined.withColumn("lines", F.explode(F.array(F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)))))  # split once, not for each line
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    changed = joined.withColumn("text", text).filter(F.col("gone").isNull() | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    return changed.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
