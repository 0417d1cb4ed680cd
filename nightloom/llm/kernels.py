"""NumPy helpers that run inside tasks: word hashes, shingle sets and exact edit distance.

Every helper takes the texts of one Arrow batch and looks at them in slices of half a MB, so that the
temporary arrays stay small whatever the batch holds.  A single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply, shift): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets within them) for runs of texts of about SLICE_BYTES; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1 + texts.offset)[texts.offset :]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word, and per text the index of its first word (one more at the end)."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    np.logical_not(WHITE[data], out=solid[1 : n + 1])
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = solid[1:-1] & (~solid[:-2] | cut[:-1])
    last = solid[1:-1] & (~solid[2:] | cut[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    at = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends, at
    length = ends - starts
    power = np.cumprod(np.full(int(length.max()), _BASE, np.uint64))
    where = np.flatnonzero(solid[1:-1])
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(len(where)) - np.repeat(begin, length)
    value = (LOWER[data[where]] + np.uint64(1)) * power[place]
    return mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _ODD), starts, ends, at


def distinct(flat: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts each of the lists flat[begin[i]:begin[i + 1]] in place and leaves its repeats out: the lists, and where each begins."""
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[begin[:-1][begin[:-1] < len(flat)]] = True
    return flat[new], np.concatenate(([0], np.cumsum(new)))[begin]


def shingle_lists(texts: pa.Array, k: int = 5) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of texts their sorted distinct 64-bit shingle hashes one after another, and where each text's begin (one more at the end).

    Words are runs without ASCII white space, A-Z lower-cased; a text of fewer than k words has its whole
    sequence as one shingle, and a text without words has an empty set.
    """
    for _, data, offsets in slices(texts):
        hashed, _, _, at = words(data, offsets)
        runs = max(0, len(hashed) - k + 1)
        run = np.zeros(max(runs, 1), np.uint64)
        for i in range(k if runs else 0):
            run = mix(run + hashed[i : runs + i] * _ODD + np.uint64(i + 1))
        n = np.diff(at)
        size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        begin = np.concatenate(([0], np.cumsum(size)))
        flat = run.take(np.arange(begin[-1]) + np.repeat(at[:-1] - begin[:-1], size), mode="clip")
        for t in np.flatnonzero((n > 0) & (n < k)).tolist():
            whole = np.zeros(1, np.uint64)
            for i in range(at[t], at[t + 1]):
                whole = mix(whole + hashed[i : i + 1] * _ODD + np.uint64(i - at[t] + 1001))
            flat[begin[t]] = whole[0]
        yield distinct(flat, begin)


def shingle_sets(texts: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """Per text its list of shingle_lists()."""
    for flat, begin in shingle_lists(texts, k):
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            yield flat[a:b]


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits for a set, as two signed longs."""
    a, b = mix(s + _ODD), mix(s ^ _BASE)
    key = mix(np.array([a.sum() + np.uint64(len(s)), b.sum() ^ np.uint64(len(s))], np.uint64)).astype(np.int64)
    return int(key[0]), int(key[1])


def _ends_cut(a: str, b: str) -> tuple[str, str]:
    """Two strings without what they begin and end with alike; the shorter one first."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:  # longest common prefix by halving
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b = a[lo:], b[lo:]
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] == b[len(b) - mid :] else (lo, mid - 1)
    a, b = a[: len(a) - lo], b[: len(b) - lo]
    return (a, b) if len(a) <= len(b) else (b, a)


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 if it is above most.

    Common ends are cut first; the rest runs bit-parallel over the shorter string as one large integer,
    so that its cost is the length of the longer string times a few word operations.
    """
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    a, b = _ends_cut(a, b)
    m = len(a)
    if not m:
        return min(len(b), most + 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for left, c in enumerate(b):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score - (len(b) - left - 1) > most:
            return most + 1
        ph = (ph << 1 | 1) & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return score


FEW = 48  # pairs up to which one after another is faster
ABREAST = 1024  # pairs that are compared side by side
TABLE_BYTES = 16 << 20  # of the bits of their characters
CHECKED = 16  # characters after which pairs that are too far apart leave


def edits_within(one: list[str], two: list[str], most: list[int]) -> np.ndarray:
    """Whether the Levenshtein distance of each pair one[i], two[i] is at most most[i].

    Pairs whose shorter strings, common ends cut, take equally many words of 64 bits run side by side.
    """
    out = np.zeros(len(one), bool)
    groups: dict[int, list[tuple[str, str, int]]] = {}
    for i, (a, b, limit) in enumerate(zip(one, two, most, strict=True)):
        if abs(len(a) - len(b)) <= limit:
            a, b = _ends_cut(a, b)
            if len(b) <= limit:
                out[i] = True
            else:
                groups.setdefault(-(-len(a) // 64), []).append((a, b, i))
    for width, pairs in groups.items():
        if len(pairs) <= FEW or not width:
            for a, b, i in pairs:
                out[i] = edit_distance(a, b, most[i]) <= most[i]
            continue
        pairs.sort(key=lambda p: -len(p[1]))
        codes = np.frombuffer("".join(x for p in pairs for x in p[:2]).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.zeros(int(codes.max()) + 1, np.int64)
        letters[codes] = 1
        size = int(letters.sum()) + 1
        codes = np.cumsum(letters)[codes]  # from 1; 0 is no letter
        long = np.array([[len(a), len(b)] for a, b, _ in pairs])
        at = (np.cumsum(long) - long.ravel()).reshape(-1, 2)
        which, limit = np.array([i for *_, i in pairs]), np.array([most[i] for *_, i in pairs])
        step = max(1, min(ABREAST, TABLE_BYTES // (8 * size * width)))
        for k in range(0, len(pairs), step):
            part = slice(k, k + step)
            out[which[part]] = _abreast(codes, at[part], long[part], limit[part], width, size)
    return out


def _abreast(codes: np.ndarray, at: np.ndarray, long: np.ndarray, most: np.ndarray, width: int, size: int) -> np.ndarray:
    """edits_within() of pairs of runs of codes, longest second run first; the bits of the first ones are in columns of width words."""
    n, (m, end) = len(at), long.T
    bits = np.zeros((width, n * size), np.uint64)
    row = np.arange(n) * size
    for j in range(int(m.max())):
        has = np.flatnonzero(m > j)
        bits[j // 64, row[has] + codes[at[has, 0] + j]] |= np.uint64(1 << (j % 64))
    one, high, last = np.uint64(1), np.uint64(63), ((m - 1) % 64).astype(np.uint64)
    pv, mv = np.full((width, n), ~np.uint64(0)), np.zeros((width, n), np.uint64)
    score, which, begin, out = m.copy(), np.arange(n), at[:, 1].copy(), np.zeros(n, bool)
    for t in range(int(end[0])):
        if t % CHECKED == 0 or end[-1] == t:
            over = end == t
            out[which[over]] = score[over] <= most[over]
            stay = ~over & (score - (end - t) <= most)
            if not stay.all():
                score, which, begin, end, most, row, last = (x[stay] for x in (score, which, begin, end, most, row, last))
                pv, mv = pv[:, stay], mv[:, stay]
            if not len(which):
                return out
        here = row + codes[begin + t]
        plus, minus = np.ones(len(which), np.uint64), np.zeros(len(which), np.uint64)  # what the block below hands on
        for w in range(width):
            eq, p, q = bits[w, here], pv[w], mv[w]
            xv = eq | q
            eq |= minus
            xh = (((eq & p) + p) ^ p) | eq
            ph = q | ~(xh | p)
            mh = p & xh
            if w == width - 1:
                score += ((ph >> last) & one).astype(np.int64) - ((mh >> last) & one).astype(np.int64)
            up, down = ph >> high, mh >> high
            ph = (ph << one) | plus
            pv[w] = (mh << one) | minus | ~(xv | ph)
            mv[w] = ph & xv
            plus, minus = up, down
    out[which] = score <= most
    return out


def edit_similar(a: str, b: str, least: float) -> float:
    """1 - distance / longer length if that is least or more, else 0."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int(longer * (1 - least) + 1e-9)
    d = edit_distance(a, b, most)
    return 1 - d / longer if d <= most else 0.0


def edit_search(pattern: str, text: str) -> tuple[int, int]:
    """The smallest edit distance of pattern to any part of text, and where that part ends."""
    at = text.find(pattern)
    if at >= 0:
        return 0, at + len(pattern)
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        if score < best:
            best, end = score, i + 1
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best, end
