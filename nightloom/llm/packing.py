"""Hierarchical multi-length packing.

Documents are tokenised and routed by length to context-size tiers.  Each tier packs its own windows; the gaps
of long windows are filled with whole documents of shorter tiers before a document is cut, and a cut fills its
window exactly.  Sequences of one length are numbered over all tasks, and step groups are runs of them with equal
token counts; only the last group of a length is shorter.

A task packs the documents it reads.  What stays open at its end, less than the sum of the windows, travels on
as token ids; the tails of many tasks are packed together, and the last of them are cut at powers of two.

Defined results: a null text counts as empty and yields only the closing id; rows that repeat a doc_id are
separate documents; a document of any length is kept whole in order over its pieces; extra columns are not
used; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

WINDOWS = (512, 1024, 2048, 4096)
END_ID = 2
STEP_TOKENS = 16 * 4096
POOL = 64  # windows' worth of documents that wait in a tier
BROADCAST_ROWS = 200_000  # counts of 24 bytes each
TAILS = 64  # tasks whose tails are packed together
CACHED = 1_200_000  # words that a worker remembers, about 200 bytes each
#: Words by which a tokenizer shows how it treats white space, capitals and closing marks.
PROBES = "the House of 1234 unbelievably naïve straße I'm x-ray A.B. 3.14 e-mail@example.org HELLO wörld ärger éclair ñandú 東京 12,5 (see) #tag __init__ don't".split()
_WORD = re.compile(r"[^ \t\n\r\f\v]+")


class WordTokenizer:
    """Token ids of whole texts.

    If the tokenizer never joins across white space, which is asked of it by PROBES, each distinct word is encoded once per worker and its ids are kept; texts are then joined from them.  New
    words are encoded many at a time with a special token between them, at whose id the result is cut.  Texts are
    encoded as they are otherwise.
    """

    def __init__(self, path: str, between: str = "<|startoftext|>"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.plain, self.marked = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.between, self.between_id = between, self.marked.token_to_id(between)
        self.known: dict[str, bytes] = {}

        self.by_word, self.by_mark = self.splits(), self.lowers()

    def whole(self, text: str) -> list[int]:
        return self.plain.encode(text, add_special_tokens=False).ids

    def splits(self) -> bool:
        """Whether the ids of probes are those of their words, and the special token only stands between."""
        if self.between_id is None:
            return False
        joined = lambda w: [i for x in w for i in self.whole(x)]
        marked = self.marked.encode(self.between.join(PROBES), add_special_tokens=False).ids
        cut = [i for i in marked if i != self.between_id] == joined(PROBES) and marked.count(self.between_id) == len(PROBES) - 1
        return cut and all(self.whole(space.join(PROBES)) == joined(PROBES) for space in (" ", "  ", "\n", " \t\r\n"))

    def lowers(self) -> bool:
        """Whether ASCII capitals and a closing mark change nothing but add the mark's own ids."""
        low = all(self.whole(w) == self.whole(w.lower()) for p in PROBES for w in (p.upper(), p.capitalize()) if w.isascii())
        return low and all(self.whole(w + m) == self.whole(w) + self.whole(m) for w in PROBES if w[-1].isalnum() for m in ".,")

    def learn(self, words: list[str]) -> None:
        """Adds the words; one that only adds a closing mark or ASCII capitals to another is taken from that, if the tokenizer allows it."""
        if not self.by_mark:
            self.encode_new(words)
            return
        known, base = self.known, {}
        for w in words:
            if w[-1] in ".," and w[-2:-1].lower().isalnum():
                base[w] = w[:-1].lower() if w.isascii() else w[:-1], w[-1]
            elif w.isascii() and (low := w.lower()) != w:
                base[w] = low, ""
        plain = {b for b, _ in base.values()} | {m for _, m in base.values() if m}
        plain.update(w for w in words if w not in base)
        self.encode_new([w for w in plain if w not in known])
        for w, (b, mark) in base.items():
            known[w] = known[b] + known[mark] if mark else known[b]

    def encode_new(self, words: list[str]) -> None:
        odd = [w for w in words if "<|" in w or len(w) > 1000]
        for w in odd:
            self.known[w] = np.array(self.plain.encode(w, add_special_tokens=False).ids, np.uint32).tobytes()
        if odd:
            words = [w for w in words if w not in self.known]
        runs = [words[at : at + 200] for at in range(0, len(words), 200)]
        for at in range(0, len(runs), 100):
            some = runs[at : at + 100]
            for run, e in zip(some, self.marked.encode_batch_fast([self.between.join(r) for r in some], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.uint32)
                raw, cut = ids.tobytes(), (np.flatnonzero(ids == self.between_id) * 4).tolist()
                self.known.update(zip(run, [raw[i:j] for i, j in zip([0] + [c + 4 for c in cut], [*cut, len(raw)], strict=True)], strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(e.ids, np.uint32) for e in self.plain.encode_batch(texts, add_special_tokens=False)]
        found = [_WORD.findall(t) for t in texts]
        new = list(set().union(*found).difference(self.known)) if found else []
        if len(self.known) + len(new) > CACHED:
            self.known = {}
            new = list(set().union(*found))
        self.learn(new)
        known = self.known
        out = [np.frombuffer(b"".join([known[w] for w in words]), np.uint32) for words in found]
        for w in [w for w in new if len(w) > 64]:
            del known[w]
        return out


@lru_cache(4)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class Piece:
    """A run of one document's ids that has not been placed yet."""

    __slots__ = ("doc_id", "ids", "start", "total")

    def __init__(self, doc_id, start: int, ids: np.ndarray, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.ids[:n], self.total), Piece(self.doc_id, self.start + n, self.ids[n:], self.total)


class Packer:
    """Packs the pieces of one task.  Closed sequences come out of take() as rows."""

    def __init__(self, base: int, windows: tuple[int, ...] = WINDOWS):
        self.windows, self.base = tuple(sorted(windows)), base
        self.pools: dict[int, list] = {w: [] for w in self.windows}
        self.weight = dict.fromkeys(self.windows, 0)
        self.open: dict[int, list[Piece]] = {w: [] for w in self.windows}
        self.room = {w: w for w in self.windows}
        self.closed, self.per_window = 0, {}
        self.rows: list[tuple] = []
        self.serial = 0

    def close(self, pieces: list[Piece], window: int) -> None:
        nth = self.per_window.get(window, 0)
        self.per_window[window] = nth + 1
        offset = 0
        for p in pieces:
            self.rows.append((p.doc_id, p.start, len(p.ids), p.ids, p.total, (self.base << 30) | self.closed, offset, window, nth))
            offset += len(p.ids)
        self.closed += 1

    def add(self, doc_id, ids: np.ndarray) -> None:
        piece = Piece(doc_id, 0, ids, len(ids))
        longest = self.windows[-1]
        while len(piece.ids) >= longest:
            head, piece = piece.cut(longest)
            self.close([head], longest)
        if len(piece.ids):
            self.route(piece)

    def route(self, piece: Piece) -> None:
        w = next(w for w in self.windows if len(piece.ids) <= w)
        self.serial += 1
        insort(self.pools[w], (len(piece.ids), self.serial, piece))
        self.weight[w] += len(piece.ids)
        if self.weight[w] >= POOL * w:
            self.flush(w)

    def pop_fitting(self, window: int, room: int) -> Piece | None:
        """The longest waiting document of a shorter tier that fits."""
        for w in reversed([x for x in self.windows if x < window]):
            pool = self.pools[w]
            at = bisect_right(pool, (room, float("inf")))
            if at:
                n, _, piece = pool.pop(at - 1)
                self.weight[w] -= n
                return piece
        return None

    def place(self, w: int, piece: Piece) -> None:
        self.open[w].append(piece)
        self.room[w] -= len(piece.ids)
        if not self.room[w]:
            self.close(self.open[w], w)
            self.open[w], self.room[w] = [], w

    def flush(self, w: int) -> None:
        """Packs the waiting documents of one tier, longest first."""
        pool, self.pools[w], self.weight[w] = self.pools[w], [], 0
        while pool:
            _, _, piece = pool.pop()
            if len(piece.ids) > self.room[w]:
                at = bisect_right(pool, (self.room[w], float("inf")))
                if at:  # a shorter one of the same tier fits
                    pool.append((len(piece.ids), 0, piece))
                    _, _, piece = pool.pop(at - 1)
                else:
                    while self.room[w] < w and (filler := self.pop_fitting(w, self.room[w])) is not None:
                        self.place(w, filler)
                        if self.room[w] == w:
                            break
            if len(piece.ids) > self.room[w]:
                head, piece = piece.cut(self.room[w])
                self.place(w, head)
            self.place(w, piece)

    def rest(self) -> list[Piece]:
        """Packs what waits and gives back the pieces of windows that stay open, the long ones first."""
        for w in reversed(self.windows):
            self.flush(w)
        return [p for w in reversed(self.windows) for p in self.open[w]]

    def cut_up(self, pieces: list[Piece], sizes: Iterator[int]) -> list[Piece]:
        """Concatenates pieces and cuts them into full sequences of the sizes given, while they suffice."""
        left = sum(len(p.ids) for p in pieces)
        queue = pieces[::-1]
        for size in sizes:
            while left >= size:
                left -= size
                now, need = [], size
                while need:
                    p = queue.pop()
                    if len(p.ids) > need:
                        p, later = p.cut(need)
                        queue.append(later)
                    now.append(p)
                    need -= len(p.ids)
                self.close(now, size)
        return queue[::-1]

    def take(self) -> list[tuple]:
        out, self.rows = self.rows, []
        return out


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "window", "nth"]
PIECES = "doc_id long, start long, length long, ids_crc32 long, ids binary, doc_tokens long, sequence_id long, offset long, window int, nth long"


def _batch(rows: list[tuple], ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in NAMES]
    raw = [np.ascontiguousarray(x, "<u4").tobytes() for x in cols[3]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array(raw if ids else [None] * len(raw), pa.binary()),
            pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64()), pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.int64()),
        ],
        ["doc_id", "start", "length", "ids_crc32", "ids", "doc_tokens", "sequence_id", "offset", "window", "nth"],
    )


def pack(docs: DataFrame, tokenizer: str, windows: tuple[int, ...] = WINDOWS, end_id: int = END_ID, step_tokens: int = STEP_TOKENS, ids: bool = True) -> DataFrame:
    """One row per piece of a document: where it starts there, its length, ids, sequence, offset, window and step group.

    ids (little-endian unsigned 32-bit) is null if ids is False; ids_crc32 is always filled.  sequence_id of a
    window shorter than its ids' sequence never occurs: every sequence but the last ones is full.
    """
    windows = tuple(sorted(windows))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), windows)
        words = word_tokenizer(tokenizer)
        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            for at in range(0, len(doc_ids), 512):
                texts = [t or "" for t in batch["text"].slice(at, 512).to_pylist()]
                for doc_id, found in zip(doc_ids[at : at + 512], words.encode(texts), strict=True):
                    packer.add(doc_id, np.append(found, np.uint32(end_id)))
                if len(packer.rows) >= 2000:
                    yield _batch(packer.take(), ids)
        left = packer.cut_up(packer.rest(), windows[::-1])
        yield _batch(packer.take(), ids)
        if left:  # tails have no sequence yet and always carry their ids
            yield _batch([(p.doc_id, p.start, len(p.ids), p.ids, p.total, None, n, packer.base // TAILS, None) for n, p in enumerate(left)], True)

    def tails(key, table):
        pieces = [((r["doc_id"] is None, r["doc_id"] or 0, r["start"]), Piece(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"])) for r in table.to_pylist()]
        pieces.sort(key=lambda x: x[0])
        packer = Packer((1 << 30) | key[0].as_py(), windows)
        packer.cut_up([p for _, p in pieces], [1 << k for k in range(windows[-1].bit_length() - 1, -1, -1)])
        return pa.Table.from_batches([_batch(packer.take(), ids)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, PIECES)
    work = Workspace(docs.sparkSession, "packing")
    rows = work.keep(rows, "pieces")
    ends = work.keep(rows.filter("sequence_id is null").groupBy("window").applyInArrow(tails, PIECES), "tails")
    return step_groups(rows.filter("sequence_id is not null").unionByName(ends), work, step_tokens)


def step_groups(pieces: DataFrame, work: Workspace, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """The pieces with step_group in place of nth, which numbers the sequences of one task and window only."""
    task = F.shiftright("sequence_id", 30)
    counts = work.keep(pieces.groupBy(task.alias("task"), "window").agg((F.max("nth") + 1).alias("n")), "counts")  # a row for each task and window
    before = Window.partitionBy("window").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("task", "window", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    side = F.broadcast(begins) if counts.count() <= BROADCAST_ROWS else begins
    step = F.floor((F.col("begin") + F.col("nth")) / F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("window"))))
    placed = pieces.withColumn("task", task).join(side, ["task", "window"])
    group = F.col("window").cast("long") * F.lit(1 << 40) + step
    return placed.select(*[c for c in pieces.columns if c != "nth"], group.alias("step_group"))
