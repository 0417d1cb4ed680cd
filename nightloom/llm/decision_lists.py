"""Quality rules: a decision list learned from labels by sequential covering, applied as one conditional expression.

Counts of a whole text become levels, whole numbers from 0 to TOP that say how much of something there is.  A rule is
a conjunction of thresholds on levels.  It grows by the condition with the highest FOIL gain on two thirds of the
labelled rows, is cut back to the beginning that does best on the other third, and is taken into the list if it is
precise enough; the rows that it covers leave, and the next rule is grown on the rest.  The rules in their order are
the branches of a Spark `CASE WHEN`.

All statistics are counts by (level's name, level, label, part), grouped by Spark over all labelled rows, so that what
reaches the driver is bounded by the number of levels.  Everything is DataFrame expressions.

A window of eight words that stands twice is found by its hash and then by the words themselves; texts in which no hash
repeats are done with that.

Defined results: null texts count as empty, which fails the base rules; rows that repeat a doc_id are judged each;
labels that are null, or differ for one doc_id, or whose document fails the base rules, are not learned from; without
labels of both kinds, or without rows, the list is empty and the base rules decide alone; extra columns are not used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8  # words
TOP = 250  # highest level
RULES, CONDITIONS = 12, 3  # at most, in a list and in a rule
PRECISION, SUPPORT = 0.9, 5  # of a rule that is taken: share of bad rows (Laplace), and rows covered

#: Level -> the share of which it is the TOP-fold, or a size; columns of text_counts().
LEVELS: dict[str, Callable[[], Column]] = {
    "length": lambda: 10 * F.log2(F.lit(1.0) + F.col("n_words")),
    "word_length": lambda: 10 * ratio("word_chars", "n_words"),
    "symbols": lambda: TOP * ratio("n_symbols", "word_chars"),
    "capitals": lambda: TOP * ratio("n_capitals", "word_chars"),
    "digits": lambda: TOP * ratio("n_digits", "word_chars"),
    "exclamations": lambda: TOP * ratio("n_exclamations", "word_chars"),
    "stops": lambda: TOP * ratio("n_stops", "word_chars"),
    "repeated_lines": lambda: TOP * ratio("n_dup_lines", "n_lines"),
    "repeated_words": lambda: TOP * ratio("n_repeat_words", "n_words"),
    "echoes": lambda: TOP * ratio("n_echoes", "n_words"),
}


def ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once and only where the result is asked for."""
    return F.transform(F.array(value), use)[0]


def removed(text: Column, pattern: str) -> Column:
    """How many characters the pattern takes."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(words: Column, hashes: Column) -> Column:
    """Words that lie in a window whose words stand at two or more places of the text."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

    def flagged(s: Column) -> Column:
        return F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1)))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.slice(words, i + 1, F.lit(WINDOW)).alias("w"), i.alias("i")))
    places = let(F.sort_array(placed), lambda s: F.sort_array(F.transform(flagged(s), lambda x: x["i"])))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(places, covered)).cast("long")


def windows(words: Column) -> Column:
    """A hash of each window of WINDOW words, in their order."""
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, WHITE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rest = F.regexp_replace(text, r"[\p{Ll}\x20\x09-\x0D]+", "")  # what the rarer signs are counted in

    def counted(words: Column, lines: Column, rest: Column) -> Column:
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": removed(rest, SYMBOLS),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": let(windows(words), lambda hashes: repeated_words(words, hashes)),
            "n_lines": F.size(lines),
            "n_echoes": F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))),
            "n_capitals": removed(rest, r"\p{Lu}+"),
            "n_digits": removed(rest, "[0-9]+"),
            "n_exclamations": removed(rest, "[!?]+"),
            "n_stops": removed(rest, "[.,;:]+"),
        }
        return F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])

    all_counts = let(words, lambda w: let(lines, lambda n: let(rest, lambda r: counted(w, n, r))))
    return docs.select("doc_id", all_counts.alias("counts")).select("doc_id", "counts.*")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def levels() -> list[Column]:
    return [F.least(F.floor(f()), F.lit(TOP)).cast("int").alias(k) for k, f in LEVELS.items()]


@dataclass(frozen=True)
class Condition:
    level: str
    least: bool  # whether the bound is a least level, else it is the first one too high
    bound: int

    def holds(self) -> Column:
        return F.col(self.level) >= self.bound if self.least else F.col(self.level) < self.bound

    def __str__(self) -> str:
        return f"{self.level} {'>=' if self.least else '<'} {self.bound}"


@dataclass(frozen=True)
class Rule:
    """Bad where all conditions hold; the bad and good labelled rows that it covered when it was learned."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def holds(self) -> Column:
        out = self.conditions[0].holds()
        for c in self.conditions[1:]:
            out = out & c.holds()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f"  ({self.bad} bad, {self.good} good)"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = ()

    def number(self) -> Column:
        """The number of the first rule that holds, from 1; 0 if none does."""
        out = F.lit(0)
        for k in range(len(self.rules), 0, -1):
            out = F.when(self.rules[k - 1].holds(), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(map(str, self.rules))


def statistics(rows: DataFrame) -> np.ndarray:
    """counts[level's place in LEVELS, level, 1 if bad, 1 if for pruning], grouped by Spark."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f).alias("level")) for k, f in enumerate(LEVELS)]))
    counted = rows.select("bad", "prune", cells.alias("c")).groupBy("c.k", "c.level", "bad", "prune").count()
    out = np.zeros((len(LEVELS), TOP + 1, 2, 2), np.int64)
    for k, level, bad, prune, n in counted.collect():  # at most len(LEVELS) * (TOP + 1) * 4 rows
        out[k, level, bad, prune] = n
    return out


def best_condition(counts: np.ndarray) -> tuple[Condition, np.ndarray] | None:
    """The condition of the highest FOIL gain on the growing part, and what it covers: [1 if bad, 1 if for pruning]."""
    total = counts[0].sum(axis=0)
    bad, good = total[1, 0], total[0, 0]
    if not bad or not good:
        return None
    below = np.concatenate([np.zeros((len(LEVELS), 1, 2, 2), np.int64), counts.cumsum(axis=1)], axis=1)[:, : TOP + 1]
    covered = np.stack([below, total - below], axis=1)  # [level's place, 1 if least, bound]
    p, n = covered[..., 1, 0], covered[..., 0, 0]
    share = np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1)) - np.log2(bad / (bad + good))
    gain = np.where(p >= SUPPORT, p * share, 0.0)
    if gain.max() <= 1e-9:
        return None
    k, least, bound = (int(x) for x in np.unravel_index(gain.argmax(), gain.shape))
    # of neighbouring bounds that cover the same rows the middle one
    last = bound
    while last < TOP and (covered[k, least, last + 1] == covered[k, least, bound]).all():
        last += 1
    bound = (bound + last + 1) // 2
    return Condition(list(LEVELS)[k], bool(least), bound), covered[k, least, bound]


def grown(rows: DataFrame) -> Rule | None:
    """A rule that is grown on one part of rows and pruned on the other; None if it is not precise enough."""
    conditions: list[Condition] = []
    covers: list[np.ndarray] = []
    while len(conditions) < CONDITIONS:
        left = rows.filter(Rule(tuple(conditions), 0, 0).holds()) if conditions else rows
        found = best_condition(statistics(left))
        if not found:
            break
        conditions.append(found[0])
        covers.append(found[1])
        if found[1][0, 0] == 0:
            break
    if not conditions:
        return None

    def worth(cover: np.ndarray) -> float:
        bad, good = cover[1, 1], cover[0, 1]
        return (bad - good) / (bad + good) if bad + good else -1.0

    size = max(range(1, len(conditions) + 1), key=lambda k: (worth(covers[k - 1]), -k))
    good, bad = (int(x) for x in covers[size - 1].sum(axis=1))
    if (bad + 1) / (bad + good + 2) < PRECISION or bad < SUPPORT:
        return None
    return Rule(tuple(conditions[:size]), bad, good)


def fit(counts: DataFrame, labels: DataFrame, work: Workspace) -> DecisionList:
    """A list learned from the rows of text_counts() whose document is labelled with quality 0 (bad) or 1."""
    named = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
    one = named.agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high")
    rows = counts.filter(~base_failed()).join(one, "doc_id").withColumn("bad", 1 - F.col("low"))
    prune = (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).cast("int").alias("prune")
    rows = work.keep(rows.select("bad", prune, *levels()), "labelled")
    rules: list[Rule] = []
    left = rows
    while len(rules) < RULES and (rule := grown(left)):
        rules.append(rule)
        left = left.filter(~rule.holds())
    work.drop(rows)
    return DecisionList(tuple(rules))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, the rule that took the document (0: none) and whether it is kept."""
    work = Workspace(docs.sparkSession, "rules")
    counts = work.keep(text_counts(docs), "counts")
    rules = fit(counts, labels, work)
    names = [c for c in counts.columns if c != "doc_id"]
    out = counts.select("doc_id", *names, base_failed().alias("base_failed"), *levels())
    out = out.withColumn("rule", F.when(F.col("base_failed"), F.lit(0)).otherwise(rules.number()))
    return out.select("doc_id", *names, "base_failed", "rule", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"))
