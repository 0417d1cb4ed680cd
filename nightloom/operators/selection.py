"""Choosing rows and columns: star queries over a keyword catalog, header matches, classification, outliers."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Star:
    """A base table and satellites that share its key; every keyword belongs to one table."""

    key: str
    base: DataFrame
    satellites: dict[str, DataFrame] = field(default_factory=dict)

    def keywords(self) -> dict[str, str]:
        """Keyword -> table; the base comes first, a keyword stays with the first table that has it."""
        out = {c: "base" for c in self.base.columns}
        for name, df in self.satellites.items():
            for c in df.columns:
                out.setdefault(c, name)
        return out

    def select(self, columns: list[str] | str | None = None, *filters: Column, uses: list[str] | None = None, always: list[str] | None = None) -> DataFrame:
        """LEFT JOINs only the tables that the columns and filters need, filters, and orders the columns as asked.

        Unknown columns are left out; None and '*' ask for all.  uses names the keywords that filters refer to.
        """
        owner = self.keywords()
        wanted = list(owner) if columns in (None, "*") else [c for c in columns if c in owner]
        needed = {owner[c] for c in [*wanted, *(uses or [])] if c in owner} | set(always or [])
        df = self.base
        for name, other in self.satellites.items():
            if name in needed:
                new = [c for c in other.columns if c == self.key or owner[c] == name]
                df = df.join(other.select(*new), self.key, "left")
        for f in filters:
            df = df.filter(f)
        return df.select(*wanted)


def any_like(c: Column, parts: list[str]) -> Column:
    """Contains any of the parts, in which % and _ are wildcards."""
    return reduce(lambda a, b: a | b, [c.like(f"%{p}%") for p in parts], F.lit(False))


def quality(passed: list[str] = (), failed: list[str] = (), not_passed: list[str] = (), not_failed: list[str] = ()) -> Column:
    """Three-valued quality flags: passed and failed leave out unknown ones, their negations keep them."""
    terms = [F.col(c) for c in passed] + [~F.col(c) for c in failed] + [~F.coalesce(F.col(c), F.lit(False)) for c in not_passed] + [F.coalesce(F.col(c), F.lit(True)) for c in not_failed]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def extra(conditions: list[str], joined: str = "AND") -> Column:
    """SQL conditions over the columns, all or any of which must hold."""
    return reduce((lambda a, b: a & b) if joined.upper() == "AND" else (lambda a, b: a | b), [F.expr(c) for c in conditions])


def within_limits(df: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows inside (least, most), both exclusive, for those limited columns that the table has; nulls go."""
    for c, (least, most) in limits.items():
        if c in df.columns:
            df = df.filter((F.lit(True) if least is None else F.col(c) > least) & (F.lit(True) if most is None else F.col(c) < most))
    return df


def header_equal(wanted: dict[str, str]) -> Column:
    """All keywords equal the wanted values, case and outer blanks aside."""
    return reduce(lambda a, b: a & b, [F.lower(F.trim(F.col(k).cast("string"))) == v.strip().lower() for k, v in wanted.items()], F.lit(True))


def header_at_most(limits: dict[str, float]) -> Column:
    """All keywords are numbers up to their limits."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(k).try_cast("double") <= v, F.lit(False)) for k, v in limits.items()], F.lit(True))


def first_match(files: DataFrame, ids: DataFrame, path: str, key: str, bucket: Column, id_bucket: Column, order: list[str]) -> DataFrame:
    """For each id the first file whose path contains it; both sides share a bucket that the id tells.

    A bucket should hold the files of few ids: all its files stand against all its ids.
    """
    pairs = files.withColumn("_b", bucket).join(ids.withColumn("_b", id_bucket), "_b").filter(F.contains(F.col(path), F.col(key)))
    return pairs.groupBy(key).agg(F.min_by(F.col(path), F.struct(*order)).alias(path))


def classified(rules: list[tuple[str, Column]], fallback: Column | None = None) -> Column:
    """The name of the first rule that holds, else the fallback."""
    out = fallback if fallback is not None else F.lit(None).cast("string")
    for name, rule in reversed(rules):
        out = F.when(rule, F.lit(name)).otherwise(out)
    return out


def present(names_by_size: dict[str, str]) -> Column:
    """The names of those products whose size column is above 0."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit(0)) > 0, F.lit(n)) for n, c in names_by_size.items()]))


def good_darks(wanted: dict[str, str], exposure: str, least: float) -> Column:
    """Header match and an exposure of at least so long."""
    return header_equal(wanted) & F.coalesce(F.col(exposure).try_cast("double") >= least, F.lit(False))


def good_biases(wanted: dict[str, str], shutters: list[str], elapsed: str, most: float) -> Column:
    """Header match, every shutter closed, and an elapsed time of at most so long."""
    closed = reduce(lambda a, b: a & b, [F.coalesce(F.contains(F.col(c).cast("string"), F.lit("closed")), F.lit(False)) for c in shutters], F.lit(True))
    return header_equal(wanted) & closed & F.coalesce(F.col(elapsed).try_cast("double") <= most, F.lit(False))


def good_arclamps(df: DataFrame, wanted: dict[str, str], lamp: str) -> tuple[DataFrame, DataFrame]:
    """Rows that match the header, and the distinct lamps among them."""
    rows = df.filter(header_equal(wanted))
    return rows, rows.select(F.trim(F.col(lamp)).alias("lamp")).distinct()
