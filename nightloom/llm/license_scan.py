"""Licence scan: text units against licence templates by Dice's coefficient over word bigrams.

Texts are cut into pieces at line breaks and at the ends of sentences.  Units are pieces, runs of neighbouring pieces
that look like a licence (a notice that is wrapped, or the body of a licence inside a longer text), once across blank
lines and once within paragraphs, and whole documents that are short enough.  A piece looks like a licence if half of its bigrams
and half of its words stand in some template; other units need the words.  Units are normalised (lower case, letters and digits only) and compared as sets of bigrams:
Dice = 2 * common / (unit's + template's).  Dice >= t bounds the sizes, so that a unit of n bigrams can only match
templates of n * t / (2 - t) to n * (2 - t) / t bigrams: templates are looked up by size.  It also takes
t / 2 * (1 + t / (2 - t)) of the unit's bigrams to be the template's, so a unit with fewer known ones is never scored.

Everything is DataFrame expressions.  Defined results: null and empty texts have no unit; pieces of one word are no
units and end no run; equal scores go to the first licence by name; rows that repeat a doc_id are scanned
each; extra columns are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

LEAST = 0.75
LIKE = 0.5  # share of a unit's words, and of a piece's bigrams, that the templates have where it looks like a licence

#: Licence -> notices by which a text declares it, and its body where that is short.
TEMPLATES: dict[str, list[str]] = json.loads((Path(__file__).parent / "licences.json").read_text())


def normalised(text: Column) -> Column:
    """Lower case; everything but letters and digits becomes one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def words_of(text: Column) -> Column:
    """The words of normalised(text), in one pass."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def bigrams(words: Column) -> Column:
    """The set of word bigrams of an array of words; a single word is its own gram."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(n < 2, words).otherwise(pairs))


def once(column: Column) -> Column:
    """The column as the one row of a generator: what follows refers to its value instead of repeating the expression."""
    return F.explode(F.array(column))


def template_grams(docs: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """(license_id, grams, n_grams) of each template."""
    named = docs.sparkSession.createDataFrame([(k, t) for k, v in sorted(templates.items()) for t in v], "license_id string, template string")
    return named.select("license_id", bigrams(words_of(F.col("template"))).alias("grams")).withColumn("n_grams", F.size("grams"))


def templates_by_size(named: DataFrame, least: float) -> DataFrame:
    """(n, [(license_id, grams, n_grams)]) for every unit size n that a template fits: as many rows as templates have admissible sizes."""
    low, high = F.ceil(F.col("n_grams") * least / (2 - least)).cast("int"), F.floor(F.col("n_grams") * (2 - least) / least).cast("int")
    sized = named.withColumn("n", F.explode(F.sequence(low, high)))
    return sized.groupBy("n").agg(F.sort_array(F.collect_list(F.struct("license_id", "grams", "n_grams"))).alias("fitting"))


def known_share(grams: Column, known: list[str]) -> Column:
    return F.size(F.filter(grams, lambda g: g.isin(known))) / F.size(grams)


SENTENCE = "\x01"  # stands between the sentences of a line


def pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, nth, at, line, unit) for each piece of two words or more: its number among those, among all pieces, and its line."""
    marked = F.regexp_replace("text", r"([.!?;])[\x20\t]+", "$1" + SENTENCE)
    cut = F.flatten(F.transform(F.split(marked, "\n"), lambda whole, line: F.transform(F.split(whole, SENTENCE), lambda unit: F.struct(line.alias("line"), unit.alias("unit")))))
    worded = F.filter(F.transform(cut, lambda p, at: F.struct(at.alias("at"), p["line"].alias("line"), p["unit"].alias("unit"))), lambda p: p["unit"].rlike(r"[\p{L}\p{N}][^\p{L}\p{N}]+[\p{L}\p{N}]"))
    rows = docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.posexplode(worded).alias("nth", "p"))
    return rows.select("doc_id", "text_key", "nth", "p.at", "p.line", "p.unit")


def licence_matches(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, line, license_id, dice, unit) for each unit that matches, and the line where it begins; -1 is a whole short document."""
    named = template_grams(docs, templates)
    known = sorted({g for r in named.select("grams").collect() for g in r["grams"]})  # the templates' bigrams
    most = max((r[0] for r in templates_by_size(named, least).select("n").collect()), default=0)
    need = least / 2 * (1 + least / (2 - least)) - 1e-9

    known_words = sorted({w for g in known for w in g.split(" ")})

    def with_grams(units: DataFrame, bounded: bool) -> DataFrame:
        """Units with their bigrams, those of which LIKE of the words are known at all.

        bounded: each distinct word but the first brings a bigram of its own, so words bound the size from below.
        """
        units = units.withColumn("words", once(words_of(F.col("unit"))))
        units = units.filter(F.size(F.array_distinct("words")) <= most + 1) if bounded else units
        units = units.filter((F.size("words") > 0) & (known_share(F.col("words"), known_words) >= LIKE))
        units = units.withColumn("grams", once(bigrams(F.col("words")))).drop("words").withColumn("n", F.size("grams"))
        return units.withColumn("share", once(known_share(F.col("grams"), known)))

    work = Workspace(docs.sparkSession, "licences")
    like = work.keep(with_grams(pieces(docs), False).filter(F.col("share") >= LIKE), "like")  # read for units and for runs
    placed = like.select("doc_id", "text_key", "nth", "at", "line", "unit").distinct()
    over = Window.partitionBy("doc_id", "text_key").orderBy("at")
    runs = None
    for place in ("nth", "at"):  # without and with the blank pieces, which end a run
        run = placed.withColumn("run", F.col(place) - F.row_number().over(over)).groupBy("doc_id", "text_key", "run")
        one = run.agg(F.sort_array(F.collect_list(F.struct("at", "line", "unit"))).alias("all")).filter(F.size("all") > 1)  # pieces of one document
        one = one.select("doc_id", "text_key", F.col("all")[0]["line"].alias("line"), F.array_join(F.transform("all", lambda x: x["unit"]), " ").alias("unit"))
        runs = one if runs is None else runs.unionByName(one)
    whole = docs.filter(F.instr("text", "\n") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.lit(-1).alias("line"), F.col("text").alias("unit"))
    more = with_grams(runs.unionByName(whole), True)
    columns = ["doc_id", "line", "unit", "grams", "n", "share"]
    units = like.select(*columns).unionByName(more.select(*columns)).filter(F.col("share") >= need)
    near = units.join(F.broadcast(templates_by_size(named, least)), "n")  # a row per admissible size of the templates
    score = F.transform("fitting", lambda t: F.struct((F.lit(2.0) * F.size(F.array_intersect(F.col("grams"), t["grams"])) / (F.col("n") + t["n_grams"])).alias("dice"), t["license_id"].alias("license_id")))
    best = F.aggregate("scores", F.struct(F.lit(-1.0).alias("dice"), F.lit("").alias("license_id")), lambda a, x: F.when((x["dice"] > a["dice"]), x).otherwise(a))
    scored = near.withColumn("scores", once(score)).withColumn("best", once(best))
    return scored.filter(F.col("best.dice") >= least).select("doc_id", "line", F.col("best.license_id").alias("license_id"), F.col("best.dice").alias("dice"), "unit")


def oracle_sql(templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> str:
    """SQL for scan_documents over documents, with every unit against every template."""
    rows = ", ".join("('" + k + "', '" + t.replace("'", "''") + "')" for k, v in sorted(templates.items()) for t in v)
    plain = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))".replace("\\\\", "\\")
    grams = "list_distinct(case when len(w) < 2 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end)"
    return f"""
        with t as (select license_id, {grams} as g from (select license_id, string_split({plain.format("t")}, ' ') as w from (values {rows}) v(license_id, t))),
        k as (select list(distinct gram) as known, list_distinct(flatten(list(string_split(gram, ' ')))) as known_words from (select unnest(g) as gram from t)),
        d as (select distinct doc_id, text from documents where text is not null),
        l as (select doc_id, text, unnest(string_split(regexp_replace(text, '([.!?;])[\\x20\\t]+', '\\1' || chr(1), 'g'), chr(10))) as whole, unnest(range(len(string_split(text, chr(10))))) as line from d),
        c as (select doc_id, text, line, unnest(string_split(whole, chr(1))) as unit, unnest(range(len(string_split(whole, chr(1))))) as k from l),
        n as (select *, row_number() over (partition by doc_id, text order by line, k) as pos from c),
        p as (select *, row_number() over (partition by doc_id, text order by pos) as nth from n where regexp_matches(unit, '[\\p{{L}}\\p{{N}}][^\\p{{L}}\\p{{N}}]+[\\p{{L}}\\p{{N}}]')),
        q as (select doc_id, text, line, unit, pos, nth, w, {grams} as g from (select *, string_split({plain.format("unit")}, ' ') as w from p)),
        e as (select * from q, k where len(list_intersect(g, known)) >= {LIKE} * len(g) and len(list_filter(w, lambda i: list_contains(known_words, i))) >= {LIKE} * len(w)),
        o as (select *, row_number() over (partition by doc_id, text order by pos) as r from e),
        u as (select doc_id, line, unit from o
              union all select doc_id, arg_min(line, pos), string_agg(unit, ' ' order by pos) from o group by doc_id, text, nth - r having count(*) > 1
              union all select doc_id, arg_min(line, pos), string_agg(unit, ' ' order by pos) from o group by doc_id, text, pos - r having count(*) > 1
              union all select doc_id, -1, text from d where contains(text, chr(10))),
        x as (select row_number() over () as id, doc_id, line, {grams} as g from (select *, string_split({plain.format("unit")}, ' ') as w from u), k where w[1] <> '' and len(list_filter(w, lambda i: list_contains(known_words, i))) >= {LIKE} * len(w)),
        s as (select id, doc_id, line, license_id, 2.0 * len(list_intersect(x.g, t.g)) / (len(x.g) + len(t.g)) as dice from x, t
              where len(x.g) between len(t.g) * {least / (2 - least)} and len(t.g) * {(2 - least) / least}),
        b as (select *, row_number() over (partition by id order by dice desc, license_id) as best from s)
        select doc_id, license_id, max(dice) as dice, count(distinct line) as n_units, min(line) as first_line
        from b where best = 1 and dice >= {least} group by doc_id, license_id"""


def scan_documents(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, license_id, dice, n_units, first_line): the licences that each document declares, and in how many lines their units begin."""
    return licence_matches(docs, templates, least).groupBy("doc_id", "license_id").agg(F.max("dice").alias("dice"), F.count_distinct("line").alias("n_units"), F.min("line").alias("first_line"))
