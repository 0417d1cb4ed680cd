"""Queries of ingest, of good calibration frames, and of checks whose metrics come from the rows themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest, quality, registry, selection
from ..sources import products
from ._common import Queries, table

Q = Queries()

#: The listing: every order is an observation, its files are as new as its date and its last shipment.
LISTING = "(select o_orderkey as obs, strftime(o_orderdate, '%Y%m%d') as datecode, o_orderdate as l0, last as l1, o_totalprice as total, o_orderpriority as priority from orders left join (select l_orderkey, max(l_shipdate) as last from lineitem group by 1) on l_orderkey = o_orderkey)"
#: The registry as it was: what is not pending, with the times of its reading.
STORED = "(select o_orderkey as obs, o_orderdate as read_l0, o_orderdate + interval 100 day as read_l1, cast(null as double) as total, 'old' as priority from orders where o_orderstatus <> 'P')"
STALE = f"(select n.* from {LISTING} n left join {STORED} s on s.obs = n.obs where coalesce(l0, timestamp '1000-01-01') > coalesce(read_l0, timestamp '1000-01-01') or coalesce(l1, timestamp '1000-01-01') > coalesce(read_l1, timestamp '1000-01-01'))"
REGISTERED = f"(select coalesce(n.obs, s.obs) as obs, case when n.obs is null then s.total else n.total end as total, case when n.obs is null then s.priority else n.priority end as priority, case when s.obs is null then 'new' when n.obs is null then 'kept' else 'updated' end as done from {STORED} s full join {STALE} n on n.obs = s.obs)"


def listing(spark, sf_dir):
    last = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs")).agg(F.max("l_shipdate").alias("l1"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs"), F.date_format("o_orderdate", "yyyyMMdd").alias("datecode"), F.col("o_orderdate").alias("l0"), F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"))
    return orders.join(last, "obs", "left")


def stored(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return orders.select(F.col("o_orderkey").alias("obs"), F.col("o_orderdate").alias("read_l0"), F.expr("o_orderdate + interval 100 days").alias("read_l1"), F.lit(None).cast("double").alias("total"), F.lit("old").alias("priority"))


def observations() -> ingest.Ingest:
    return ingest.Ingest("obs", ["l0", "l1"], ["read_l0", "read_l1"], lambda rows: rows.select("obs", F.col("l0").alias("read_l0"), F.col("l1").alias("read_l1"), "total", "priority"))


@Q.add("ingest_registry", f"select obs, total, priority, done from {REGISTERED}")
def ingest_registry(spark, sf_dir):
    """Only what is new or changed is read; its rows replace the stored ones as a whole."""
    return observations().run(listing(spark, sf_dir), stored(spark, sf_dir)).select("obs", "total", "priority", "done")


@Q.add("ingest_counts", f"select done, count(*) as n from {REGISTERED} group by 1")
def ingest_counts(spark, sf_dir):
    way = observations()
    return way.counts(way.run(listing(spark, sf_dir), stored(spark, sf_dir)))


@Q.add("ingest_forced", f"select n.obs, n.total, case when s.obs is null then 'new' else 'updated' end as done from {LISTING} n left join {STORED} s on s.obs = n.obs")
def ingest_forced(spark, sf_dir):
    """A full rescan reads everything, whatever its time."""
    return observations().run(listing(spark, sf_dir), stored(spark, sf_dir), force=True).select("obs", "total", "done")


@Q.add("ingest_dates", f"select obs, total from {STALE} where datecode between '19950101' and '19970630'")
def ingest_dates(spark, sf_dir):
    rows = ingest.in_dates(listing(spark, sf_dir), "datecode", "19950101", "19970630")
    return observations().changed(rows, stored(spark, sf_dir)).select("obs", "total")


@Q.add("ingest_ids", f"select n.obs, total from {LISTING} n where cast(obs as varchar) in (select cast(p_partkey as varchar) from part where p_size > 25)")
def ingest_ids(spark, sf_dir):
    """Ids as they stand in the first column of a list, those that look like ids."""
    ids = table(spark, sf_dir, "part").filter("p_size > 25").select(F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("id")).unionByName(spark.createDataFrame([("obs",), ("# 1",)], "id string"))
    return ingest.with_ids(listing(spark, sf_dir), ids, "obs", r"^\d+$").select("obs", "total")


MASTERS = "(select l_suppkey as cid, cast(l_shipdate as date) as startdate, max(l_quantity) as quality from lineitem group by 1, 2)"


@Q.add(
    "replace_date",
    f"""select cid, startdate, quality, 'old' as made from {MASTERS} where startdate <> date '1996-05-01'
    union all select l_suppkey, date '1996-05-01', min(l_quantity), 'new' from lineitem where l_shipdate = timestamp '1996-05-01' and l_returnflag = 'A' group by 1""",
)
def replace_date(spark, sf_dir):
    """All masters of a date are registered anew: what was registered for it goes first."""
    lines, day = table(spark, sf_dir, "lineitem"), F.lit("1996-05-01").cast("date")
    old = lines.groupBy(F.col("l_suppkey").alias("cid"), F.to_date("l_shipdate").alias("startdate")).agg(F.max("l_quantity").alias("quality")).withColumn("made", F.lit("old"))
    new = lines.filter((F.to_date("l_shipdate") == day) & (F.col("l_returnflag") == "A")).groupBy(F.col("l_suppkey").alias("cid")).agg(F.min("l_quantity").alias("quality"))
    return registry.replace_date(old, new.select("cid", day.alias("startdate"), "quality", F.lit("new").alias("made")), "startdate", day)


@Q.add("backfill_columns", "select o_orderkey, coalesce(case when o_orderstatus <> 'F' then o_totalprice end, m) as total from orders left join (select l_orderkey, max(l_extendedprice) as m from lineitem group by 1) on l_orderkey = o_orderkey")
def backfill_columns(spark, sf_dir):
    found = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("total"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("total"))
    return registry.backfilled(rows, found, ["o_orderkey"], ["total"])


@Q.add("good_darks", "select p_partkey from part where lower(trim(p_type)) = 'economy' and p_size >= 20")
def good_darks(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(selection.good_darks({"p_type": " Economy"}, "p_size", 20)).select("p_partkey")


@Q.add("good_arclamps", "select distinct trim(p_brand) as lamp from part where lower(trim(p_type)) = 'standard'")
def good_arclamps(spark, sf_dir):
    return selection.good_arclamps(table(spark, sf_dir, "part"), {"p_type": "STANDARD "}, "p_brand")[1]


@Q.add("good_biases", "select event_id from events where event_type = 'view' and user_id % 2 = 0 and user_id % 3 <> 1 and value <= 40")
def good_biases(spark, sf_dir):
    state = lambda shut, name: F.when(shut, F.lit("closed ")).otherwise("open").alias(name)
    u = F.col("user_id")
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", state(u % 2 == 0, "a"), state(u % 3 != 1, "b"), state(u % 2 == 0, "c"), state(F.lit(True), "d"), state(u % 3 != 1, "e"))
    return rows.filter(selection.good_biases({"event_type": "VIEW"}, list("abcde"), "value", 40)).select("event_id")


@Q.add(
    "qc_low_flux",
    """with f as (select l_orderkey as obs, avg(l_quantity) filter (where l_linenumber % 2 = 1) as green, avg(l_quantity) filter (where l_linenumber % 2 = 0) as red from lineitem group by 1)
    select obs, green <= 10 and red <= 10 as lowbias, green <= 11 and red <= 13 as lowdark from f where green is not null and red is not null""",
)
def qc_low_flux(spark, sf_dir):
    """Frames are orders: their odd lines are the green chip's pixels, their even lines the red chip's."""
    mean = lambda odd: F.avg(F.when(F.col("l_linenumber") % 2 == odd, F.col("l_quantity")))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs")).agg(mean(1).alias("green"), mean(0).alias("red")).filter("green is not null and red is not null")
    g, r = F.col("green"), F.col("red")
    return rows.select("obs", quality.low_flux("Bias", g, r).alias("lowbias"), quality.low_flux("Dark", g, r).alias("lowdark"))


@Q.add(
    "qc_dates",
    """with t as (select event_id, epoch_us(ts) / 1e6 as b, value as e, (user_id % 25 + 0.5) / 100.0 as d, (user_id % 30 + 0.5) / 20.0 as m from events)
    select event_id, (abs((e + d) - e) <= 0.1 and abs(d / 2) <= 0.1 and abs(m) <= 1.0) as pass from t""",
)
def qc_dates(spark, sf_dir):
    """A frame of value seconds; its end is late by the user's hundredths, the chips by half of them, the exposure meter by twentieths."""
    t = table(spark, sf_dir, "events").select("event_id", "value", ((F.col("user_id") % 25 + 0.5) / 100.0).alias("d"), ((F.col("user_id") % 30 + 0.5) / 20.0).alias("m"))
    zero, end = F.lit(0.0), F.col("value") + F.col("d")
    chips = F.col("d") / 2
    good = quality.dates_agree(zero, end / 2, end, F.col("value"), [zero + chips, zero + chips], [end, end], (chips + F.col("m"), end + F.col("m")))
    return t.select("event_id", good.alias("pass"))


@Q.add("qc_keywords", "select event_id, event_type <> 'view' and user_id % 7 <> 0 as pass from events")
def qc_keywords(spark, sf_dir):
    """A keyword that is there without a value counts, one that is not there does not."""
    u = F.col("user_id")
    entry = lambda name, there: F.when(there, F.struct(F.lit(name).alias("key"), F.lit(None).cast("string").alias("value")))
    header = F.map_from_entries(F.array_compact(F.array(entry("DATE-BEG", F.lit(True)), entry("ELAPSED", F.col("event_type") != "view"), entry("OBJECT", u % 7 != 0), entry("MORE", u % 2 == 0))))
    return table(spark, sf_dir, "events").select("event_id", quality.all_there(header, ["DATE-BEG", "ELAPSED", "OBJECT"]).alias("pass"))


@Q.add("qc_products", "select l_orderkey as obs, max(l_linenumber = 1) and max(l_linenumber = 3 and l_quantity > 5) as pass from lineitem group by 1".replace("max(", "bool_or("))
def qc_products(spark, sf_dir):
    """Expected products that are there with a size."""
    size = lambda k: F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity") - F.when(F.lit(k == 3), 5).otherwise(0)))
    sizes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs")).agg(size(1).alias("green"), size(3).alias("red"))
    return sizes.select("obs", quality.complete(F.array(F.lit("Green"), F.lit("Red")), selection.present({"Green": "green", "Red": "red"})).alias("pass"))


@Q.add(
    "qc_wild_wls",
    """with o as (select l_suppkey as obs, l_returnflag as fibre, l_linenumber as ord, stddev_pop(l_tax * 200) as s from lineitem group by 1, 2, 3) select obs, fibre, bool_and(s < 5) as pass from o group by 1, 2""",
)
def qc_wild_wls(spark, sf_dir):
    """One row for each fibre of a solution; its differences to the reference are the taxes of its lines."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("obs"), F.col("l_returnflag").alias("fibre"), F.col("l_linenumber").alias("ord"), (F.col("l_tax") * 200).alias("pixels"))
    return quality.not_wild(rows, ["obs", "fibre"], "ord", "pixels")


_P = {"90": 0.9, "95": 0.95, "98": 0.98, "99": 0.99, "99.5": 0.995}
_LISTS = ", ".join(f"quantile_cont(value{k}, {list(_P.values())}) filter (where {c} and {t}) as {a}{b}" for a, c, k in (("g", "event_id % 2 = 0", ""), ("r", "event_id % 2 = 1", " * 1.5")) for b, t in (("i", "user_id % 3 <> 0"), ("o", "user_id % 3 = 0")))


def _any(chip, first, last, limit):
    return "(" + " or ".join(f"coalesce(abs({chip}i[{k}] / nullif({chip}o[{k}], 0)) > {limit}, false)" for k in range(first, last + 1)) + ")"


@Q.add(
    "qc_flux_in_traces",
    f"""with h as (select ['ThAr', 'Etalon', 'LFC', 'Flat', 'Star', 'Sun', 'Dark'][day(ts) % 7 + 1] as source, hour(ts) as h, day(ts) as d, * from events), f as (select d, h, any_value(source) as source, {_LISTS} from h group by 1, 2)
    select d, h, source, case source
      when 'ThAr' then (not gi[4] > 50 or {_any("g", 2, 4, 2.0)}) and (not ri[3] > 50 or {_any("r", 1, 4, 1.4)})
      when 'Etalon' then gi[5] > 50 and {_any("g", 2, 5, 1.5)} and ri[5] > 50 and {_any("r", 1, 4, 1.5)}
      when 'LFC' then gi[5] > 50 and {_any("g", 2, 5, 1.5)} and ri[5] > 50 and {_any("r", 1, 4, 3.0)}
      when 'Flat' then gi[5] > 100 and {_any("g", 2, 5, 3.0)} and ri[5] > 100 and {_any("r", 1, 4, 3.0)}
      when 'Star' then (not gi[5] > 30 or {_any("g", 2, 5, 1.5)}) and (not ri[5] > 30 or {_any("r", 1, 4, 1.5)})
      when 'Sun' then (not gi[5] > 100 or {_any("g", 2, 5, 3.0)}) and (not ri[5] > 100 or {_any("r", 1, 4, 3.0)}) end as pass from f where gi is not null and ri is not null and go is not null and ro is not null""",
)
def qc_flux_in_traces(spark, sf_dir):
    """Frames are hours: even events fall on the green chip, odd ones on the red, two thirds of the users are in the traces."""
    even, inside = F.col("event_id") % 2 == 0, F.col("user_id") % 3 != 0
    source = F.get(F.array(*[F.lit(s) for s in ("ThAr", "Etalon", "LFC", "Flat", "Star", "Sun", "Dark")]), F.dayofmonth("ts") % 7)
    lists = lambda where, x: F.percentile(F.when(where, x), list(_P.values()))
    v = F.col("value")
    frames = table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").cast("long").alias("d"), F.hour("ts").cast("long").alias("h"), source.alias("source"))
    frames = frames.agg(lists(even & inside, v).alias("gi"), lists(even & ~inside, v).alias("go"), lists(~even & inside, v * 1.5).alias("ri"), lists(~even & ~inside, v * 1.5).alias("ro")).dropna()
    at = lambda c: {name: F.col(c)[i] for i, name in enumerate(_P)}
    good = quality.flux_in_traces(F.col("source"), {"green": at("gi"), "red": at("ri")}, {"green": at("go"), "red": at("ro")})
    return frames.select("d", "h", "source", good.alias("pass"))


@Q.add(
    "panel_intervals",
    """select kind, start, count(*) as n, round(avg(value), 6) as mean from (select unnest(['day', 'month', 'year', 'decade']) as kind, unnest([date_trunc('day', ts), date_trunc('month', ts), date_trunc('year', ts), date_trunc('decade', ts)]) as start, value from events) group by 1, 2""",
)
def panel_intervals(spark, sf_dir):
    """Every panel for each day, month, year and decade, in one pass."""
    begins = {k: F.date_trunc(k, "ts") for k in ("day", "month", "year")}
    begins["decade"] = F.make_timestamp(F.floor(F.year("ts") / 10) * 10, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    spans = F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("timestamp_ntz").alias("start")) for k, c in begins.items()])
    rows = table(spark, sf_dir, "events").select(F.explode(spans).alias("s"), "value")
    return rows.groupBy("s.kind", "s.start").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@Q.add("last_days", "select event_id from events where ts > (select max(ts) from events) - interval 7 day")
def last_days(spark, sf_dir):
    """The last so many days before the newest row, whose time is read first so that the filter reaches the scan."""
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts")).first()[0]
    return events.filter(F.col("ts") > F.lit(newest).cast("timestamp_ntz") - F.expr("interval 7 days")).select("event_id")


@Q.add("latest_receipt", "select l_orderkey as obs, max(l_shipdate) as latest from lineitem group by 1")
def latest_receipt(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs")).agg(F.max("l_shipdate").alias("latest"))


# extraction by a catalog


#: Columns of the registry: name, type, level, extension, keyword, table, what is made of several.
CATALOG = [
    ("exptime", "float", "L0", "PRIMARY", "EXPTIME", "tsdb_l0", "last"),
    ("is_junk", "bool", "L0", "PRIMARY", "JUNK", "tsdb_l0", "last"),
    ("mode_2d", "string", "2D", "PRIMARY", "MODE", "tsdb_2d", "last"),
    ("n_reads", "int", "L1", "PRIMARY", "NREADS", "tsdb_l1", "last"),
    ("made", "datetime", "L2", "PRIMARY", "MADE", "tsdb_l2", "last"),
    ("exptime_l2", "float", "L2", "PRIMARY", "EXPTIME", "tsdb_l2", "last"),
    ("temperature", "float", "L2", "TELEMETRY", "TEMP", "tsdb_telemetry", "mean"),
]
#: A scan of files made from lineitem: lines are levels, the fourth and later ones headers of L2 that come one after the other.
SCANNED = """(select obs, case least(place, 4) when 1 then 'L0' when 2 then '2D' when 3 then 'L1' else 'L2' end as level, p.*, place from (
      select l_orderkey as obs, l_linenumber as place, unnest([struct_pack(extension := 'PRIMARY', keyword := 'EXPTIME', value := case when l_partkey % 10 = 0 then '-nan' else cast(cast(l_quantity as bigint) as varchar) end),
        struct_pack(extension := 'PRIMARY', keyword := 'JUNK', value := case l_returnflag when 'A' then 'T' when 'N' then 'false' else '?' end),
        struct_pack(extension := 'PRIMARY', keyword := 'MODE', value := ' ' || l_linestatus || ' '), struct_pack(extension := 'PRIMARY', keyword := 'NREADS', value := cast(l_suppkey as varchar)),
        struct_pack(extension := 'PRIMARY', keyword := 'MADE', value := strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')), struct_pack(extension := 'TELEMETRY', keyword := 'TEMP', value := case when l_suppkey % 7 = 0 then '-999' else cast(cast(l_quantity * 2 as bigint) as varchar) end)]) as p from lineitem))"""


def scanned(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    text = lambda c: c.cast("long").cast("string")
    cells = {
        ("PRIMARY", "EXPTIME"): F.when(F.col("l_partkey") % 10 == 0, "-nan").otherwise(text(F.col("l_quantity"))),
        ("PRIMARY", "JUNK"): F.when(F.col("l_returnflag") == "A", "T").when(F.col("l_returnflag") == "N", "false").otherwise("?"),
        ("PRIMARY", "MODE"): F.concat(F.lit(" "), "l_linestatus", F.lit(" ")),
        ("PRIMARY", "NREADS"): text(F.col("l_suppkey")),
        ("PRIMARY", "MADE"): F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        ("TELEMETRY", "TEMP"): F.when(F.col("l_suppkey") % 7 == 0, "-999").otherwise(text(F.col("l_quantity") * 2)),
    }
    level = F.element_at(F.array(*[F.lit(x) for x in products.LEVELS]), F.least("l_linenumber", F.lit(4)).cast("int"))
    rows = F.explode(F.array(*[F.struct(F.lit(e).alias("extension"), F.lit(k).alias("keyword"), v.alias("value")) for (e, k), v in cells.items()])).alias("p")
    return lines.select(F.col("l_orderkey").alias("obs"), level.alias("level"), rows, F.col("l_linenumber").alias("place")).select("obs", "level", "p.*", "place")


_LAST = "arg_max(value, struct_pack(p := place, v := value)) filter (where level = '{}' and extension = 'PRIMARY' and keyword = '{}')"


@Q.add(
    "catalog_extract",
    f"""with s as {SCANNED} select obs, try_cast(nullif({_LAST.format("L0", "EXPTIME")}, '-nan') as double) as exptime, case {_LAST.format("L0", "JUNK")} when 'T' then true when 'false' then false end as is_junk,
      trim({_LAST.format("2D", "MODE")}) as mode_2d, try_cast({_LAST.format("L1", "NREADS")} as bigint) as n_reads, try_cast({_LAST.format("L2", "MADE")} as timestamp) as made,
      try_cast(nullif({_LAST.format("L2", "EXPTIME")}, '-nan') as double) as exptime_l2, round(avg(try_cast(nullif(value, '-999') as double)) filter (where level = 'L2' and extension = 'TELEMETRY'), 6) as temperature,
      bool_or(level = 'L0') as "has_L0", bool_or(level = '2D') as "has_2D", bool_or(level = 'L1') as "has_L1", bool_or(level = 'L2') as "has_L2" from s group by 1""",
)
def catalog_extract(spark, sf_dir):
    """Whole observations by a catalog: headers of all levels and telemetry, each cell as its type, in one pass."""
    catalog = [products.Keyword(*c) for c in CATALOG]
    out = products.observations(scanned(spark, sf_dir), "obs", catalog)
    return out.withColumn("temperature", F.round("temperature", 6))
