"""Queries of the star builder, header matches, reports and registration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import registry, selection
from ..operators.sizes import broadcast_small
from ._common import Queries, table

Q = Queries()

STAR_SQL = """(with l as (select l_orderkey, sum(l_quantity) as qty, max(l_shipdate) as last_ship, bool_and(l_discount < 0.08) as all_cheap,
      case when count(*) > 2 then bool_or(l_returnflag = 'R') end as returned from lineitem group by 1)
    select o_orderkey, o_orderdate, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y%m%d') as datecode, c_name, c_mktsegment, c_nationkey, n_name, qty, last_ship, all_cheap, returned
    from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join l on l_orderkey = o_orderkey)"""


def star(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("datecode", S.datecode(F.col("o_orderdate")))
    base = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", "datecode")
    people = table(spark, sf_dir, "customer").join(broadcast_small(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    people = base.select("o_orderkey", "o_custkey").join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment", "c_nationkey", "n_name")
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"),
        F.max("l_shipdate").alias("last_ship"),
        F.bool_and(F.col("l_discount") < 0.08).alias("all_cheap"),
        F.when(F.count("*") > 2, F.bool_or(F.col("l_returnflag") == "R")).alias("returned"),
    )
    return selection.Star("o_orderkey", base.drop("o_custkey"), {"people": people, "lines": lines})


def _star_query(name, columns, where, filters, uses):
    @Q.add(name, f"select {', '.join(columns)} from {STAR_SQL} where {where}")
    def run(spark, sf_dir):
        return star(spark, sf_dir).select(columns, *filters(), uses=uses)

    run.__name__ = name
    return run


_star_query("star_select_all", ["o_orderkey", "datecode", "o_totalprice", "c_name", "n_name", "qty", "all_cheap", "returned"], "true", lambda: [], [])
_star_query(
    "star_in_like_dates", ["o_orderkey", "n_name", "c_name"], "c_mktsegment in ('BUILDING', 'MACHINERY') and (n_name like '%AN%' or n_name like '%N_TION_1%') and datecode between '19960101' and '19991231'",
    lambda: [F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), selection.any_like(F.col("n_name"), ["AN", "N_TION_1"]), F.col("datecode").between("19960101", "19991231")], ["c_mktsegment", "datecode"],
)
_star_query("star_qc_pass", ["o_orderkey", "returned"], "returned", lambda: [selection.quality(passed=["returned"])], ["returned"])
_star_query("star_qc_fail", ["o_orderkey", "returned"], "not returned", lambda: [selection.quality(failed=["returned"])], ["returned"])
_star_query("star_qc_not_pass", ["o_orderkey", "returned"], "not coalesce(returned, false)", lambda: [selection.quality(not_passed=["returned"])], ["returned"])
_star_query("star_qc_not_fail", ["o_orderkey", "returned"], "coalesce(returned, true)", lambda: [selection.quality(not_failed=["returned"])], ["returned"])
_star_query("star_extra_and", ["o_orderkey", "qty"], "qty > 100 and o_totalprice < 200000", lambda: [selection.extra(["qty > 100", "o_totalprice < 200000"])], ["qty"])
_star_query("star_extra_or", ["o_orderkey", "qty"], "qty > 180 or o_totalprice < 2000", lambda: [selection.extra(["qty > 180", "o_totalprice < 2000"], "OR")], ["qty"])


@Q.add("ids_for_object", f"select o_orderkey from {STAR_SQL} where c_mktsegment = 'BUILDING' and datecode >= '20000101' and not coalesce(returned, false)")
def ids_for_object(spark, sf_dir):
    return star(spark, sf_dir).select(["o_orderkey"], F.col("c_mktsegment") == "BUILDING", F.col("datecode") >= "20000101", selection.quality(not_passed=["returned"]), uses=["c_mktsegment", "returned"])


@Q.add("clean_outliers", "select event_id, value from events where value > 1 and value < 90")
def clean_outliers(spark, sf_dir):
    """Limits of columns that the table lacks do not matter."""
    return selection.within_limits(table(spark, sf_dir, "events").select("event_id", "value"), {"value": (1, 90), "hallway": (15, None)})


@Q.add("first_last_dates", "select min(o_orderdate) as first_date, max(o_orderdate) as last_date from orders")
def first_last_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@Q.add(
    "db_status",
    """select 'orders' as table_name, count(*) as n_rows, 6 as n_columns, min(cast(o_orderdate as date)) as first_date, max(cast(o_orderdate as date)) as last_date, count(distinct cast(o_orderdate as date)) as n_dates from orders
    union all select 'events', count(*), 6, min(cast(ts as date)), max(cast(ts as date)), count(distinct cast(ts as date)) from events""",
)
def db_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return registry.status({"orders": (orders, "o_orderdate"), "events": (table(spark, sf_dir, "events").withColumn("ts", F.to_date("ts")), "ts")})


@Q.add(
    "delete_by_datecode",
    """with gone as (select o_orderkey from orders where strftime(o_orderdate, '%Y%m') = '199703')
    select 'orders' as table_name, count(*) as n_deleted, (select count(*) from orders) - count(*) as n_left from orders where o_orderkey in (from gone)
    union all select 'lineitem', count(*), (select count(*) from lineitem) - count(*) from lineitem where l_orderkey in (from gone)""",
)
def delete_by_datecode(spark, sf_dir):
    """What each table loses, children with their base row, and what stays."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    left, counts = registry.delete_by({"orders": orders, "lineitem": lines}, "orders", "key", F.date_format("o_orderdate", "yyyyMM") == "199703")
    stay = left["orders"].agg(F.count("*").alias("n_left")).select(F.lit("orders").alias("table_name"), "n_left")
    stay = stay.unionByName(left["lineitem"].agg(F.count("*").alias("n_left")).select(F.lit("lineitem").alias("table_name"), "n_left"))
    return counts.join(stay, "table_name")


@Q.add(
    "error_log_counts",
    """with l as (select ts || ' [' || upper(event_type) || ']: user ' || (user_id % 7) || ' failed' as line from events)
    select trim(split_part(line, '[ERROR]:', 2)) as message, count(*) as n from l where contains(line, '[ERROR]:') group by 1""",
)
def error_log_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    line = F.concat(F.col("ts").cast("string"), F.lit(" ["), F.upper("event_type"), F.lit("]: user "), (F.col("user_id") % 7).cast("string"), F.lit(" failed"))
    return registry.error_messages(events.select(line.alias("line")), "line")


@Q.add(
    "norm_bool",
    """with t as (select event_id, list_value(' Yes', 'FALSE', '1', 'off', 'maybe', null, 'T ', '0.0', 'Open', 'CLOSED', 'on', 'pass', '0', 'n')[event_id % 14 + 1] as raw from events)
    select event_id, case when lower(trim(raw)) in ('1', 'true', 't', 'yes', 'y', 'open') then true when lower(trim(raw)) in ('0', 'false', 'f', 'no', 'n', 'closed') then false end as flag from t""",
)
def norm_bool(spark, sf_dir):
    words = (" Yes", "FALSE", "1", "off", "maybe", None, "T ", "0.0", "Open", "CLOSED", "on", "pass", "0", "n")
    raw = F.get(F.array(*[F.lit(x) for x in words]), (F.col("event_id") % len(words)).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", S.loose_boolean(raw).alias("flag"))


@Q.add("header_match_lower", "select p_partkey from part where lower(trim(p_brand)) = 'brand#12' and lower(trim(cast(p_size as varchar))) = '7'")
def header_match_lower(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(selection.header_equal({"p_brand": " Brand#12", "p_size": "7 "})).select("p_partkey")


@Q.add("header_match_le", "select p_partkey from part where p_size <= 10 and p_retailprice <= 1000 and try_cast(p_name as double) is null")
def header_match_le(spark, sf_dir):
    """Numbers up to their limits; a keyword that is no number does not match."""
    part = table(spark, sf_dir, "part")
    return part.filter(selection.header_at_most({"p_size": 10, "p_retailprice": 1000}) & ~selection.header_at_most({"p_name": 1e9})).select("p_partkey")


@Q.add(
    "select_obs_first_match",
    """with f as (select '/data/' || strftime(ts, '%Y%m%d') || '/KP.' || strftime(ts, '%Y%m%d') || '.' || user_id || '_' || event_type || '.fits' as path, strftime(ts, '%Y%m%d') as b from events),
    i as (select distinct 'KP.' || strftime(ts, '%Y%m%d') || '.' || user_id || '_' as id, strftime(ts, '%Y%m%d') as b from events where event_type = 'error' and value > 60)
    select id, min(path) as path from f join i on f.b = i.b and contains(f.path, i.id) group by 1""",
)
def select_obs_first_match(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    day = S.datecode(F.col("ts"))
    name = F.concat(F.lit("KP."), day, F.lit("."), F.col("user_id").cast("string"), F.lit("_"))
    files = events.select(F.concat(F.lit("/data/"), day, F.lit("/"), name, "event_type", F.lit(".fits")).alias("path"))
    ids = events.filter("event_type = 'error' and value > 60").select(name.alias("id")).distinct()
    # an id is the name up to its mark, so a file's name tells the one id that it can contain
    return selection.first_match(files, ids, "path", "id", F.regexp_extract("path", r"(KP\.\d{8}\.[^_/]*_)", 1), F.col("id"), ["path"])


@Q.add(
    "source_class",
    """select o_orderkey, case when o_orderpriority like '1%' then 'Bias' when o_orderpriority like '2%' and o_totalprice < 50000 then 'Dark'
      when o_orderstatus = 'F' and o_totalprice > 300000 then 'Wide Flat' when o_orderstatus = 'F' then 'Flat'
      when o_orderpriority like '3%' then 'LFC' when o_orderstatus = 'O' then 'Star' end as source from orders""",
)
def source_class(spark, sf_dir):
    """Ordered rules: the first that holds names the source, none gives null."""
    p, status, price = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
    rules = [("Bias", p.like("1%")), ("Dark", p.like("2%") & (price < 50000)), ("Wide Flat", (status == "F") & (price > 300000)), ("Flat", status == "F"), ("LFC", p.like("3%")), ("Star", status == "O")]
    return table(spark, sf_dir, "orders").select("o_orderkey", selection.classified(rules).alias("source"))


@Q.add(
    "products_expected",
    """with l as (select l_orderkey, max(case when l_linenumber = 1 then l_quantity else 0 end) as a, max(case when l_linenumber = 4 then l_quantity else 0 end) as b, max(case when l_linenumber = 6 then l_quantity else 0 end) as c from lineitem group by 1)
    select l_orderkey, concat_ws(',', case when a > 0 then 'L0' end, case when b > 0 then '2D' end, case when c > 0 then 'L1' end) as products,
      concat_ws(',', case when a <= 0 then 'L0' end, case when b <= 0 then '2D' end, case when c <= 0 then 'L1' end) as missing from l""",
)
def products_expected(spark, sf_dir):
    """Products that are there by their sizes, and the expected ones that are not."""
    n = lambda k, c: F.max(F.when(F.col("l_linenumber") == k, F.col("l_quantity")).otherwise(0)).alias(c)
    sizes = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(n(1, "a"), n(4, "b"), n(6, "c"))
    there = selection.present({"L0": "a", "2D": "b", "L1": "c"})
    missing = F.array_except(F.array(F.lit("L0"), F.lit("2D"), F.lit("L1")), there)
    return sizes.select("l_orderkey", F.array_join(there, ",").alias("products"), F.array_join(missing, ",").alias("missing"))


@Q.add(
    "good_flats",
    "select o_orderkey from orders join customer on o_custkey = c_custkey where lower(trim(c_mktsegment)) = 'building' and o_orderstatus = 'O' and o_totalprice <= 110000 and o_orderpriority not in ('', 'none')",
)
def good_flats(spark, sf_dir):
    """Header match, one object for all fibres, and a largest elapsed time."""
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.filter(selection.header_equal({"c_mktsegment": "Building", "o_orderstatus": "o"}) & selection.header_at_most({"o_totalprice": 110000}) & ~F.col("o_orderpriority").isin("", "none")).select("o_orderkey")


@Q.add("first_with_mask", "select l_orderkey, l_linenumber, l_shipdate from lineitem where (l_linenumber & 5) = 5 and l_returnflag = 'A' order by l_shipdate, l_orderkey, l_linenumber limit 1")
def first_with_mask(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    wanted = (F.col("l_linenumber").bitwiseAND(5) == 5) & (F.col("l_returnflag") == "A")
    return registry.first_of(lines, wanted, ["l_shipdate", "l_orderkey", "l_linenumber"]).drop("l_returnflag")


@Q.add("infobit_definitions", "select l_linenumber as bit, l_returnflag as definition, max(l_shipdate) as created from lineitem group by 1, 2")
def infobit_definitions(spark, sf_dir):
    bits = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("bit"), F.col("l_returnflag").alias("definition"), F.col("l_shipdate").alias("created"))
    return registry.latest_definitions(bits, "created")


UP_KEY = "cast(l_shipdate as date) as startdate, l_returnflag as caltype, l_linenumber as level"


@Q.add(
    "upsert_calfile",
    f"""with o as (select {UP_KEY}, min(l_orderkey) as cid, max(l_quantity) as nframes, min(l_tax) as note from lineitem where l_shipdate < timestamp '1997-01-01' group by 1, 2, 3),
    r as (select {UP_KEY}, l_orderkey as cid, case when l_quantity > 10 then l_quantity end as nframes, row_number() over (partition by cast(l_shipdate as date), l_returnflag, l_linenumber order by l_orderkey desc) as k
          from lineitem where l_shipdate >= timestamp '1996-06-01' and l_shipdate < timestamp '1997-06-01'), i as (select * from r where k = 1)
    select coalesce(o.startdate, i.startdate) as startdate, coalesce(o.caltype, i.caltype) as caltype, coalesce(o.level, i.level) as level, coalesce(i.cid, o.cid) as cid, coalesce(i.nframes, o.nframes) as nframes, o.note
    from o full outer join i on o.startdate = i.startdate and o.caltype = i.caltype and o.level = i.level""",
)
def upsert_calfile(spark, sf_dir):
    """Insert or update by (startdate, caltype, level); columns that do not come keep their stored values."""
    lines = table(spark, sf_dir, "lineitem").withColumns({"startdate": F.to_date("l_shipdate"), "caltype": F.col("l_returnflag"), "level": F.col("l_linenumber")})
    key = ["startdate", "caltype", "level"]
    stored = lines.filter("l_shipdate < '1997-01-01'").groupBy(*key).agg(F.min("l_orderkey").alias("cid"), F.max("l_quantity").alias("nframes"), F.min("l_tax").alias("note"))
    new = lines.filter("l_shipdate >= '1996-06-01' and l_shipdate < '1997-06-01'").select(*key, F.col("l_orderkey").alias("cid"), F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("nframes"))
    return registry.upsert(stored, new, key, "cid")


@Q.add(
    "propagate_parent",
    """with p as (select l_orderkey, l_partkey as cid, l_quantity as nframes from lineitem where l_linenumber = 1)
    select l.l_orderkey, l.l_linenumber, coalesce(p.cid, l.l_partkey) as cid, coalesce(p.nframes, l.l_quantity) as nframes from lineitem l left join p on p.l_orderkey = l.l_orderkey where l.l_linenumber > 1""",
)
def propagate_parent(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("cid"), F.col("l_quantity").alias("nframes"))
    return registry.inherit(lines.filter("l_linenumber > 1"), lines.filter("l_linenumber = 1").drop("l_linenumber"), ["l_orderkey"], ["cid", "nframes"])


@Q.add("mjd_from_timestamp", "select event_id, round(40587 + epoch_us(ts) / 86400e6, 8) as mjd from events")
def mjd_from_timestamp(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(S.mjd(F.col("ts")), 8).alias("mjd"))


@Q.add("night_window", "select event_id from events where 40587 + epoch_us(ts) / 86400e6 > 60320 - 6 / 24.0 and 40587 + epoch_us(ts) / 86400e6 < 60320 + 9 / 24.0")
def night_window(spark, sf_dir):
    return registry.night_window(table(spark, sf_dir, "events").withColumn("mjd", S.mjd(F.col("ts"))), "mjd", 60320, 6, 9).select("event_id")


@Q.add(
    "stale_files",
    """with f as (select l_orderkey, max(case when l_linenumber = 1 then l_shipdate end) as m1, max(case when l_linenumber = 2 then l_shipdate end) as m2 from lineitem group by 1)
    select l_orderkey from f left join orders on o_orderkey = l_orderkey and o_orderstatus = 'F'
    where coalesce(m1, timestamp '1000-01-01') > coalesce(o_orderdate + interval 40 day, timestamp '1000-01-01') or coalesce(m2, timestamp '1000-01-01') > coalesce(o_orderdate + interval 80 day, timestamp '1000-01-01')""",
)
def stale_files(spark, sf_dir):
    m = lambda k, c: F.max(F.when(F.col("l_linenumber") == k, F.col("l_shipdate"))).alias(c)
    files = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(m(1, "m1"), m(2, "m2"))
    read = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.expr("o_orderdate + interval 40 days").alias("r1"), F.expr("o_orderdate + interval 80 days").alias("r2"))
    return registry.stale(files, read, "l_orderkey", ["m1", "m2"], ["r1", "r2"])


@Q.add(
    "difference_pairs",
    """with n as (select event_type, event_id, value, lead(event_id) over w as next_event_id, lead(value) over w as next_value from events window w as (partition by event_type order by ts, event_id))
    select event_type, event_id, next_event_id, round((value - next_value) / sqrt(2.0), 6) as noise from n where next_event_id is not null""",
)
def difference_pairs(spark, sf_dir):
    """Each frame with the next of its type; their difference over the root of two is the noise of one."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value", "ts")
    pairs = registry.next_in_type(events, ["event_type"], ["ts", "event_id"], ["event_id", "value"], F.to_date("ts"))
    return pairs.select("event_type", "event_id", "next_event_id", F.round((F.col("value") - F.col("next_value")) / F.sqrt(F.lit(2.0)), 6).alias("noise"))
