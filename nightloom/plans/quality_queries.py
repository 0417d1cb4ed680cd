"""Queries of quality checks, diagnostics, scans, master frames and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.scalars import age_in_days, seconds
from ..operators import quality as K
from ..operators import statistics as A
from ..sources import observations as O
from ._common import Queries, table

Q = Queries()

OBS_SQL = """(select o_orderkey as obs, case o_orderpriority[1] when '1' then 'L0' when '2' then '2D' when '3' then 'L1' else 'L2' end as level, case when o_orderstatus = 'F' then 'Flat' when o_orderstatus = 'O' then 'Star' else 'LFC' end as source,
      count(l_orderkey) as n_lines, max(l_extendedprice) as peak, quantile_cont(l_extendedprice, 0.95) as p95, round(avg(l_discount), 9) as dark, sum(l_quantity) as exposure, min(l_tax) as temperature, coalesce(date_diff('day', cast(o_orderdate as date), cast(min(l_shipdate) as date)), -99) as age,
      round(avg(case when l_discount < 0.01 then 1.0 when l_discount is not null then 0.0 end), 9) as negative, list_sort(list(distinct l_returnflag)) as products
    from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey, o_orderpriority, o_orderstatus, o_orderdate)"""


def measured(spark, sf_dir):
    """Orders as observations with what their lines measure, one partial aggregation."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs")).agg(
        F.count("*").alias("n_lines"), F.max("l_extendedprice").alias("peak"), F.percentile("l_extendedprice", F.lit(0.95)).alias("p95"), F.round(F.avg("l_discount"), 9).alias("dark"), F.sum("l_quantity").alias("exposure"), F.min("l_tax").alias("temperature"),
        F.min("l_shipdate").alias("first_ship"), F.round(F.avg(F.when(F.col("l_discount") < 0.01, 1.0).otherwise(0.0)), 9).alias("negative"), F.sort_array(F.collect_set("l_returnflag")).alias("products"),
    )
    first = F.substring("o_orderpriority", 1, 1)
    level = F.when(first == "1", "L0").when(first == "2", "2D").when(first == "3", "L1").otherwise("L2")
    source = F.when(F.col("o_orderstatus") == "F", "Flat").when(F.col("o_orderstatus") == "O", "Star").otherwise("LFC")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs"), level.alias("level"), source.alias("source"), "o_orderdate")
    rows = orders.join(lines, "obs", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0).cast("long")))
    return rows.withColumn("age", age_in_days(F.to_date("first_ship"), F.to_date("o_orderdate")))


CHECKS = [
    K.Check("DATAPR", lambda: F.col("n_lines") > 0, description="data are there"),
    K.Check("PRODUCTS", lambda: K.complete(F.array(F.lit("N")), F.col("products")), ["2D", "L1", "L2"], description="expected products are there"),
    K.Check("LOWDARK", lambda: K.within(F.col("dark"), most=0.06), ["2D"], description="flux is low in dark exposures"),
    K.Check("FLATSNR", lambda: K.within(F.col("p95"), 20000, 70000), ["L1"], ["Flat"], "signal is sufficient and not saturated"),
    K.Check("LFCSAT", lambda: F.col("peak") < 60000, ["L1", "L2"], ["LFC", "Star"], "not saturated"),
    K.Check("OLDBIAS", lambda: K.younger_than(F.col("age"), 30), sources=["Flat", "Star"], description="master from within 30 days"),
    K.Check("CCDTEMP", lambda: K.near(F.col("temperature"), F.lit(0.02), 0.02 + 1e-9), ["L0"], description="temperature near its set point"),
    K.Check("POSSNR", lambda: K.within(F.col("negative"), most=0.2), description="few negative pixels"),
    K.Check("EXPOSED", lambda: ~((F.col("exposure") >= 20) & F.col("exposure").between(30.0, 36.7)), ["L0", "L1"], description="read out properly"),
]

QC_SQL = f"""select obs, coalesce(n_lines > 0, false) as DATAPR, case when level in ('2D', 'L1', 'L2') then coalesce(list_contains(products, 'N'), false) end as PRODUCTS,
    case when level = '2D' then coalesce(dark <= 0.06, false) end as LOWDARK, case when level = 'L1' and source = 'Flat' then coalesce(p95 >= 20000 and p95 <= 70000, false) end as FLATSNR,
    case when level in ('L1', 'L2') and source in ('LFC', 'Star') then coalesce(peak < 60000, false) end as LFCSAT, case when source in ('Flat', 'Star') then coalesce(age <> -99 and abs(age) <= 30, false) end as OLDBIAS,
    case when level = 'L0' then coalesce(abs(temperature - 0.02) <= 0.02 + 1e-9, false) end as CCDTEMP, coalesce(negative <= 0.2, false) as POSSNR,
    case when level in ('L0', 'L1') then coalesce(not (exposure >= 20 and exposure between 30.0 and 36.7), false) end as EXPOSED from {OBS_SQL}"""


@Q.add("qc_matrix", QC_SQL)
def qc_matrix(spark, sf_dir):
    return K.applied(measured(spark, sf_dir), CHECKS, ["obs"])


@Q.add(
    "qc_report",
    f"with m as ({QC_SQL}), u as (unpivot (select DATAPR, PRODUCTS, LOWDARK, FLATSNR, LFCSAT, OLDBIAS, CCDTEMP, POSSNR, EXPOSED from m) on columns(*) into name keyword value pass) select keyword, count(*) as n, count(*) filter (where pass) as n_pass, cast(floor(100.0 * count(*) filter (where pass) / count(*)) as bigint) as percent from u group by 1",
)
def qc_report(spark, sf_dir):
    return K.summary(K.applied(measured(spark, sf_dir), CHECKS, ["obs"]), ["obs"])


@Q.add(
    "diag_matrix",
    """select l_orderkey as obs, round(quantile_cont(l_extendedprice, 0.99), 4) as FLUX99, round(quantile_cont(l_extendedprice, 0.9), 4) as FLUX90, round(quantile_cont(l_extendedprice, 0.5), 4) as FLUX50, round(quantile_cont(l_extendedprice, 0.1), 4) as FLUX10,
      round(sum(l_extendedprice) filter (where l_linenumber = 1) / nullif(sum(l_extendedprice) filter (where l_linenumber = 2), 0), 6) as RATIO12, round(stddev_pop(l_quantity), 6) as RNOISE,
      round(0.7979 * stddev_pop(l_quantity) / nullif(avg(abs(l_quantity - m)), 0), 5) as NONGAUSS, count(*) filter (where l_tax = 0) as NNAN
    from lineitem join (select l_orderkey as k, avg(l_quantity) as m from lineitem group by 1) on k = l_orderkey group by 1""",
)
def diag_matrix(spark, sf_dir):
    """Flux percentiles, ratios, read noise and its shape, and missing values of each observation."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("obs"), "l_linenumber", "l_extendedprice", "l_quantity", "l_tax")
    mean = lines.groupBy("obs").agg(F.avg("l_quantity").alias("m"))
    price = F.col("l_extendedprice")
    p = F.percentile(price, F.array(*[F.lit(x) for x in (0.99, 0.9, 0.5, 0.1)]))
    part = lambda n: F.sum(F.when(F.col("l_linenumber") == n, price))
    out = lines.join(mean, "obs").groupBy("obs").agg(
        p.alias("p"), F.round(part(1) / F.nullif(part(2), F.lit(0.0)), 6).alias("RATIO12"), F.round(F.stddev_pop("l_quantity"), 6).alias("RNOISE"),
        F.round(0.7979 * F.stddev_pop("l_quantity") / F.nullif(F.avg(F.abs(F.col("l_quantity") - F.col("m"))), F.lit(0.0)), 5).alias("NONGAUSS"), F.count_if(F.col("l_tax") == 0).alias("NNAN"),
    )
    return out.select("obs", *[F.round(F.get("p", F.lit(i)), 4).alias(n) for i, n in enumerate(("FLUX99", "FLUX90", "FLUX50", "FLUX10"))], "RATIO12", "RNOISE", "NONGAUSS", "NNAN")


@Q.add(
    "qc_timing",
    "select event_id, (ts <= ts + to_seconds(value / 2) and abs(case when user_id % 9 = 0 then value + 2 else value end - value) <= 1.0) as timing from events",
)
def qc_timing(spark, sf_dir):
    """Begin, middle and end in order, and their span the elapsed time within a second."""
    b = seconds(F.col("ts"))
    e = b + F.when(F.col("user_id") % 9 == 0, F.col("value") + 2).otherwise(F.col("value"))
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", K.consistent(b, b + F.col("value") / 2, e, F.col("value"), 1.0).alias("timing"))


# scans


@Q.add(
    "header_scan",
    "select event_id, try_cast(user_id as bigint) as FRAME, case when user_id % 5 = 0 then null else value end as TEMP, case when event_type = 'click' then true when event_type = 'view' then false end as OPEN, event_type as IMTYPE, cast(null as varchar) as ABSENT from events",
)
def header_scan(spark, sf_dir):
    """Keywords of a header map as typed columns; absent keywords and unreadable values are null."""
    text = lambda c: F.col(c).cast("string")
    temp = F.when(F.col("user_id") % 5 == 0, F.lit("-nan")).otherwise(text("value"))
    flag = F.when(F.col("event_type") == "click", "true").when(F.col("event_type") == "view", "false").otherwise("?")
    header = F.create_map(F.lit("FRAME"), text("user_id"), F.lit("TEMP"), temp, F.lit("OPEN"), flag, F.lit("IMTYPE"), F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", header.alias("header"))
    return O.header_columns(rows, "event_id", {"FRAME": "int", "TEMP": "float", "OPEN": "bool", "IMTYPE": "string", "ABSENT": "string"})


@Q.add(
    "telemetry_pivot",
    "select cast(ts as date) as day, round(avg(value) filter (where event_type = 'click' and user_id % 4 <> 0), 6) as click, round(avg(value) filter (where event_type = 'error' and user_id % 4 <> 0), 6) as error from events where event_type in ('click', 'error') group by 1",
)
def telemetry_pivot(spark, sf_dir):
    """Long telemetry to columns, its missing marks left out."""
    raw = F.when(F.col("user_id") % 4 == 0, F.lit("-999")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", raw.alias("value"))
    out = O.pivoted(rows, "day", "event_type", "value", ["click", "error"])
    return out.select("day", F.round("click", 6).alias("click"), F.round("error", 6).alias("error"))


@Q.add(
    "rv_unpivot",
    """with l as (select l_orderkey as obs, l_linenumber as r, max(l_quantity) as rv, max(case when l_discount > 0.005 then l_tax end) as err from lineitem group by 1, 2),
    u as (select obs, 'rv' || lpad(cast(r as varchar), 2, '0') as name, rv as value from l union all select obs, 'err' || lpad(cast(r as varchar), 2, '0'), err from l), w as (select obs, count(value) = 14 as whole from u group by 1)
    select u.obs, name, case when whole then value end as value from u join w on u.obs = w.obs""",
)
def rv_unpivot(spark, sf_dir):
    """A table of rows per observation as named values; an incomplete observation has none."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("obs"), F.col("l_linenumber").alias("r")).agg(F.max("l_quantity").alias("rv"), F.max(F.when(F.col("l_discount") > 0.005, F.col("l_tax"))).alias("err"))
    return O.numbered(lines, "obs", "r", ["rv", "err"], 7)


@Q.add("json_props", "select event_id, cast(json_extract_string(props, '$.k') as varchar) as k, len(json_keys(props)) as n_keys from events")
def json_props(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.json_object_keys("props").alias("keys")).select("event_id", "k", F.size("keys").cast("long").alias("n_keys"))


# master frames

FRAMES = "(select l_suppkey as frame, cast(l_partkey % 50 as int) as pixel, avg(l_extendedprice) as value, avg(l_quantity) as exptime from lineitem group by 1, 2)"


@Q.add(
    "master_frame",
    f"""with f as (select pixel, value / exptime as x from {FRAMES} where exptime >= 20), p as (select pixel, quantile_cont(x, 0.16) as a, quantile_cont(x, 0.5) as m, quantile_cont(x, 0.84) as b from f group by 1)
    select f.pixel, round(avg(x) filter (where abs(x - m) <= 2.0 * (b - a) / 2), 4) as mean, count(*) filter (where abs(x - m) <= 2.0 * (b - a) / 2) as n, case when count(*) filter (where abs(x - m) <= 2.0 * (b - a) / 2) < 60 then 1 else 0 end as infobits from f join p on f.pixel = p.pixel group by f.pixel""",
)
def master_frame(spark, sf_dir):
    """A master dark: frames of sufficient exposure as rates, clipped and averaged per pixel, thin pixels marked."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("frame"), (F.col("l_partkey") % 50).cast("int").alias("pixel")).agg(F.avg("l_extendedprice").alias("value"), F.avg("l_quantity").alias("exptime"))
    rates = lines.filter("exptime >= 20").select("pixel", (F.col("value") / F.col("exptime")).alias("x"))
    out = A.clipped_stack(rates, ["pixel"], "x", 2.0)
    return out.select("pixel", F.round("mean", 4).alias("mean"), "n", F.when(F.col("n") < 60, 1).otherwise(0).alias("infobits"))


@Q.add(
    "exposure_infobits",
    """with q as (select l_suppkey as amp, quantile_cont(l_extendedprice, 0.16) as p16, median(l_extendedprice) as med, quantile_cont(l_extendedprice, 0.84) as p84, avg(case when l_extendedprice < 3000 then 1.0 else 0 end) as dead, avg(case when l_extendedprice > 80000 then 1.0 else 0 end) as saturated from lineitem group by 1)
    select amp, round(med, 4) as med, round(p16, 4) as p16, round(p84, 4) as p84, (case when dead > 0.02 then 1 else 0 end) | (case when saturated > 0.02 then 2 else 0 end) | (case when med > 37000 then 4 else 0 end) as infobits from q""",
)
def exposure_infobits(spark, sf_dir):
    """Median and spread per amplifier, and bits for dead, saturated and bright ones."""
    x = F.col("l_extendedprice")
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    s = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("amp")).agg(F.percentile(x, F.array(F.lit(0.16), F.lit(0.5), F.lit(0.84))).alias("p"), share(x < 3000).alias("dead"), share(x > 80000).alias("saturated"))
    med = F.get("p", F.lit(1))
    bits = [F.when(c, b).otherwise(0) for c, b in ((F.col("dead") > 0.02, 1), (F.col("saturated") > 0.02, 2), (med > 37000, 4))]
    return s.select("amp", F.round(med, 4).alias("med"), F.round(F.get("p", F.lit(0)), 4).alias("p16"), F.round(F.get("p", F.lit(2)), 4).alias("p84"), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("infobits"))


# sorts and sets


@Q.add("value_counts_top", "select o_orderpriority, count(*) as n from orders group by 1 order by n desc, o_orderpriority limit 3")
def value_counts_top(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_orderpriority").limit(3)


@Q.add("outliers_top", "with m as (select median(value) as m, (quantile_cont(value, 0.84) - quantile_cont(value, 0.16)) / 2 as s from events) select event_id, round(abs(value - m) / s, 6) as sigmas from events, m order by abs(value - m) / s desc, event_id limit 20")
def outliers_top(spark, sf_dir):
    """The twenty values furthest from the median in robust sigmas."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    s = A.clipped_stack(events, [], "value", 3.0).select("center", "spread")
    far = F.abs(F.col("value") - F.col("center")) / F.nullif(F.col("spread"), F.lit(0.0))
    rows = events.crossJoin(F.broadcast(s)).select("event_id", far.alias("far"))  # one row
    return rows.orderBy(F.desc("far"), "event_id").limit(20).select("event_id", F.round("far", 6).alias("sigmas"))


@Q.add("distinct_first", "select user_id, arg_min(event_type, event_id) as first_type, count(distinct event_type) as n_types from events group by 1")
def distinct_first(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("first_type"), F.count_distinct("event_type").alias("n_types"))


@Q.add("interleaved_files", "select 'order' as kind, o_orderkey as id, o_orderdate as at from orders where o_orderdate >= timestamp '2001-07-01' union all select 'line', l_orderkey * 10 + l_linenumber, l_shipdate from lineitem where l_shipdate >= timestamp '2001-10-01'")
def interleaved_files(spark, sf_dir):
    """Two lists of files as one, newest first."""
    a = table(spark, sf_dir, "orders").filter("o_orderdate >= '2001-07-01'").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"))
    b = table(spark, sf_dir, "lineitem").filter("l_shipdate >= '2001-10-01'").select(F.lit("line").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("at"))
    return a.unionByName(b).orderBy(F.desc("at"), "kind", "id")


@Q.add("set_operations", "(select l_partkey from lineitem where l_returnflag = 'A' intersect select l_partkey from lineitem where l_returnflag = 'R') except select l_partkey from lineitem where l_returnflag = 'N' and l_quantity > 25")
def set_operations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pick = lambda c: lines.filter(c).select("l_partkey")
    return pick("l_returnflag = 'A'").intersect(pick("l_returnflag = 'R'")).subtract(pick("l_returnflag = 'N' and l_quantity > 25"))
