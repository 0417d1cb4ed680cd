"""Queries of the as-of, interval and anti-range joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import seconds
from ..operators import asof
from ._common import Queries, table

Q = Queries()

#: Calibrations made from lineitem: one per (type, day, content), with the smallest order as its id.
CALIBRATIONS = """(select l_returnflag as caltype, cast(l_shipdate as date) as startdate, (l_linenumber & 7) as contentbits, min(l_orderkey) as cid
    from lineitem group by 1, 2, 3)"""
OBSERVATIONS = "(select o_orderkey as obs, cast(o_orderdate as date) as obsdate from orders)"


def calibrations(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_returnflag").alias("caltype"), F.to_date("l_shipdate").alias("startdate"), F.expr("l_linenumber & 7").alias("contentbits")).agg(F.min("l_orderkey").alias("cid"))


def observations(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs"), F.to_date("o_orderdate").alias("obsdate"))


#: The types that are asked for.
TYPES = ["A", "N", "R"]


def _nearest(spark, sf_dir, days, mask=None):
    """One request per observation and type.  The mask only says which calibrations are candidates, so a sequence carries it."""
    requests = observations(spark, sf_dir).withColumn("caltype", F.explode(F.array(*[F.lit(t) for t in TYPES]))).withColumn("at", F.col("obsdate").cast("timestamp_ntz"))
    cal = calibrations(spark, sf_dir)
    if mask:
        cal = cal.filter(F.col("contentbits").bitwiseAND(mask) == mask)
    cal = cal.groupBy("caltype", "startdate").agg(F.min("cid").alias("cid")).withColumn("at", F.col("startdate").cast("timestamp_ntz"))  # of one day the smallest id
    cal = cal.select("caltype", "at", F.struct("at", "startdate", "cid").alias("v"))
    best = asof.asof_nearest(requests, cal, ["caltype"], "at", "v", "at", "best", days * asof.DAY).filter("best is not null")
    return best.select("obs", "caltype", F.col("best.startdate").alias("startdate"), F.col("best.cid").alias("cid"))


NEAREST_SQL = f"""
    select obs, caltype, startdate, cid from (
      select r.obs, r.caltype, obsdate, case when a.startdate is null or obsdate - b.startdate <= a.startdate - obsdate then b.startdate else a.startdate end as startdate,
             case when a.startdate is null or obsdate - b.startdate <= a.startdate - obsdate then b.cid else a.cid end as cid
      from (select obs, obsdate, unnest(['A', 'N', 'R']) as caltype from {OBSERVATIONS}) r
      asof left join (select caltype, startdate, min(cid) as cid from {CALIBRATIONS} c where true {{more}} group by 1, 2) b on r.caltype = b.caltype and r.obsdate >= b.startdate
      asof left join (select caltype, startdate, min(cid) as cid from {CALIBRATIONS} c where true {{more}} group by 1, 2) a on r.caltype = a.caltype and r.obsdate < a.startdate)
    where abs(date_diff('day', startdate, obsdate)) <= {{days}}"""


@Q.add("asof_nearest_batch", NEAREST_SQL.format(days=90, more=""))
def asof_nearest_batch(spark, sf_dir):
    """For each observation the nearest calibration of every type within 90 days, the earlier of two equally near."""
    return _nearest(spark, sf_dir, 90)


@Q.add("asof_nearest_tolerance", NEAREST_SQL.format(days=3, more="and (c.contentbits & 4) = 4"))
def asof_nearest_tolerance(spark, sf_dir):
    """As before within 3 days, among calibrations whose content holds all requested bits."""
    return _nearest(spark, sf_dir, 3, 4)


def _clicks(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    left = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = events.filter("event_type = 'click'").select("user_id", "ts", F.struct(F.col("ts").alias("t"), F.col("event_id").alias("id"), "value").alias("v"))
    return left, right


CLICKS = "c as (select user_id, ts, event_id as id, value from events where event_type = 'click'), p as (select user_id, ts, event_id from events where event_type = 'purchase')"


@Q.add("asof_backward", f"with {CLICKS} select p.event_id, p.user_id, c.id as before_id, c.ts as before_ts from p asof left join c on p.user_id = c.user_id and p.ts > c.ts")
def asof_backward(spark, sf_dir):
    left, right = _clicks(spark, sf_dir)
    return asof.asof_before(left, right, ["user_id"], "ts", "v").select("event_id", "user_id", F.col("before.id").alias("before_id"), F.col("before.t").alias("before_ts"))


@Q.add("asof_forward", f"with {CLICKS} select p.event_id, p.user_id, c.id as after_id, c.ts as after_ts from p asof left join c on p.user_id = c.user_id and p.ts < c.ts")
def asof_forward(spark, sf_dir):
    left, right = _clicks(spark, sf_dir)
    return asof.asof_after(left, right, ["user_id"], "ts", "v").select("event_id", "user_id", F.col("after.id").alias("after_id"), F.col("after.t").alias("after_ts"))


PAIR = f"""with {CLICKS}, b as (select p.event_id, p.user_id, p.ts, c.id as before_id, c.ts as before_ts, c.value as before_value from p asof left join c on p.user_id = c.user_id and p.ts > c.ts),
    ba as (select b.*, c.id as after_id, c.ts as after_ts, c.value as after_value from b asof left join c on b.user_id = c.user_id and b.ts <= c.ts)"""


def _pair(spark, sf_dir):
    left, right = _clicks(spark, sf_dir)
    before = asof.asof_before(left, right, ["user_id"], "ts", "v")
    return asof.asof_after(before, right, ["user_id"], "ts", "v", strict=False)


@Q.add("asof_pair", PAIR + " select event_id, before_id, after_id from ba")
def asof_pair(spark, sf_dir):
    """Before (strictly) and at or after, side by side."""
    return _pair(spark, sf_dir).select("event_id", F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"))


@Q.add("asof_bracket", PAIR + " select event_id, before_id, after_id, before_ts, after_ts from ba where before_id is not null and after_id is not null")
def asof_bracket(spark, sf_dir):
    """Only rows with a neighbour on either side."""
    both = _pair(spark, sf_dir).filter("before is not null and after is not null")
    return both.select("event_id", F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"), F.col("before.t").alias("before_ts"), F.col("after.t").alias("after_ts"))


INTERP = """ select event_id, round(case when before_id is null then after_value when after_id is null then before_value
      else before_value + (epoch_us(ts) - epoch_us(before_ts)) / 1e6 / nullif((epoch_us(after_ts) - epoch_us(before_ts)) / 1e6, 0) * (after_value - before_value) end, 6) as value from ba"""


@Q.add("asof_bracket_interp", PAIR + INTERP)
def asof_bracket_interp(spark, sf_dir):
    """Linear in time between the neighbours, the one there is where the other is missing."""
    both = _pair(spark, sf_dir)
    t, b, a = seconds(F.col("ts")), seconds(F.col("before.t")), seconds(F.col("after.t"))
    line = F.col("before.value") + (t - b) / F.nullif(a - b, F.lit(0.0)) * (F.col("after.value") - F.col("before.value"))
    value = F.when(F.col("before").isNull(), F.col("after.value")).when(F.col("after").isNull(), F.col("before.value")).otherwise(line)
    return both.select("event_id", F.round(value, 6).alias("value"))


@Q.add(
    "asof_nearest_either",
    f"""with {CLICKS} select event_id, id as nearest_id from (
      select p.event_id, c.id, row_number() over (partition by p.event_id order by abs(epoch_us(p.ts) - epoch_us(c.ts)), c.ts, c.id) as k
      from p join c on p.user_id = c.user_id and abs(epoch_us(p.ts) - epoch_us(c.ts)) <= 36000000000) where k = 1""",
)
def asof_nearest_either(spark, sf_dir):
    """Nearest click of the same user within ten hours."""
    left, right = _clicks(spark, sf_dir)
    near = asof.asof_nearest(left, right, ["user_id"], "ts", "v", "t", tolerance=36000.0)
    return near.filter("nearest is not null").select("event_id", F.col("nearest.id").alias("nearest_id"))


#: A validity list as it is kept by hand: intervals may overlap and the later row wins.
VALIDITY = [
    (1, "1995-01-01", "1996-01-01", "trace_a"), (2, "1996-01-01", "1997-06-30", "trace_b"), (3, "1997-03-01", "1998-01-01", "trace_c"),
    (4, "1998-01-02", "2000-01-01", "trace_d"), (5, "2000-01-01", "2001-01-01", "trace_e"),
]
VALIDITY_SQL = "(values " + ", ".join(f"({r}, timestamp '{a}', timestamp '{b}', '{p}')" for r, a, b, p in VALIDITY) + ") v(row, start, stop, path)"


def validity(spark):
    rows = spark.createDataFrame(VALIDITY, "row int, start string, stop string, path string")
    return rows.withColumn("start", F.col("start").cast("timestamp_ntz")).withColumn("stop", F.col("stop").cast("timestamp_ntz"))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")


@Q.add("interval_validity_join", f"select o_orderkey, arg_max(path, row) as path from orders left join {VALIDITY_SQL} on o_orderdate >= start and o_orderdate < stop group by o_orderkey")
def interval_validity_join(spark, sf_dir):
    """start <= t < stop, the last matching row wins."""
    return asof.within_interval(_orders(spark, sf_dir), validity(spark), "o_orderdate", "start", "stop", "path", "path").select("o_orderkey", "path")


@Q.add("era_lookup", f"select o_orderkey, coalesce(arg_max(row * 1.0::double, row), 0.0::double) as era from orders left join {VALIDITY_SQL} on o_orderdate > start and o_orderdate < stop group by o_orderkey")
def era_lookup(spark, sf_dir):
    """Open interval, 0.0 where no era holds the time."""
    eras = validity(spark).withColumn("era", F.col("row").cast("double"))
    return asof.within_interval(_orders(spark, sf_dir), eras, "o_orderdate", "start", "stop", "era", "era", 0.0, ">", "<").select("o_orderkey", "era")


WINDOWS = [("2024-01-03 00:00:00", "2024-01-05 12:00:00"), ("2024-01-12 06:00:00", "2024-01-12 18:00:00"), ("2024-01-20 00:00:00", "2024-01-22 00:00:00")]
WINDOWS_SQL = "(values " + ", ".join(f"(timestamp '{a}', timestamp '{b}')" for a, b in WINDOWS) + ") w(start, stop)"


def service_windows(spark):
    rows = spark.createDataFrame(WINDOWS, "start string, stop string")
    return rows.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("stop").cast("timestamp_ntz").alias("stop"))


@Q.add("anti_range_service_windows", f"select event_id, ts from events where not exists (select 1 from {WINDOWS_SQL} where ts between start and stop)")
def anti_range_service_windows(spark, sf_dir):
    return asof.outside_windows(table(spark, sf_dir, "events").select("event_id", "ts"), service_windows(spark), "ts", "start", "stop")


JUNK_SQL = "(select l_orderkey as junk from lineitem where l_returnflag = 'R' and l_discount > 0.09 group by 1)"


def _junk(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' and l_discount > 0.09").select(F.col("l_orderkey").alias("junk")).distinct()


@Q.add("junk_flag", f"select o_orderkey, junk is null as not_junk from orders left join {JUNK_SQL} on o_orderkey = junk")
def junk_flag(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.join(_junk(spark, sf_dir), orders["o_orderkey"] == F.col("junk"), "left").select("o_orderkey", F.col("junk").isNull().alias("not_junk"))


@Q.add("junk_anti", f"select o_orderkey from orders where o_orderkey not in (select junk from {JUNK_SQL})")
def junk_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.join(_junk(spark, sf_dir), orders["o_orderkey"] == F.col("junk"), "left_anti").select("o_orderkey")


@Q.add(
    "cal_lookup_fallback",
    f"""with n as ({NEAREST_SQL.format(days=5, more="")}), v as (select o_orderkey, arg_max(path, row) as path from orders left join {VALIDITY_SQL} on o_orderdate >= start and o_orderdate < stop group by o_orderkey)
    select o.obs, coalesce('db:' || a.cid, 'db:' || r.cid, 'file:' || v.path, 'default') as found
    from {OBSERVATIONS} o left join n a on a.obs = o.obs and a.caltype = 'A' left join n r on r.obs = o.obs and r.caltype = 'R' left join v on v.o_orderkey = o.obs""",
)
def cal_lookup_fallback(spark, sf_dir):
    """Ranked strategies: nearest of the first type, of the second type, the validity list, a default."""
    near = _nearest(spark, sf_dir, 5).groupBy("obs").pivot("caltype", ["A", "R"]).agg(F.first("cid"))
    listed = interval_validity_join(spark, sf_dir).withColumnRenamed("o_orderkey", "obs")
    obs = observations(spark, sf_dir).join(near, "obs", "left").join(listed, "obs", "left")
    found = F.coalesce(F.concat(F.lit("db:"), F.col("A").cast("string")), F.concat(F.lit("db:"), F.col("R").cast("string")), F.concat(F.lit("file:"), "path"), F.lit("default"))
    return obs.select("obs", found.alias("found"))


GOOD = "g as (select user_id, ts from events where event_type = 'signup' and value > 20), e as (select event_id, user_id, ts from events where event_type = 'error')"


@Q.add(
    "days_since_last_good",
    f"""with {GOOD} select e.event_id, round(min(case when g.ts <= e.ts then (epoch_us(e.ts) - epoch_us(g.ts)) / 86400e6 end), 6) as since_last,
      round(min(case when g.ts > e.ts then (epoch_us(g.ts) - epoch_us(e.ts)) / 86400e6 end), 6) as until_next
      from e left join g on g.user_id = e.user_id and abs(epoch_us(e.ts) - epoch_us(g.ts)) <= 90 * 86400000000 group by e.event_id""",
)
def days_since_last_good(spark, sf_dir):
    """Days since the last and until the next good calibration within 90 days."""
    events = table(spark, sf_dir, "events")
    good = events.filter("event_type = 'signup' and value > 20").select("user_id", "ts", F.struct(F.col("ts").alias("t")).alias("v"))
    rows = events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    rows = asof.asof_after(asof.asof_before(rows, good, ["user_id"], "ts", "v", "before", False), good, ["user_id"], "ts", "v", "after", True)
    since, until = (seconds(F.col("ts")) - seconds(F.col("before.t"))) / 86400, (seconds(F.col("after.t")) - seconds(F.col("ts"))) / 86400
    return rows.select("event_id", F.round(F.when(since <= 90, since), 6).alias("since_last"), F.round(F.when(until <= 90, until), 6).alias("until_next"))


@Q.add(
    "status_progress",
    """with d as (select l_orderkey, count(*) as n, max(l_shipdate) as last from lineitem where l_linestatus = 'F' group by 1)
    select strftime(o_orderdate, '%Y%m') as night, count(*) as total, count(d.n) as done, count(*) filter (where d.last > o_orderdate + interval 60 day) as late,
      cast(floor(100.0 * count(d.n) / count(*)) as bigint) as percent from orders left join d on o_orderkey = l_orderkey group by 1""",
)
def status_progress(spark, sf_dir):
    """Products of each night that exist and that are late, and the whole percent done."""
    done = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("last"))
    orders = table(spark, sf_dir, "orders")
    both = orders.join(done, orders["o_orderkey"] == done["l_orderkey"], "left")
    out = both.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("night")).agg(F.count("*").alias("total"), F.count("n").alias("done"), F.count_if(F.expr("last > o_orderdate + interval 60 days")).alias("late"))
    return out.withColumn("percent", F.floor(F.lit(100.0) * F.col("done") / F.col("total")).cast("long"))
