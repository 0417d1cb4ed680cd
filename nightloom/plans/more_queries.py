"""Queries of peak lists, midpoints, candidate lists, fits and ephemerides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof, selection
from ..operators import sequences as W
from ..operators import statistics as A
from ._common import Queries, table

Q = Queries()
USER, TIME = ["user_id"], ["ts", "event_id"]


@Q.add(
    "photon_midpoint",
    """with e as (select user_id, epoch_us(ts) / 1e6 as b, epoch_us(ts) / 1e6 + 600 as e, value from events), r as (select *, value / (e - b) as rate, b - lag(e) over w as gap, lag(value / (e - b)) over w as last_rate from e window w as (partition by user_id order by b)),
    c as (select *, sum(value + coalesce(gap * (last_rate + rate) / 2, 0)) over (partition by user_id order by b rows unbounded preceding) as total from r), h as (select *, max(total) over (partition by user_id) / 2 as half from c)
    select user_id, round(min(b + (half - (total - value)) / nullif(value, 0) * (e - b)), 3) as midpoint from h where total >= half and total - value <= half group by 1""",
)
def photon_midpoint(spark, sf_dir):
    """When half of the photons have come; a group whose half falls into a gap has none."""
    t = S.seconds(F.col("ts"))
    out = W.photon_midpoint(table(spark, sf_dir, "events").select("user_id", t.alias("b"), (t + 600).alias("e"), "value"), USER, "b", "e", "value")
    return out.withColumn("midpoint", F.round("midpoint", 3))


@Q.add(
    "spacing_outliers",
    """with s as (select user_id, event_id, ts, lead(epoch_us(ts) / 1e6) over w - epoch_us(ts) / 1e6 as step from events window w as (partition by user_id order by ts, event_id)),
    m as (select *, quantile_cont(step, 0.5) over (partition by user_id order by ts, event_id rows between 4 preceding and 4 following) as usual from s) select event_id, round(step, 4) as step from m where abs(step - usual) > 3 * abs(usual)""",
)
def spacing_outliers(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", S.seconds(F.col("ts")).alias("t"))
    return W.spacing_outliers(rows, USER, TIME, "t", 4, 3.0).select("event_id", F.round("step", 4).alias("step"))


@Q.add(
    "close_peaks",
    """with p as (select user_id, event_id, epoch_us(ts) / 1e6 as t, case event_type when 'signup' then 0 when 'purchase' then 1 else 2 end as r from events),
    n as (select *, lag(r) over w as pr, lag(t) over w as pt, lead(r) over w as lr, lead(t) over w as lt from p window w as (partition by user_id order by t, r))
    select event_id from n where not coalesce(t - pt < 3600 and pr <= r, false) and not coalesce(lt - t < 3600 and lr < r, false)""",
)
def close_peaks(spark, sf_dir):
    """Peaks of neighbouring orders that are the same line: the better source stays."""
    rank = F.when(F.col("event_type") == "signup", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", S.seconds(F.col("ts")).alias("t"))
    return W.without_close_neighbours(rows, USER, "t", 3600.0, rank).select("event_id")


@Q.add(
    "good_comb_orders",
    """with n as (select user_id, event_id, value, lag(value) over w as b, lead(value) over w as a, row_number() over w - 1 as k, count(*) over (partition by user_id) as total from events window w as (partition by user_id order by ts, event_id)),
    p as (select user_id, cast(floor(8.0 * k / total) as int) as region from n where value > b and value > a and value >= 60) select user_id, count(*) as n_lines, count(distinct region) as n_regions, count(*) >= 8 and count(distinct region) = 8 as good from p group by 1""",
)
def good_comb_orders(spark, sf_dir):
    """Lines of each order, and whether there are enough of them in every eighth of it."""
    w = W.ordered(USER, TIME)
    rows = table(spark, sf_dir, "events").withColumn("k", F.row_number().over(w) - 1).withColumn("total", F.count("*").over(W.Window.partitionBy(*USER)))
    peaks = W.local_maxima(rows, USER, TIME, "value", 60).withColumn("region", F.floor(8.0 * F.col("k") / F.col("total")))
    return peaks.groupBy("user_id").agg(F.count("*").alias("n_lines"), F.count_distinct("region").alias("n_regions"), ((F.count("*") >= 8) & (F.count_distinct("region") == 8)).alias("good"))


@Q.add("saturated_lines", "with n as (select user_id, value, lag(value) over w as b, lead(value) over w as a from events window w as (partition by user_id order by ts, event_id)) select user_id, count(*) filter (where value > b and value > a and value >= 95) as n from n group by 1")
def saturated_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    peaks = W.local_maxima(events, USER, TIME, "value", 95).groupBy("user_id").agg(F.count("*").alias("n"))
    return events.select("user_id").distinct().join(peaks, "user_id", "left").select("user_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


@Q.add(
    "drift_candidates",
    """select event_id, nullif(regexp_extract('/m/' || strftime(ts, '%Y%m%d') || '/etalon_' || event_type || '.fits', '(\\d{8})', 1), '') as mask_date from events
    where user_id % 13 <> 0 and regexp_matches(event_type, '^(c|p)') and value > 5 and value <= 80 and strftime(ts, '%Y%m%d') = strftime(ts - interval 3 hour, '%Y%m%d')""",
)
def drift_candidates(spark, sf_dir):
    """Frames that can serve as a reference: not junk, of the kind, of fair signal, calibrated on their own date."""
    path = F.concat(F.lit("/m/"), S.datecode(F.col("ts")), F.lit("/etalon_"), "event_type", F.lit(".fits"))
    rows = table(spark, sf_dir, "events").withColumn("mask_date", S.first_datecode(path))
    good = (F.col("user_id") % 13 != 0) & F.col("event_type").rlike("^(c|p)") & (F.col("value") > 5) & (F.col("value") <= 80)
    return rows.filter(good & (F.col("mask_date") == S.datecode(F.expr("ts - interval 3 hours")))).select("event_id", "mask_date")


@Q.add(
    "clear_interval_stats",
    """with x as (select o.event_id, o.ts as a, o.ts + to_seconds(7200) as b from events o where o.event_type = 'signup')
    select x.event_id, bool_and(e.value < 90) as clear, round(avg(e.value), 7) as mean, round(stddev_pop(e.value), 6) as std, count(*) as n from x join events e on e.ts >= x.a and e.ts < x.b group by 1""",
)
def clear_interval_stats(spark, sf_dir):
    """Sky samples within the two hours of each exposure."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", at.alias("at"))
    out = A.interval_stats(events, events.filter("event_type = 'signup'"), "event_id", "at", "at", "value", 7200 * 1_000_000, 90)
    return out.select("event_id", "clear", F.round("mean", 7).alias("mean"), F.round("std", 6).alias("std"), "n")


@Q.add(
    "nearest_mean_mjd",
    """with m as (select l_suppkey as id, l_returnflag as kind, (min(40587 + epoch_us(l_shipdate) / 86400e6) + max(40587 + epoch_us(l_shipdate) / 86400e6)) / 2 as mid from lineitem group by 1, 2),
    o as (select o_orderkey as obs, 40587 + epoch_us(o_orderdate) / 86400e6 as t from orders),
    k as (select obs, kind, id, row_number() over (partition by obs, kind order by abs(mid - t), mid, id) as k from o join m on abs(mid - t) <= 365) select obs, kind, id from k where k = 1""",
)
def nearest_mean_mjd(spark, sf_dir):
    """Nearest master by the middle of the time it was made from, within a year."""
    m = S.mjd(F.col("l_shipdate"))
    masters = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("kind")).agg(((F.min(m) + F.max(m)) / 2).alias("mid"))
    masters = masters.groupBy("kind", "mid").agg(F.min("id").alias("id")).select("kind", F.col("mid").alias("t"), F.struct("mid", "id").alias("v"))
    obs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs"), S.mjd(F.col("o_orderdate")).alias("t"), F.explode(F.array(*[F.lit(k) for k in "ANR"])).alias("kind"))
    near = asof.asof_nearest(obs, masters, ["kind"], "t", "v", "mid", "near", 365, 30)
    return near.filter("near is not null").select("obs", "kind", "near.id")


@Q.add("rv_per_order", "with f as (select vec_id, label, unnest(embedding)::double as rv, unnest(range(64)) as ord from embeddings) select label, cast(ord as int) as ord, round(avg(rv), 6) as rv, round(stddev_samp(rv), 6) as scatter from f group by 1, 2")
def rv_per_order(spark, sf_dir):
    """Velocity per order and its scatter, from one array per observation."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("ord", "x")).withColumn("x", F.col("x").cast("double"))
    return rows.groupBy("label", "ord").agg(F.round(F.avg("x"), 6).alias("rv"), F.round(F.stddev_samp("x"), 6).alias("scatter"))


@Q.add(
    "bootstrap_median",
    "with r as (select event_type, value, event_id, k from events, range(30) t(k) where ((event_id * 7919 + k * 104729)::hugeint * 2654435761) % 4294967296 < 2147483648), m as (select event_type, k, median(value) as m from r group by 1, 2) select event_type, round(stddev_pop(m), 6) as uncertainty, count(*) as rounds from m group by 1",
)
def bootstrap_median(spark, sf_dir):
    out = A.bootstrap_median(table(spark, sf_dir, "events"), ["event_type"], "value", "event_id", 30)
    return out.withColumn("uncertainty", F.round("uncertainty", 6))


@Q.add(
    "line_fit",
    "with s as (select user_id, regr_slope(value, hour(ts)) as s, regr_intercept(value, hour(ts)) as i, regr_sxx(value, hour(ts)) as xx, regr_syy(value, hour(ts)) as yy, count(*) as n from events group by 1) select user_id, round(s, 6) as slope, round(i, 5) as intercept, round(sqrt(greatest(yy - s * s * xx, 0) / n), 5) as rms, n from s",
)
def line_fit(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "value", F.hour("ts").cast("double").alias("h"))
    out = A.line_fit(rows, USER, "h", "value")
    return out.select("user_id", F.round("slope", 6).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("rms", 5).alias("rms"), "n")


_N = "(epoch_us(ts) / 86400e6 + 40587 - 51544.5)"
_L = f"(radians(280.460 + 0.9856474 * {_N}) + radians(1.915 * sin(radians(357.528 + 0.9856003 * {_N})) + 0.020 * sin(2 * radians(357.528 + 0.9856003 * {_N}))))"
_E = f"radians(23.439 - 0.0000004 * {_N})"


@Q.add(
    "sun_altitude",
    f"with s as (select event_id, ts, asin(sin({_E}) * sin({_L})) as d, atan2(cos({_E}) * sin({_L}), cos({_L})) as a, radians(280.46061837 + 360.98564736629 * {_N} - 155.4747) as st from events) select event_id, round(degrees(asin(sin(radians(19.8264)) * sin(d) + cos(radians(19.8264)) * cos(d) * cos(st - a))), 4) as altitude from s",
)
def sun_altitude(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(S.sun_altitude(F.col("ts"), 19.8264, -155.4747), 4).alias("altitude"))


@Q.add(
    "read_speed",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_partkey % 3 = 0 then 'fast' when l_partkey % 3 = 1 then 'regular' when l_quantity < 20 then 'fast' else 'regular' end as speed from lineitem",
)
def read_speed(spark, sf_dir):
    """By the name of the waveform file, else by the time the read took."""
    k = F.col("l_partkey") % 3
    name = F.when(k == 0, "wave_fast.txt").when(k == 1, "wave_regular.txt").otherwise("unknown.txt")
    rules = [("fast", name.contains("fast")), ("regular", name.contains("regular")), ("fast", F.col("l_quantity") < 20)]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", selection.classified(rules, F.lit("regular")).alias("speed"))


@Q.add("levels_expected", "select o_orderkey, case when o_orderstatus in ('O') then 'L0,2D,L1,L2' when o_orderstatus = 'F' then 'L0,2D,L1' else 'L0,2D' end as levels from orders")
def levels_expected(spark, sf_dir):
    names = lambda *x: F.array_join(F.array(*[F.lit(i) for i in x]), ",")
    s = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(s.isin("O"), names("L0", "2D", "L1", "L2")).when(s == "F", names("L0", "2D", "L1")).otherwise(names("L0", "2D")).alias("levels"))


@Q.add(
    "peak_track",
    """with recursive e as (select user_id, cast(strftime(ts, '%d') as int) as night, value from events), n as (select user_id, night, row_number() over (partition by user_id order by night) as k from (select distinct user_id, night from e)),
    d as (select e.*, k from e join n using (user_id, night)), r(user_id, k, night, position, met) as (
      select user_id, 0::bigint, 0, median(value), true from e group by 1
      union all
      select r.user_id, x.k, x.night, case when x.gap <= 15 then x.value else r.position end, x.gap <= 15 from r join lateral (
        select d.k, d.night, d.value, abs(d.value - r.position) as gap from d where d.user_id = r.user_id and d.k = r.k + 1 order by gap, d.value limit 1) x on true)
    select user_id, night, round(position, 6) as position, met from r where k > 0""",
)
def peak_track(spark, sf_dir):
    """A line's position followed from night to night."""
    rows = table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts").alias("night"), "value")
    out = W.tracked(rows, USER, "night", "value", F.median("value"), 15.0)
    return out.select("user_id", F.col("step").alias("night"), F.round("position", 6).alias("position"), "met")


# readings of one user count as one exposure
_LIMITS = "[" + ", ".join(f"{W.outlier_limit(n)!r}::double" for n in range(4, 1001)) + "]"


@Q.add(
    "neighbour_replaced",
    f"""with recursive s as (select user_id, list(value order by ts, event_id) as v, list(event_id order by ts, event_id) as ids, count(*)::int as n from events where value is not null and not isnan(value) group by 1),
    r(user_id, v, n, k, done) as (select user_id, v, n, 0, n < 4 from s union all
      select user_id, case when go then list_concat(list_concat(v[:w - 1], [instead[w]]), v[w + 1:]) else v end, n, k + 1, not go or k + 1 >= n // 4
      from (select *, abs(d[w]) > ({_LIMITS})[n - 3] * {W.MAD_SIGMA} * list_aggregate(d, 'mad') and v[w] in (list_max(near), list_min(near)) as go
        from (select *, v[greatest(1, w - 3):w + 3] as near
          from (select *, list_position(list_transform(d, lambda x: abs(x)), list_max(list_transform(d, lambda x: abs(x)))) as w, list_transform(range(1, n + 1), lambda i: case when i in (1, n) then v[i] - d[i] else (v[i - 1] + v[i + 1]) / 2 end) as instead
            from (select *, list_transform(range(1, n + 1), lambda i: list_reduce([v[i] - (case i when 1 then v[2] + v[3] when n then v[n - 1] + v[n - 2] else v[i - 1] + v[i + 1] end) / 2, v[i] - v[case i when 1 then 2 else i - 1 end], v[i] - v[case i when n then n - 1 else i + 1 end]], lambda p, q: case when abs(q) < abs(p) then q else p end)) as d
              from r where not done))))),
    f as (select user_id, arg_max(v, k) as v from r where done group by 1)
    select s.user_id, unnest(ids) as event_id, round(unnest(f.v), 6) as settled from s join f using (user_id)""",
)
def neighbour_replaced(spark, sf_dir):
    """Each user's readings with outliers replaced by their neighbours, the worst first."""
    rows = table(spark, sf_dir, "events").filter("value is not null and not isnan(value)")
    out = W.neighbours_replaced(rows, USER, TIME, "value")
    return out.select("user_id", "event_id", F.round("settled", 6).alias("settled"))
