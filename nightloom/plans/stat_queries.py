"""Queries of grouped statistics and ordered sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import seconds
from ..operators import sequences as W
from ..operators import statistics as A
from ..operators.quantiles import exact_medians, exact_percentiles
from ._common import Queries, table

Q = Queries()


@Q.add(
    "nobs_by_day_filled",
    "with d as (select cast(ts as date) as day, count(*) as n from events where event_type = 'error' group by 1), e as (select min(day) as a, max(day) as b from d) select cast(s.day as date) as day, coalesce(n, 0) as n from (select unnest(generate_series(a, b, interval 1 day)) as day from e) s left join d on d.day = s.day",
)
def nobs_by_day_filled(spark, sf_dir):
    return A.filled_days(table(spark, sf_dir, "events").filter("event_type = 'error'"), "ts")


@Q.add("nobs_by_hour_filled", "with h as (select hour(ts) as bin, count(*) as n from events where value > 97 group by 1) select cast(range as int) as bin, coalesce(n, 0) as n from range(24) left join h on bin = range")
def nobs_by_hour_filled(spark, sf_dir):
    return A.filled_histogram(table(spark, sf_dir, "events").filter("value > 97"), F.hour("ts"), 0, 23)


TYPES = ["click", "error", "purchase", "signup", "view"]


@Q.add("nobs_pivot", "select cast(ts as date) as day, " + ", ".join(f"count(*) filter (where event_type = '{t}') as {t}" for t in TYPES) + " from events where user_id % 3 <> 0 group by 1")
def nobs_pivot(spark, sf_dir):
    """Counts per day and source side by side."""
    events = table(spark, sf_dir, "events").filter("user_id % 3 <> 0")
    return events.groupBy(F.to_date("ts").alias("day")).pivot("event_type", TYPES).count().na.fill(0)


@Q.add(
    "panel_transform",
    "with m as (select event_type, median(value) as m from events group by 1) select event_id, round(value - m, 6) as less_median, round(value / nullif(m, 0), 6) as over_median, round((value * 1000 + 5) - user_id, 6) as moved from events join m using (event_type)",
)
def panel_transform(spark, sf_dir):
    """Offset, factor, difference of columns, and values relative to their median."""
    events = table(spark, sf_dir, "events")
    less = A.centred(events, ["event_type"], "value", "subtract").withColumnRenamed("centred", "less_median")
    both = A.centred(less, ["event_type"], "value", "normalize")
    return both.select("event_id", F.round("less_median", 6).alias("less_median"), F.round("centred", 6).alias("over_median"), F.round((F.col("value") * 1000 + 5) - F.col("user_id"), 6).alias("moved"))


@Q.add("state_panel", "select event_id, event_type, cast(dense_rank() over (order by event_type) as int) as state from events")
def state_panel(spark, sf_dir):
    return A.states(table(spark, sf_dir, "events"), "event_type", "event_id")


@Q.add("campaign_having", "select user_id, count(*) as n from events where cast(ts as date) = date '2024-01-10' group by 1 having count(*) >= 4")
def campaign_having(spark, sf_dir):
    return table(spark, sf_dir, "events").filter("to_date(ts) = date'2024-01-10'").groupBy("user_id").agg(F.count("*").alias("n")).filter("n >= 4")


@Q.add(
    "performance_by_day",
    """select strftime(ts, '%Y%m%d') as datecode, round(sqrt(avg(value * value)), 6) as rms, round(max(value) - min(value), 6) as range, round(arg_max(value, ts) - arg_min(value, ts), 6) as drift,
      round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, max(value) as max, min(value) as min, count(*) as n from events group by 1""",
)
def performance_by_day(spark, sf_dir):
    out = A.performance(table(spark, sf_dir, "events"), F.date_format("ts", "yyyyMMdd"), "datecode", "value", "ts")
    return out.select("datecode", *[F.round(c, 6).alias(c) for c in ("rms", "range", "drift", "mean", "std")], "max", "min", "n")


@Q.add(
    "spec_violations",
    """with p as (select strftime(ts, '%Y%m%d') as datecode, sqrt(avg(value * value)) as rms, arg_max(value, ts) - arg_min(value, ts) as drift, stddev_samp(value) as std from events group by 1)
    select datecode, rms > 36 as too_noisy, abs(drift) > 30 as drifts, (std > 33 and rms < 40) as uneven, (rms > 36 or abs(drift) > 30 or (std > 33 and rms < 40)) as any_violation from p""",
)
def spec_violations(spark, sf_dir):
    stats = A.performance(table(spark, sf_dir, "events"), F.date_format("ts", "yyyyMMdd"), "datecode", "value", "ts")
    out = A.violations(stats, {"too_noisy": "rms > 36", "drifts": "abs(drift) > 30", "uneven": "std > 33 and rms < 40"})
    return out.select("datecode", "too_noisy", "drifts", "uneven", "any_violation")


@Q.add(
    "weighted_mean_std",
    "with m as (select l_returnflag as flag, sum(l_quantity * l_extendedprice) / sum(l_quantity) as mean from lineitem group by 1) select flag, round(mean, 4) as mean, round(sqrt(sum(l_quantity * (l_extendedprice - mean) ** 2) / sum(l_quantity)), 4) as std from lineitem join m on l_returnflag = flag group by flag, mean",
)
def weighted_mean_std(spark, sf_dir):
    out = A.weighted_two_pass(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "flag"), ["flag"], "l_extendedprice", "l_quantity")
    return out.select("flag", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


def _clip_sql(rounds, sigma):
    sql = "with r0 as (select l_linenumber as k, l_extendedprice as x, l_quantity as w from lineitem where l_quantity <> 0 and l_extendedprice <> 0)"
    for i in range(rounds):
        sql += f""", m{i} as (select k, sum(w * x) / sum(w) as m from r{i} group by 1), s{i} as (select r.k, m, sqrt(sum(w * (x - m) ** 2) / sum(w)) as s from r{i} r join m{i} on r.k = m{i}.k group by 1, 2),
        r{i + 1} as (select r.k, x, w from r{i} r join s{i} on r.k = s{i}.k where abs(x - m) <= {sigma} * s)"""
    return sql + f" select k, round(sum(w * x) / sum(w), 4) as mean, count(*) as n from r{rounds} group by 1"


@Q.add("weighted_clip_k", _clip_sql(7, 3.0))
def weighted_clip_k(spark, sf_dir):
    """Up to seven rounds of clipping at 3 sigma; a round that drops nothing changes nothing."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("k"), F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("w"))
    return A.weighted_clip(lines, ["k"], "x", "w", 7, 3.0).select("k", F.round("mean", 4).alias("mean"), "n")


@Q.add("weighted_rv_error", "select l_suppkey, round(sqrt(1 / nullif(sum(case when l_discount <> 0 then l_quantity / (l_discount * l_discount) end), 0)), 8) as error from lineitem group by 1")
def weighted_rv_error(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(A.weighted_error("l_discount", "l_quantity"), 8).alias("error"))


@Q.add(
    "l2_weighted_stats",
    """with m as (select l_orderkey, sum(l_quantity * l_tax) / sum(l_quantity) as mean, max(l_tax) - min(l_tax) as spread from lineitem group by 1)
    select l.l_orderkey, round(m.mean, 8) as mean, round(sqrt(sum(l_quantity * (l_tax - mean) ** 2) / sum(l_quantity)), 8) as std, m.spread, round(100 * max((l_tax - mean) / nullif(mean, 0)), 6) + 0.0 as most, round(100 * min((l_tax - mean) / nullif(mean, 0)), 6) + 0.0 as least
    from lineitem l join m on l.l_orderkey = m.l_orderkey group by 1, m.mean, m.spread""",
)
def l2_weighted_stats(spark, sf_dir):
    """Weighted mean and spread over orders, and the largest changes in percent."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_tax")
    m = lines.groupBy("l_orderkey").agg(A.weighted("l_tax", "l_quantity")[0].alias("mean"), (F.max("l_tax") - F.min("l_tax")).alias("spread"))
    x = (F.col("l_tax") - F.col("mean")) / F.nullif(F.col("mean"), F.lit(0.0))
    std = F.sqrt(F.sum(F.col("l_quantity") * F.pow(F.col("l_tax") - F.col("mean"), 2)) / F.sum("l_quantity"))
    out = lines.join(m, "l_orderkey").groupBy("l_orderkey", "mean", "spread").agg(F.round(std, 8).alias("std"), (F.round(100 * F.max(x), 6) + 0.0).alias("most"), (F.round(100 * F.min(x), 6) + 0.0).alias("least"))
    return out.withColumn("mean", F.round("mean", 8))


@Q.add(
    "stack_clip",
    """with p as (select l_linenumber as pixel, quantile_cont(l_extendedprice, 0.16) as a, quantile_cont(l_extendedprice, 0.5) as m, quantile_cont(l_extendedprice, 0.84) as b from lineitem group by 1),
    k as (select pixel, m, (b - a) / 2 as s, case when abs(l_extendedprice - m) <= 2.5 * ((b - a) / 2) then l_extendedprice end as x from lineitem join p on l_linenumber = pixel)
    select pixel, round(m, 4) as center, round(s, 4) as spread, round(avg(x), 4) as mean, round(var_pop(x) * 1.100510 * 1.100510 / 1e6, 4) as variance_m, count(x) as n, round(sqrt(var_pop(x) * 1.100510 * 1.100510 / count(x)), 4) as uncertainty from k group by pixel, m, s""",
)
def stack_clip(spark, sf_dir):
    """Clipped mean of a stack of frames per pixel."""
    frames = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("pixel"), "l_extendedprice")
    out = A.clipped_stack(frames, ["pixel"], "l_extendedprice", 2.5, large=True)
    return out.select("pixel", *[F.round(c, 4).alias(c) for c in ("center", "spread", "mean")], F.round(F.col("variance") / 1e6, 4).alias("variance_m"), "n", F.round("uncertainty", 4).alias("uncertainty"))


@Q.add("stack_median_mad", "with m as (select l_suppkey as pixel, median(l_quantity) as center from lineitem group by 1) select pixel, center, median(abs(l_quantity - center)) as mad, count(*) as n from lineitem join m on l_suppkey = pixel group by 1, 2")
def stack_median_mad(spark, sf_dir):
    return A.median_stack(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pixel"), "l_quantity"), ["pixel"], "l_quantity")


@Q.add(
    "clip_global",
    """with p as (select quantile_cont(value, 0.16) as a, quantile_cont(value, 0.5) as m, quantile_cont(value, 0.84) as b from events)
    select round(m, 6) as center, round(avg(value) filter (where abs(value - m) <= 2.0 * (b - a) / 2), 6) as mean, count(*) filter (where abs(value - m) <= 2.0 * (b - a) / 2) as n from events, p group by m""",
)
def clip_global(spark, sf_dir):
    out = A.clipped_stack(table(spark, sf_dir, "events").select("value"), [], "value", 2.0, large=True)
    return out.select(F.round("center", 6).alias("center"), F.round("mean", 6).alias("mean"), "n")


@Q.add(
    "pct_in_out_mask",
    "with f as (select unnest([0.1, 0.5, 0.9, 0.98]) as fraction), q as (select fraction, event_type, quantile_cont(value, [0.1, 0.5, 0.9, 0.98]) filter (where user_id % 4 = 0) as i, quantile_cont(value, [0.1, 0.5, 0.9, 0.98]) filter (where user_id % 4 <> 0) as o from events, f group by 1, 2) select event_type, cast(fraction as double) as fraction, round(i[list_position([0.1, 0.5, 0.9, 0.98], fraction)], 6) as inside, round(o[list_position([0.1, 0.5, 0.9, 0.98], fraction)], 6) as outside, round(i[list_position([0.1, 0.5, 0.9, 0.98], fraction)] / o[list_position([0.1, 0.5, 0.9, 0.98], fraction)], 6) as ratio from q",
)
def pct_in_out_mask(spark, sf_dir):
    out = A.percentiles_by_mask(table(spark, sf_dir, "events"), ["event_type"], "value", F.col("user_id") % 4 == 0, [0.1, 0.5, 0.9, 0.98])
    return out.select("event_type", "fraction", *[F.round(c, 6).alias(c) for c in ("inside", "outside", "ratio")])


@Q.add(
    "region_median",
    "with r(region, lo, hi) as (values (1, 0, 30), (2, 25, 60), (3, 100, 150)) select region, round(median(value) / 0.5, 6) as per_hour from events join r on user_id >= lo and user_id < hi group by 1",
)
def region_median(spark, sf_dir):
    """Median of each detector region per hour; regions may overlap."""
    regions = spark.createDataFrame([(1, 0, 30), (2, 25, 60), (3, 100, 150)], "region int, lo int, hi int")
    inside = table(spark, sf_dir, "events").join(F.broadcast(regions), (F.col("user_id") >= F.col("lo")) & (F.col("user_id") < F.col("hi")))  # three rows
    return exact_medians(inside, ["region"], "value").select("region", F.round(F.col("median") / 0.5, 6).alias("per_hour"))


@Q.add("snr_p95", "select l_returnflag, l_linenumber, round(quantile_cont(l_extendedprice / sqrt(abs(nullif(l_quantity, 0))), 0.95), 4) as snr, max(l_extendedprice) as peak from lineitem group by 1, 2")
def snr_p95(spark, sf_dir):
    snr = F.col("l_extendedprice") / F.sqrt(F.abs(F.nullif(F.col("l_quantity"), F.lit(0.0))))
    lines, by = table(spark, sf_dir, "lineitem").withColumn("snr", snr), ["l_returnflag", "l_linenumber"]
    p95 = exact_percentiles(lines, by, "snr", [0.95]).select(*by, F.round(F.get("percentiles", F.lit(0)), 4).alias("snr"))
    return lines.groupBy(*by).agg(F.max("l_extendedprice").alias("peak")).join(p95, by, "left")


@Q.add("nan_count", "select label, count(*) filter (where x < -1) as n_bad, round(avg(case when x >= -1 then x end), 6) as mean from (select label, unnest(embedding)::double as x from embeddings) group by 1")
def nan_count(spark, sf_dir):
    """Values marked as NaN are counted and left out of the mean."""
    flat = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    flat = flat.withColumn("x", F.col("x").cast("double")).withColumn("x", F.when(F.col("x") < -1, F.lit(float("nan"))).otherwise(F.col("x")))
    return flat.groupBy("label").agg(F.count_if(F.isnan("x")).alias("n_bad"), F.round(F.avg(A.finite(F.col("x"))), 6).alias("mean"))


@Q.add(
    "ratio_median",
    "with a as (select l_orderkey, l_extendedprice as x from lineitem where l_linenumber = 1), b as (select l_orderkey, l_extendedprice as y, l_suppkey % 10 as k from lineitem where l_linenumber = 2) select k, round(median(x / nullif(y, 0)), 6) as ratio, count(*) as n from a join b using (l_orderkey) group by 1",
)
def ratio_median(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    a = lines.filter("l_linenumber = 1").select("l_orderkey", F.col("l_extendedprice").alias("x"))
    b = lines.filter("l_linenumber = 2").select("l_orderkey", F.col("l_extendedprice").alias("y"), (F.col("l_suppkey") % 10).alias("k"))
    return a.join(b, "l_orderkey").groupBy("k").agg(F.round(F.median(F.col("x") / F.nullif(F.col("y"), F.lit(0.0))), 6).alias("ratio"), F.count("*").alias("n"))


@Q.add(
    "guiding_rms",
    """select cast(ts as date) as day, case when count(distinct user_id) > 100 then round(sqrt(avg((value - 50) ** 2)), 6) end as rms_x, case when count(distinct user_id) > 100 then round(sqrt(avg((value / 2 - 20) ** 2 + (value - 50) ** 2)), 6) end as rms_r,
      round(avg(value - 50), 6) as bias_x from events group by 1""",
)
def guiding_rms(spark, sf_dir):
    """Errors of the guider; too few distinct frames give none."""
    x, y = F.col("value") - 50, F.col("value") / 2 - 20
    enough = F.count_distinct("user_id") > 100
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.when(enough, F.round(A.rms(x), 6)).alias("rms_x"), F.when(enough, F.round(F.sqrt(F.avg(F.pow(y, 2) + F.pow(x, 2))), 6)).alias("rms_r"), F.round(F.avg(x), 6).alias("bias_x")
    )


@Q.add("band_sums", "with f as (select vec_id, unnest(embedding)::double as x, unnest(range(64)) as i from embeddings) select vec_id, round(sum(x) filter (where i < 16), 5) as b1, round(sum(x) filter (where i >= 16 and i < 32), 5) as b2, round(sum(x) filter (where i >= 32), 5) as b3 from f group by 1")
def band_sums(spark, sf_dir):
    """Sums in wavelength bands, inside each array and without a shuffle."""
    band = lambda a, n: F.round(F.aggregate(F.slice("embedding", a + 1, n), F.lit(0.0), lambda s, x: s + x.cast("double")), 5)
    return table(spark, sf_dir, "embeddings").select("vec_id", band(0, 16).alias("b1"), band(16, 16).alias("b2"), band(32, 32).alias("b3"))


@Q.add(
    "slope_origin_fit",
    "select user_id, round(sum(hour(ts) * value / ((1 + minute(ts)) ** 2)) / nullif(sum(hour(ts) * hour(ts) / ((1 + minute(ts)) ** 2)), 0), 6) as slope, round(1 / sqrt(nullif(sum(hour(ts) * hour(ts) / ((1 + minute(ts)) ** 2)), 0)), 6) as error from events group by 1",
)
def slope_origin_fit(spark, sf_dir):
    slope, error = A.slope_through_origin(F.hour("ts"), F.col("value"), (1 + F.minute("ts")).cast("double"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(slope, 6).alias("slope"), F.round(error, 6).alias("error"))


@Q.add(
    "reweighting_ratio",
    "with s as (select l_linenumber as k, greatest(quantile_cont(l_extendedprice, 0.95), 0) as level from lineitem group by 1) select k, round(level, 4) as level, round(level / (select max(level) from s), 6) as ratio from s",
)
def reweighting_ratio(spark, sf_dir):
    out = A.share_of_largest(table(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "k"), ["k"], [], "l_extendedprice", 0.95)
    return out.select("k", F.round("level", 4).alias("level"), F.round("ratio", 6).alias("ratio"))


# ordered sequences

BY_USER = "(partition by user_id order by ts, event_id"
USER, TIME = ["user_id"], ["ts", "event_id"]


@Q.add("running_median", f"select event_id, round(quantile_cont(value, 0.5) over {BY_USER} rows between 5 preceding and 4 following), 6) as running from events")
def running_median(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(W.running_median("value", W.ordered(USER, TIME), 5), 6).alias("running"))


@Q.add("running_std", f"select event_id, round(stddev_pop(value) over {BY_USER} rows between 5 preceding and 4 following), 6) as running from events")
def running_std(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(W.running_std("value", W.ordered(USER, TIME), 5), 6).alias("running"))


@Q.add("monotonic", "with s as (select l_orderkey, l_shipdate - lag(l_shipdate) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as step from lineitem) select l_orderkey, bool_and(coalesce(step >= interval 0 second, true)) as monotonic from s group by 1")
def monotonic(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("t", seconds(F.col("l_shipdate")))
    return W.monotonic(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "t")


ISLANDS = f"""n as (select user_id, ts, event_id, value, row_number() over {BY_USER}) as n from events), f as (select *, n - row_number() over {BY_USER}) as island from n where value < 60),
    r as (select user_id, island, min(n) as first_row, max(n) as last_row, count(*) as length from f group by 1, 2)"""


@Q.add("consecutive_run", f"with {ISLANDS}, m as (select user_id, max(length) as longest from r group by 1) select u.user_id, coalesce(longest, 0) >= 8 as has_run from (select distinct user_id from events) u left join m using (user_id)")
def consecutive_run(spark, sf_dir):
    return W.has_run(table(spark, sf_dir, "events"), USER, TIME, F.col("value") < 60, 8)


@Q.add("last_run", f"with {ISLANDS} select user_id, arg_max(first_row, first_row) as first_row, arg_max(last_row, first_row) as last_row, arg_max(length, first_row) as length from r group by 1")
def last_run(spark, sf_dir):
    return W.last_run(table(spark, sf_dir, "events"), USER, TIME, F.col("value") < 60)


@Q.add("cum_cdf", f"select event_id, round(sum(value) over {BY_USER} rows unbounded preceding) / sum(value) over (partition by user_id), 8) as cdf from events")
def cum_cdf(spark, sf_dir):
    w = W.ordered(USER, TIME)
    total = F.sum("value").over(W.Window.partitionBy(*USER))
    return table(spark, sf_dir, "events").select("event_id", F.round(W.cumulative("value", w) / total, 8).alias("cdf"))


@Q.add(
    "gap_cdf",
    """with e as (select user_id, event_id, epoch_us(ts) / 1e6 as b, epoch_us(ts) / 1e6 + 600 as e, value from events), r as (select *, value / (e - b) as rate, b - lag(e) over w as gap, lag(value / (e - b)) over w as last_rate from e window w as (partition by user_id order by b))
    select event_id, round(sum(value + coalesce(gap * (last_rate + rate) / 2, 0)) over (partition by user_id order by b rows unbounded preceding), 4) as total from r""",
)
def gap_cdf(spark, sf_dir):
    """Photons up to the end of each exposure, gaps filled at the mean rate of their neighbours."""
    t = seconds(F.col("ts"))
    exposures = table(spark, sf_dir, "events").select("user_id", "event_id", t.alias("b"), (t + 600).alias("e"), "value")
    return W.cumulative_with_gaps(exposures, ["user_id"], "b", "e", "value").select("event_id", F.round("total", 4).alias("total"))


@Q.add(
    "gradient",
    f"with n as (select event_id, value, lag(value) over {BY_USER}) as b, lead(value) over {BY_USER}) as a from events) select event_id, round(case when b is null then a - value when a is null then value - b else (a - b) / 2 end, 6) as slope from n",
)
def gradient(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(W.gradient("value", W.ordered(USER, TIME)), 6).alias("slope"))


_SG = " + ".join(f"{3 * (3 * 100 + 30 - 1 - 5 * i * i) / (23 * 21 * 19)!r} * " + (f"lag(value, {-i}) over {BY_USER})" if i < 0 else f"lead(value, {i}) over {BY_USER})" if i else "value") for i in range(-10, 11))


@Q.add("savgol", f"select event_id, round({_SG}, 6) as smooth from events")
def savgol(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(W.savgol("value", W.ordered(USER, TIME)), 6).alias("smooth"))


@Q.add("local_maxima", f"with n as (select event_id, value, lag(value) over {BY_USER}) as b, lead(value) over {BY_USER}) as a from events) select event_id, value from n where value > b and value > a and value >= 70")
def local_maxima(spark, sf_dir):
    return W.local_maxima(table(spark, sf_dir, "events"), USER, TIME, "value", 70).select("event_id", "value")


@Q.add("neighbour_outliers", f"select event_id from (select event_id, value, greatest(max(value) over {BY_USER} rows between 4 preceding and 1 preceding), max(value) over {BY_USER} rows between 1 following and 4 following)) as m from events) where value > 1.2 * m")
def neighbour_outliers(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("o", W.neighbour_outliers("value", W.ordered(USER, TIME), 4, 1.2))
    return events.filter("o").select("event_id")


@Q.add(
    "sliding_quadratic_qf",
    """with e as (select floor(epoch_us(ts) / 1e6)::bigint as s, value::double as y from events), w as (select s, y, unnest(generate_series(floor((s - 86400) / 21600)::bigint * 21600 + 21600, floor(s / 21600)::bigint * 21600, 21600)) as window_start from e),
    x as (select window_start, (s - window_start - 43200.0) / 43200.0 as x, y from w),
    g as (select window_start, count(*)::double as n, sum(x) as x1, sum(x*x) as x2, sum(x*x*x) as x3, sum(x*x*x*x) as x4, sum(y) as y0, sum(x*y) as y1, sum(x*x*y) as y2, sum(y*y) as yy from x group by 1 having count(*) >= 100),
    d as (select *, n*(x2*x4-x3*x3) - x1*(x1*x4-x3*x2) + x2*(x1*x3-x2*x2) as d from g),
    p as (select *, (y0*(x2*x4-x3*x3) - x1*(y1*x4-x3*y2) + x2*(y1*x3-x2*y2)) / d as p0, (n*(y1*x4-x3*y2) - y0*(x1*x4-x3*x2) + x2*(x1*y2-y1*x2)) / d as p1, (n*(x2*y2-y1*x3) - x1*(x1*y2-y1*x2) + y0*(x1*x3-x2*x2)) / d as p2 from d)
    select window_start, n::bigint as n, round((yy - p0*y0 - p1*y1 - p2*y2) / (y0 / n), 4) as quality from p""",
)
def sliding_quadratic_qf(spark, sf_dir):
    """Windows of a day that slide by six hours, each with the quality of its quadratic fit."""
    events = table(spark, sf_dir, "events").select(F.floor(seconds(F.col("ts"))).alias("s"), "value")
    return W.sliding_quadratic(events, "s", "value", 86400, 21600, 100).withColumn("quality", F.round("quality", 4))


@Q.add(
    "timebin_greedy",
    """with recursive e as (select user_id, epoch_us(ts) / 1e6 as t, value, 1.0 + (event_id % 3) as err from events),
    b as (select user_id, 0 as bin, min(t) as start from e group by 1 union all select b.user_id, bin + 1, (select min(t) from e where e.user_id = b.user_id and e.t >= b.start + 86400) from b where start is not null),
    c as (select user_id, bin, start, lead(start) over (partition by user_id order by bin) as next from b where start is not null)
    select c.user_id, bin, round(sum(value / (err * err)) / sum(1 / (err * err)), 6) as mean, round(1 / sqrt(sum(1 / (err * err))), 6) as error, count(*) as n
    from c join e on e.user_id = c.user_id and t >= start and (next is null or t < next) group by 1, 2""",
)
def timebin_greedy(spark, sf_dir):
    """Bins of a day that begin at the first event outside of the last one."""
    events = table(spark, sf_dir, "events").select("user_id", seconds(F.col("ts")).alias("t"), "value", (1.0 + F.col("event_id") % 3).alias("err"))
    out = W.greedy_bins(events, ["user_id"], "t", "value", "err", 86400.0)
    return out.select("user_id", "bin", F.round("mean", 6).alias("mean"), F.round("error", 6).alias("error"), "n")
