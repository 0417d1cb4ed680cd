"""Queries of image, spectrum and scalar operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import frames
from ..operators import spectra as X
from ._common import Queries, table

Q = Queries()
C = 299792458.0

#: Pixels made from lineitem: one per (row, column) with their summed price, the last columns being overscan.
PIXELS = "(select cast(l_partkey % 40 as int) as row, cast(l_suppkey % 60 as int) as col, sum(l_extendedprice) / 1000 as data, sum(l_quantity) as variance, avg(l_discount) as sky, 1 + max(l_linenumber) / 10.0 as weight, min(l_tax) as tax from lineitem group by 1, 2)"


def pixels(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("row", (F.col("l_partkey") % 40).cast("int")).withColumn("col", (F.col("l_suppkey") % 60).cast("int"))
    return lines.groupBy("row", "col").agg((F.sum("l_extendedprice") / 1000).alias("data"), F.sum("l_quantity").alias("variance"), F.avg("l_discount").alias("sky"), (1 + F.max("l_linenumber") / 10.0).alias("weight"), F.min("l_tax").alias("tax"))


@Q.add("overscan_row_median", f"with p as {PIXELS}, o as (select row, median(data) as o from p where col >= 52 group by 1) select p.row, col, round(data - o, 3) as data from p left join o on o.row = p.row where col < 52")
def overscan_row_median(spark, sf_dir):
    out = X.less_row_median(pixels(spark, sf_dir).select("row", "col", "data"), ["row"], "data", F.col("col") >= 52)
    return out.withColumn("data", F.round("data", 3))


@Q.add(
    "overscan_line_fit",
    f"with p as {PIXELS}, m as (select row, avg(data) as m from p where col >= 52 group by 1), l as (select regr_slope(m, row::double) as s, regr_intercept(m, row::double) as i from m) select row, col, round(data - s * row - i, 4) as data from p, l where col < 52",
)
def overscan_line_fit(spark, sf_dir):
    out = X.less_line_fit(pixels(spark, sf_dir).select("row", "col", "data"), "row", "data", F.col("col") >= 52)
    return out.withColumn("data", F.round("data", 4))


@Q.add(
    "bias_dark_flat",
    f"with p as {PIXELS} select row, col, round((case when row % 10 = 0 then data else data - sky end - tax * 2.5) / nullif(weight - 1.7, 0), 4) as data from p",
)
def bias_dark_flat(spark, sf_dir):
    """Bias, dark by exposure time, and flat; where the flat is zero there is no value."""
    p = pixels(spark, sf_dir)
    on = ["row", "col"]
    out = X.calibrated(p.select("row", "col", "data"), on, p.select(*on, F.col("sky").alias("bias")), p.select(*on, F.col("tax").alias("dark")), p.select(*on, (F.col("weight") - 1.7).alias("flat")), F.lit(2.5), F.col("row") % 10 == 0)
    return out.withColumn("data", F.round("data", 4))


@Q.add("bad_pixel_mask", f"with p as {PIXELS} select row, count(*) filter (where (row + col) % 7 = 0) as n_bad, round(avg(data) filter (where (row + col) % 7 <> 0), 4) as mean from p group by 1")
def bad_pixel_mask(spark, sf_dir):
    p = pixels(spark, sf_dir)
    mask = p.select("row", "col", F.when((F.col("row") + F.col("col")) % 7 == 0, 0).otherwise(1).alias("mask"))
    out = X.masked_out(p.select("row", "col", "data"), mask, ["row", "col"], "data")
    return out.groupBy("row").agg(F.count_if(F.isnan("data")).alias("n_bad"), F.round(F.avg(X.finite(F.col("data"))), 4).alias("mean"))


@Q.add("box_extract", f"with p as {PIXELS} select cast(row // 8 as int) as \"order\", col, round(sum(weight * (data - sky)), 4) as flux, round(sum(weight * variance), 4) as variance from p where row % 8 <> 3 group by 1, 2")
def box_extract(spark, sf_dir):
    p = pixels(spark, sf_dir).withColumn("order", F.floor(F.col("row") / 8).cast("int")).withColumn("mask", F.when(F.col("row") % 8 == 3, 0.0).otherwise(1.0))
    return X.box_extracted(p, ["order", "col"]).select("order", "col", F.round("flux", 4).alias("flux"), F.round("variance", 4).alias("variance"))


def _optimal_sql(rounds):
    sql = f'with p0 as (select cast(row // 8 as int) as "order", row, col, data, sky, variance * 50 + 1 as variance, (1 + row % 8) / 36.0 as profile, 1.0 as mask from {PIXELS})'
    for i in range(rounds):
        sql += f""", f{i} as (select "order", col, sum(mask * profile * (data - sky) / variance) / nullif(sum(mask * profile * profile / variance), 0) as f from p{i} group by 1, 2),
        r{i} as (select p.*, case when mask > 0 then (data - sky - f * profile) ** 2 / variance end as r from p{i} p join f{i} f on p."order" = f."order" and p.col = f.col),
        p{i + 1} as (select "order", row, col, data, sky, variance, profile, case when r = w and w > 9 then 0.0 else mask end as mask from (select *, max(r) over (partition by "order", col) as w from r{i}))"""
    return sql + f' select "order", col, round(sum(mask * profile * (data - sky) / variance) / nullif(sum(mask * profile * profile / variance), 0), 3) as flux, round(sum(mask * profile) / nullif(sum(mask * profile * profile / variance), 0), 3) as variance from p{rounds} group by 1, 2'


@Q.add("optimal_extract", _optimal_sql(2))
def optimal_extract(spark, sf_dir):
    """Optimal extraction with a known profile and two rounds of rejecting each column's worst pixel."""
    p = pixels(spark, sf_dir).withColumns({"order": F.floor(F.col("row") / 8).cast("int"), "mask": F.lit(1.0), "profile": (1 + F.col("row") % 8) / 36.0, "variance": F.col("variance") * 50 + 1})
    out = X.optimally_extracted(p.select("order", "row", "col", "data", "sky", "variance", "profile", "mask"), ["order", "col"], 3.0, 2)
    return out.select("order", "col", F.round("flux", 3).alias("flux"), F.round("variance", 3).alias("variance"))


TRACES = [(0, [4.0, 0.05], 2.0, 2.5, 0, 59), (1, [14.0, 0.1, -0.0005], 1.5, 3.0, 5, 50), (2, [30.0], 3.0, 3.0, 0, 59)]


@Q.add(
    "order_mask_join",
    f"""with t(trace, c0, c1, c2, below, above, x1, x2) as (values (0, 4.0::double, 0.05::double, 0::double, 2.0::double, 2.5::double, 0, 59), (1, 14.0, 0.1, -0.0005, 1.5, 3.0, 5, 50), (2, 30.0, 0, 0, 3.0, 3.0, 0, 59)), p as {PIXELS}
    select trace, row, col from p join t on col >= x1 and col <= x2 where row >= ceil((c2 * col + c1) * col + c0 - below) and row <= floor((c2 * col + c1) * col + c0 + above) - 1""",
)
def order_mask_join(spark, sf_dir):
    """Pixels of each order by its trace polynomial and edges."""
    traces = spark.createDataFrame(TRACES, "trace int, c array<double>, below double, above double, x1 int, x2 int")
    return frames.in_trace(pixels(spark, sf_dir).select("row", "col"), traces, "row", "col", "c", "below", "above").select("trace", "row", "col")


@Q.add("straylight_mean", f"with p as {PIXELS} select round(avg(data), 4) as level, count(*) as n from p where row % 8 in (0, 7) and col between 3 and 56")
def straylight_mean(spark, sf_dir):
    """Mean of the pixels between the orders, away from the edges."""
    return pixels(spark, sf_dir).filter("row % 8 in (0, 7) and col between 3 and 56").agg(F.round(F.avg("data"), 4).alias("level"), F.count("*").alias("n"))


@Q.add(
    "tiled_background",
    f"with p as (select *, row // 10 as tr, col // 15 as tc from {PIXELS}), s as (select tr, tc, median(data) as m, stddev_pop(data) as s from p group by 1, 2) select cast(p.tr as bigint) as tile_row, cast(p.tc as bigint) as tile_col, round(median(data), 4) as background, count(*) as n from p join s on p.tr = s.tr and p.tc = s.tc where abs(data - m) <= 1.5 * s group by 1, 2",
)
def tiled_background(spark, sf_dir):
    out = X.tiled_background(pixels(spark, sf_dir), "row", "col", "data", 10, 15, 1.5)
    return out.select("tile_row", "tile_col", F.round("background", 4).alias("background"), "n")


SPECTRUM = f"(select cast(row // 8 as int) as ord, col as pixel, 5000 + 40 * (row // 8) + col * 0.5 as lo, 5000 + 40 * (row // 8) + col * 0.5 + 0.5 as hi, sum(data) as flux from {PIXELS} group by all)"
LINES = [(k, 5004.0 + 7.3 * k, 5004.0 + 7.3 * k + 0.35, 0.2 + (k % 5) / 10) for k in range(26)]


def spectrum(spark, sf_dir):
    order = F.floor(F.col("row") / 8).cast("int")
    p = pixels(spark, sf_dir).groupBy(order.alias("ord"), F.col("col").alias("pixel")).agg(F.sum("data").alias("flux"))
    lo = 5000 + 40 * F.col("ord") + F.col("pixel") * 0.5
    return p.withColumn("lo", lo).withColumn("hi", lo + 0.5)


CCF = f"""s as {SPECTRUM}, l as (select k as line, 5004.0 + 7.3 * k as a, 5004.0 + 7.3 * k + 0.35 as b, 0.2 + (k % 5) / 10 as w from range(26) t(k)), v as (select (range - 10) * 4000.0 as velocity from range(21)),
    m as (select ord, velocity, pixel, flux, arg_max(w * (least(b * (1 + velocity / {C}), hi) - greatest(a * (1 + velocity / {C}), lo)) / (hi - lo), line) as f
      from s join (l cross join v) on a * (1 + velocity / {C}) < hi and b * (1 + velocity / {C}) > lo group by 1, 2, 3, 4),
    ccf as (select ord, velocity, sum(flux * f) as ccf from m group by 1, 2)"""


def correlation(spark, sf_dir):
    lines = spark.createDataFrame(LINES, "line int, start double, stop double, weight double")
    velocities = spark.range(21).select(((F.col("id") - 10) * 4000.0).alias("velocity"))
    return X.correlated(spectrum(spark, sf_dir), lines, velocities, ["ord"], C)


@Q.add("ccf_long", f"with {CCF} select ord, velocity, round(ccf, 4) as ccf from ccf")
def ccf_long(spark, sf_dir):
    return correlation(spark, sf_dir).withColumn("ccf", F.round("ccf", 4))


@Q.add(
    "ccf_error",
    f"""with {CCF}, d as (select ord, ccf, case when lead(ccf) over w is null then (ccf - lag(ccf) over w) / 4000 when lag(ccf) over w is null then (lead(ccf) over w - ccf) / 4000 else (lead(ccf) over w - lag(ccf) over w) / 8000 end as d from ccf window w as (partition by ord order by velocity)),
    e as (select ord, sum(d * d / nullif(ccf, 0)) as q, sum(ccf) as t, min(ccf) as l from d group by 1)
    select ord, round(case when l < 0 or t <= 0 or q <= 0 then 0 else 1 / (sqrt(q) / sqrt(t) * sqrt(4000 / 1000.0) * sqrt(t)) end, 4) as error from e""",
)
def ccf_error(spark, sf_dir):
    return X.velocity_error(correlation(spark, sf_dir), ["ord"], 4000.0, 1000.0).withColumn("error", F.round("error", 4))


@Q.add(
    "reweight_ccf",
    f"with {CCF}, r(ord, ratio) as (values (0, 1.0), (1, 0.8), (2, 0.5), (3, 0.25)), t as (select ord, max(ccf) as top from ccf group by 1) select c.velocity, round(sum(ccf * ratio * (select max(top) from t) / nullif(top, 0)), 4) as ccf from ccf c join t on c.ord = t.ord join r on r.ord = c.ord group by 1",
)
def reweight_ccf(spark, sf_dir):
    """Orders scaled to given ratios and summed."""
    ratios = spark.createDataFrame([(0, 1.0), (1, 0.8), (2, 0.5), (3, 0.25)], "ord int, ratio double")
    ccf = correlation(spark, sf_dir).withColumn("all", F.lit(1))
    return X.reweighted(ccf, ratios, ["all"], "ord").groupBy("velocity").agg(F.round(F.sum("ccf"), 4).alias("ccf"))


@Q.add(
    "ccf_centre",
    f"with {CCF}, e as (select ord, arg_min(velocity, ccf) as deepest, min(ccf) as lo, max(ccf) as hi from ccf group by 1) select c.ord, deepest, round(sum(greatest(hi - 0.5 * (hi - lo) - ccf, 0) * velocity) / nullif(sum(greatest(hi - 0.5 * (hi - lo) - ccf, 0)), 0), 3) as centre from ccf c join e on c.ord = e.ord group by 1, 2",
)
def ccf_centre(spark, sf_dir):
    return X.centre_of(correlation(spark, sf_dir), ["ord"], 0.5).withColumn("centre", F.round("centre", 3))


@Q.add(
    "xcorr_lag",
    f"with s as {SPECTRUM}, a as (select pixel, flux from s where ord = 1), b as (select pixel, flux from s where ord = 2) select lag, round(sum(a.flux * b.flux) / 1e6, 4) as correlation from a, (select range - 5 as lag from range(11)) l, b where b.pixel = a.pixel + lag group by 1",
)
def xcorr_lag(spark, sf_dir):
    """Sums of products of two slices at lags of up to five pixels."""
    s = spectrum(spark, sf_dir).withColumn("all", F.lit(1)).select("all", "ord", "pixel", "flux")
    out = X.lag_correlation(s.filter("ord = 1"), s.filter("ord = 2"), ["all"], "pixel", "flux", 5)
    return out.select("lag", F.round(F.col("correlation") / 1e6, 4).alias("correlation"))


@Q.add(
    "wls_stats",
    f"""with s as (select ord, pixel, lo as r, lo + 0.001 * (pixel % 7) + flux / 1e6 as n from {SPECTRUM}), d as (select ord, (n - r) / nullif(coalesce(lead(r) over w - r, r - lag(r) over w), 0) as d from s window w as (partition by ord order by pixel))
    select ord, round(median(d), 6) as median, round(stddev_pop(d), 6) as std, count(d) as n from d group by 1""",
)
def wls_stats(spark, sf_dir):
    s = spectrum(spark, sf_dir)
    new = s.select("ord", "pixel", (F.col("lo") + 0.001 * (F.col("pixel") % 7) + F.col("flux") / 1e6).alias("wave"))
    out = X.wavelength_shift(new, s.select("ord", "pixel", F.col("lo").alias("wave")), ["ord"], "pixel")
    return out.select("ord", F.round("median", 6).alias("median"), F.round("std", 6).alias("std"), "n")


@Q.add("wls_between", f"select ord, pixel, round(lo + 0.3 * (hi - lo), 6) as wave from {SPECTRUM}")
def wls_between(spark, sf_dir):
    s = spectrum(spark, sf_dir)
    out = X.between_solutions(s.select("ord", "pixel", F.col("lo").alias("wave")), s.select("ord", "pixel", F.col("hi").alias("wave")), ["ord", "pixel"], 0.3)
    return out.withColumn("wave", F.round("wave", 6))


@Q.add(
    "linear_interp_grid",
    """with s as (select user_id, epoch_us(ts) / 1e6 as x, value as y from events), g as (select user_id, t as x from (select distinct user_id from s) u, (select 1704067200.0 + 50000.0 * range as t from range(50)) t),
    b as (select g.user_id, g.x, max(s.x) filter (where s.x <= g.x) as xb, min(s.x) filter (where s.x >= g.x) as xa from g join s on s.user_id = g.user_id group by 1, 2)
    select b.user_id, b.x, round(case when xa = xb then sb.y else sb.y + (b.x - xb) / (xa - xb) * (sa.y - sb.y) end, 6) as y from b left join s sb on sb.user_id = b.user_id and sb.x = xb left join s sa on sa.user_id = b.user_id and sa.x = xa""",
)
def linear_interp_grid(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select("user_id", S.seconds(F.col("ts")).alias("x"), F.col("value").alias("y"))
    grid = samples.select("user_id").distinct().crossJoin(F.broadcast(spark.range(50).select((F.lit(1704067200.0) + 50000.0 * F.col("id")).alias("x"))))  # the grid is a parameter
    return X.interpolated(samples, grid, ["user_id"], "x", "y").withColumn("y", F.round("y", 6))


@Q.add(
    "smooth_lamp",
    f"""with s as {SPECTRUM}, w as (select c.ord, c.pixel, x.flux as x from s c join s x on c.ord = x.ord and abs(c.pixel - x.pixel) <= 4), p as (select ord, pixel, quantile_cont(x, 0.16) as a, quantile_cont(x, 0.5) as m, quantile_cont(x, 0.84) as b from w group by 1, 2)
    select w.ord, w.pixel, round(avg(x), 2) as flux from w join p on w.ord = p.ord and w.pixel = p.pixel where abs(x - m) <= 1.5 * (b - a) / 2 group by 1, 2""",
)
def smooth_lamp(spark, sf_dir):
    """Clipped mean along each row in a window around every pixel."""
    s = spectrum(spark, sf_dir).select("ord", "pixel", "flux")
    return X.sliding_clipped_mean(s, ["ord"], "pixel", "flux", 4, 1.5).withColumn("flux", F.round("flux", 2))


# scalars


@Q.add(
    "datecode_parse",
    "select event_id, strftime(ts, '%Y%m%d') as datecode, 'KP.' || strftime(ts, '%Y%m%d') || '.' || lpad(cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) as varchar), 5, '0') || '.' || lpad(cast(event_id % 100 as varchar), 2, '0') || '_L1.fits' as name, date_trunc('second', ts) as at from events",
)
def datecode_parse(spark, sf_dir):
    """Ids from times, file names from ids, and both back again."""
    ids = table(spark, sf_dir, "events").select("event_id", S.observation_id(F.col("ts"), F.col("event_id")).alias("id"))
    name = S.level_filename(F.col("id"), F.lit("L1"))
    return ids.select("event_id", S.datecode_of(name).alias("datecode"), name.alias("name"), S.observation_time(F.col("id")).alias("at"))


@Q.add(
    "obsid_regex",
    "with n as (select event_id, case event_id % 4 when 0 then 'KP.20240101.12345.67' when 1 then 'KP.2024011.12345.67' when 2 then '/a/b/x_20231231_L2.fits' else 'none' end as name from events) select event_id, regexp_matches(name, '^KP\\.\\d{8}\\.\\d{5}\\.\\d{2}$') as valid, nullif(regexp_extract(name, '(\\d{8})', 1), '') as code, case when contains(name, '_L2') then 'L2' else 'L0' end as level, split_part(name, '/', -1) as file from n",
)
def obsid_regex(spark, sf_dir):
    k = F.col("event_id") % 4
    name = F.when(k == 0, "KP.20240101.12345.67").when(k == 1, "KP.2024011.12345.67").when(k == 2, "/a/b/x_20231231_L2.fits").otherwise("none")
    rows = table(spark, sf_dir, "events").select("event_id", name.alias("name"))
    return rows.select("event_id", S.is_observation_id(F.col("name")).alias("valid"), S.first_datecode(F.col("name")).alias("code"), S.level_of(F.col("name")).alias("level"), S.base_name(F.col("name")).alias("file"))


@Q.add("sexagesimal", "select event_id, round((user_id % 24 + hour(ts) / 60.0 + minute(ts) / 3600.0) * 15, 8) as ra, round((case when event_id % 2 = 0 then -1 else 1 end) * (user_id % 90 + minute(ts) / 60.0 + second(ts) / 3600.0), 8) as dec from events")
def sexagesimal(spark, sf_dir):
    part = lambda *c: F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in c])
    u, t = F.col("user_id"), F.col("ts")
    rows = table(spark, sf_dir, "events").select("event_id", part(u % 24, F.hour(t), F.minute(t)).alias("ra"), F.concat(F.when(F.col("event_id") % 2 == 0, "-").otherwise("+"), part(u % 90, F.minute(t), F.second(t))).alias("dec"))
    return rows.select("event_id", F.round(S.degrees(F.col("ra"), 15.0), 8).alias("ra"), F.round(S.degrees(F.col("dec")), 8).alias("dec"))


@Q.add("master_age", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)), -99) as age from lineitem left join orders on o_orderkey = l_orderkey and o_orderstatus = 'F'")
def master_age(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    masters = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return lines.join(masters, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.age_in_days(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("age"))


_HC2, _HCK = 2 * S.PLANCK * S.LIGHT**2, S.PLANCK * S.LIGHT / (S.BOLTZMANN * 5800.0)


@Q.add("planck", f"select p_partkey, round(({_HC2!r}::double) / pow(p_retailprice * 5e-10::double, 5) / (exp(({_HCK!r}::double) / (p_retailprice * 5e-10::double)) - 1) / 1e12, 6) as radiance from part")
def planck(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(S.planck(F.col("p_retailprice") * 5e-10, 5800.0) / 1e12, 6).alias("radiance"))


@Q.add("variance_quadrant", f"with p as {PIXELS} select row, col, case when row < 20 then case when col < 30 then 4.0 else 4.41 end else case when col < 30 then 3.61 else 5.29 end end as variance from p")
def variance_quadrant(spark, sf_dir):
    return pixels(spark, sf_dir).select("row", "col", S.by_quadrant(F.col("row"), F.col("col"), 20, 30, [4.0, 4.41, 3.61, 5.29]).alias("variance"))


@Q.add("comb_lines", "select p_partkey, n, round(299792458e10 / (1e9 * p_size + n * 2e10), 4) as wave from part, range(25000, 25010) t(n)")
def comb_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(S.comb_lines(F.col("p_size") * 1e9, F.lit(2e10), 25000, 25009)).alias("n", "wave"))
    return lines.select("p_partkey", (F.col("n") + 25000).cast("long").alias("n"), F.round("wave", 4).alias("wave"))


@Q.add("horner", "select vec_id, round(embedding[1]::double + 0.5 * (embedding[2]::double + 0.5 * (embedding[3]::double + 0.5 * embedding[4]::double)), 6) as y from embeddings")
def horner(spark, sf_dir):
    c = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(S.horner(c, F.lit(0.5)), 6).alias("y"))


@Q.add("drift_applied", f"select ord, pixel, round(lo * (1 - 1234.5 / {C}), 8) as wave from {SPECTRUM}")
def drift_applied(spark, sf_dir):
    return spectrum(spark, sf_dir).select("ord", "pixel", F.round(S.doppler(F.col("lo"), F.lit(-1234.5)), 8).alias("wave"))
