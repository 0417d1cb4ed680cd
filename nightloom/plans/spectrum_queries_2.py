"""More queries of spectra: repair, masks, peaks, bisectors, drifts and chained lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import asof, registry
from ..operators import spectra as X
from ..operators import statistics as A
from ._common import Queries, table
from .spectrum_queries import CCF, PIXELS, SPECTRUM, C, correlation, pixels, spectrum

Q = Queries()


@Q.add(
    "nan_repair",
    f"""with s as (select ord, pixel, case when (pixel + ord) % 7 < 2 then null else flux end as y from {SPECTRUM}), k as (select ord, pixel as x, y from s where y is not null),
    n as (select s.ord, s.pixel, max(x) filter (where x <= s.pixel) as b, min(x) filter (where x >= s.pixel) as a from s join k on s.ord = k.ord group by 1, 2)
    select n.ord, n.pixel, round(case when b is null then ka.y when a is null or a = b then kb.y else kb.y + (n.pixel - b) / (a - b) * (ka.y - kb.y) end, 7) as flux from n left join k ka on ka.ord = n.ord and ka.x = a left join k kb on kb.ord = n.ord and kb.x = b""",
)
def nan_repair(spark, sf_dir):
    s = spectrum(spark, sf_dir).withColumn("flux", F.when((F.col("pixel") + F.col("ord")) % 7 < 2, F.lit(float("nan"))).otherwise(F.col("flux")))
    return X.repaired(s.select("ord", "pixel", "flux"), ["ord"], "pixel", "flux").withColumn("flux", F.round("flux", 7))


@Q.add("mask_dilation", f"select ord, pixel, bool_or(flux > 12000) over (partition by ord order by pixel range between 2 preceding and 2 following) as masked from {SPECTRUM}")
def mask_dilation(spark, sf_dir):
    s = spectrum(spark, sf_dir).select("ord", "pixel", (F.col("flux") > 12000).alias("masked"))
    return X.dilated(s, ["ord"], "pixel", "masked", 2)


@Q.add(
    "good_pixels",
    f"with p as {PIXELS}, m as (select row, median(data) as m from p group by 1), s as (select p.row, m, median(abs(data - m)) as s from p join m on p.row = m.row group by 1, 2) select p.row, col, abs(data - m) < 3 * 1.4826 * s as good from p join s on p.row = s.row",
)
def good_pixels(spark, sf_dir):
    return X.good_pixels(pixels(spark, sf_dir).select("row", "col", "data"), ["row"], "data", 3.0).select("row", "col", "good")


@Q.add(
    "xdisp_shift",
    f"""with s as {SPECTRUM}, c as (select a.ord, l.lag, sum(a.flux * b.flux) as c from s a, (select range - 4 as lag from range(9)) l, s b where b.ord = a.ord + 1 and b.pixel = a.pixel + l.lag group by 1, 2),
    n as (select *, lag(c) over w as b, lead(c) over w as a from c window w as (partition by ord order by lag)), t as (select ord, arg_max({{'lag': lag, 'b': b, 'a': a, 'c': c}}, c) as t from n group by 1)
    select ord, round(t.lag + coalesce((t.b - t.a) / (2 * nullif(t.b - 2 * t.c + t.a, 0)), 0), 5) as shift from t""",
)
def xdisp_shift(spark, sf_dir):
    """Shift between neighbouring slices, to a fraction of a pixel."""
    s = spectrum(spark, sf_dir).select("ord", "pixel", "flux")
    lags = X.lag_correlation(s, s.withColumn("ord", F.col("ord") - 1), ["ord"], "pixel", "flux", 4)
    return X.peak_of(lags, ["ord"]).withColumn("shift", F.round("shift", 5))


@Q.add(
    "bisector_span",
    f"with {CCF}, e as (select ord, min(ccf) as lo, max(ccf) as hi from ccf group by 1), d as (select c.ord, velocity, (hi - ccf) / nullif(hi - lo, 0) as d from ccf c join e on c.ord = e.ord) select ord, round(avg(velocity) filter (where d between 0.1 and 0.4) - avg(velocity) filter (where d between 0.55 and 0.85), 3) as span from d group by 1",
)
def bisector_span(spark, sf_dir):
    return X.bisector_span(correlation(spark, sf_dir), ["ord"], (0.1, 0.4), (0.55, 0.85)).withColumn("span", F.round("span", 3))


@Q.add("rv_precision", f"select ord, round(stddev_pop(flux / 1e9 / lo * {C}) / sqrt(count(flux)), 6) as precision, count(flux) as n from {SPECTRUM} group by 1")
def rv_precision(spark, sf_dir):
    rows = spectrum(spark, sf_dir).select("ord", "lo", (F.col("flux") / 1e9).alias("residual"))
    return X.velocity_precision(rows, ["ord"], "lo", "residual", C).withColumn("precision", F.round("precision", 6))


@Q.add(
    "pixel_drift",
    f"""with a as (select ord, lo as wave, pixel::double as pixel from {SPECTRUM}), s as (select *, (wave - lag(wave) over w) / nullif(pixel - lag(pixel) over w, 0) as slope from a window w as (partition by ord order by wave)),
    d as (select ord, (0.01 + (pixel % 3) / 100) * slope / wave as al from s) select ord, round(median((al * al + 2 * al) / (al * al + 2 * al + 2) * {C}), 5) as drift from d group by 1""",
)
def pixel_drift(spark, sf_dir):
    a = spectrum(spark, sf_dir).select("ord", F.col("lo").alias("wave"), F.col("pixel").cast("double").alias("pixel"))
    b = a.withColumn("pixel", F.col("pixel") + 0.01 + (F.col("pixel") % 3) / 100)
    return X.pixel_drift(a, b, ["ord"], C).withColumn("drift", F.round("drift", 5))


@Q.add(
    "etalon_fsr",
    f"with s as (select ord, pixel, lo as w, lead(lo) over (partition by ord order by pixel) as n from {SPECTRUM} where pixel % 4 = 0) select ord, pixel, round({C} * (n - w) / (w * w) * 10, 6) as fsr from s where n is not null",
)
def etalon_fsr(spark, sf_dir):
    """Free spectral range in GHz between neighbouring peaks at wavelengths in angstrom."""
    peaks = spectrum(spark, sf_dir).filter("pixel % 4 = 0").select("ord", "pixel", F.col("lo").alias("w"))
    pairs = registry.next_in_type(peaks, ["ord"], ["pixel"], ["w"])
    return pairs.select("ord", "pixel", F.round(F.lit(C) * (F.col("next_w") - F.col("w")) / (F.col("w") * F.col("w")) * 10, 6).alias("fsr"))


@Q.add("frame_average", "select l_linenumber as pixel, round(avg(l_extendedprice), 4) as mean, median(l_quantity) as middle, count(*) as n from lineitem group by 1")
def frame_average(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("pixel")).agg(F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.median("l_quantity").alias("middle"), F.count("*").alias("n"))


@Q.add(
    "master_inputs",
    """with n as (select event_id, user_id, event_type, 40587 + epoch_us(ts) / 86400e6 as mjd from events where event_type <> 'view' and user_id % 11 <> 0) select event_type, count(*) as n_files, count(distinct user_id) as n_objects, list_sort(list(distinct user_id % 5)) as kinds
    from n where mjd > 60325 - 10 / 24.0 and mjd < 60325 + 14 / 24.0 group by 1""",
)
def master_inputs(spark, sf_dir):
    """Files of a night by type that may go into its master frames."""
    rows = table(spark, sf_dir, "events").filter("event_type <> 'view' and user_id % 11 <> 0").withColumn("mjd", S.mjd(F.col("ts")))
    night = registry.night_window(rows, "mjd", 60325, 10, 14)
    return night.groupBy("event_type").agg(F.count("*").alias("n_files"), F.count_distinct("user_id").alias("n_objects"), F.sort_array(F.collect_set(F.col("user_id") % 5)).alias("kinds"))


@Q.add(
    "chained_asof",
    """with p as (select user_id, ts, event_id from events where event_type = 'purchase'), w as (select user_id, ts, event_id as wls from events where event_type = 'click'), m as (select user_id, ts, event_id as mask from events where event_type = 'signup'),
    a as (select p.event_id, p.user_id, w.wls, w.ts as wls_ts from p asof join w on p.user_id = w.user_id and p.ts > w.ts)
    select a.event_id, a.wls, m.mask from a asof left join m on a.user_id = m.user_id and a.wls_ts > m.ts""",
)
def chained_asof(spark, sf_dir):
    """The mask before the wavelength solution that comes before the observation, not before the observation itself."""
    events = table(spark, sf_dir, "events")
    of = lambda kind: events.filter(F.col("event_type") == kind).select("user_id", "ts", F.struct(F.col("ts").alias("t"), F.col("event_id").alias("id")).alias("v"))
    obs = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    first = asof.asof_before(obs, of("click"), ["user_id"], "ts", "v", "wls").filter("wls is not null")
    second = first.select("event_id", "user_id", F.col("wls.id").alias("wls"), F.col("wls.t").alias("ts"))
    return asof.asof_before(second, of("signup"), ["user_id"], "ts", "v", "mask").select("event_id", "wls", F.col("mask.id").alias("mask"))


@Q.add(
    "register_readnoise",
    """with r as (select l_suppkey as rid, round(stddev_pop(l_quantity), 6) as rn1, round(stddev_pop(l_discount), 8) as rn2 from lineitem where l_linenumber <= 2 group by 1), n as (select l_suppkey as rid, round(stddev_pop(l_quantity), 6) as rn1 from lineitem where l_linenumber = 3 and l_suppkey % 3 = 0 group by 1)
    select coalesce(r.rid, n.rid) as rid, coalesce(n.rn1, r.rn1) as rn1, r.rn2 from r full outer join n on r.rid = n.rid""",
)
def register_readnoise(spark, sf_dir):
    """New measurements replace those of their exposure and leave the other columns."""
    lines = table(spark, sf_dir, "lineitem").withColumn("rid", F.col("l_suppkey"))
    noise = F.round(F.stddev_pop("l_quantity"), 6).alias("rn1")
    stored = lines.filter("l_linenumber <= 2").groupBy("rid").agg(noise, F.round(F.stddev_pop("l_discount"), 8).alias("rn2"))
    return registry.upsert(stored, lines.filter("l_linenumber = 3 and l_suppkey % 3 = 0").groupBy("rid").agg(noise), ["rid"], "rn1")


@Q.add("weighted_stack", "select l_returnflag, round(sum(l_quantity * l_extendedprice) / nullif(sum(l_quantity), 0), 4) as mean, round(sqrt(1 / nullif(sum(case when l_tax <> 0 then l_quantity / (l_tax * l_tax) end), 0)), 10) as error from lineitem group by 1")
def weighted_stack(spark, sf_dir):
    """Orders combined to one velocity: the weighted mean and its error."""
    mean, _ = A.weighted("l_extendedprice", "l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(mean, 4).alias("mean"), F.round(A.weighted_error("l_tax", "l_quantity"), 10).alias("error"))


@Q.add(
    "overscan_clipped_mean",
    f"""with p as (select row // 20 as amp, * from {PIXELS}), q as (select amp, quantile_cont(data, 0.16) as a, quantile_cont(data, 0.5) as m, quantile_cont(data, 0.84) as b from p where col >= 52 group by 1),
    o as (select p.amp, avg(data) as o from p join q on p.amp = q.amp where col >= 52 and abs(data - m) <= 1.2 * (b - a) / 2 group by 1) select row, col, round(data - o, 3) as data from p left join o on p.amp = o.amp where col < 52""",
)
def overscan_clipped_mean(spark, sf_dir):
    """One level for the whole strip of an amplifier."""
    rows = pixels(spark, sf_dir).select("row", "col", "data", F.floor(F.col("row") / 20).alias("amp"))
    return X.less_clipped_mean(rows, ["amp"], "data", F.col("col") >= 52, 1.2).select("row", "col", F.round("data", 3).alias("data"))


@Q.add(
    "full_frame",
    f"""with p as (select row % 20 as r, col % 30 as c, row // 20 as cr, col // 30 as cc, data from {PIXELS})
    select cast(case when cr = 1 and cc = 0 or cr = 0 and cc = 1 then 19 - r else r end + 20 * cr as bigint) as row, cast(case when cr = 0 then 29 - c else c end + 30 * cc as bigint) as col, round(data, 3) as data from p""",
)
def full_frame(spark, sf_dir):
    """Four channels, of orientation keys 1 to 4, turned as they are read and put together."""
    rows = pixels(spark, sf_dir).select((F.col("row") % 20).cast("long").alias("row"), (F.col("col") % 30).cast("long").alias("col"), (F.floor(F.col("row") / 20) + 1).alias("cr"), (F.floor(F.col("col") / 30) + 1).alias("cc"), "data")
    rows = X.turned(rows.withColumn("key", F.col("cr") * 2 + F.col("cc") - 2), "row", "col", "key", 20, 30)
    return X.assembled(rows, "row", "col", "cr", "cc", 20, 30).select("row", "col", F.round("data", 3).alias("data"))


@Q.add("ccf_skew", "with f as (select label, unnest(embedding)::double as x from embeddings), m as (select label, avg(x) as m from f group by 1) select f.label, round(avg(power(x - m, 3)) / power(avg(power(x - m, 2)), 1.5), 6) as skew from f join m on f.label = m.label group by 1")
def ccf_skew(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x")).withColumn("x", F.col("x").cast("double"))
    return X.ccf_skew(rows, ["label"], "x").select("label", F.round("skew", 6).alias("skew"))
