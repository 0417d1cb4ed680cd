"""Queries of frame operators: clusters, cut-outs, fits, extraction to its end, filling and smoothing.

Frames are made from lineitem, 32 x 64 pixels for each 1000 order keys, so that their number grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combs, extraction, fits, frames, masters
from ._common import Queries, table

Q = Queries()
HEIGHT, WIDTH, SPAN = 32, 64, 1000

PIXELS = f"""(select l_orderkey // {SPAN} as frame, cast((l_partkey * 7 + l_linenumber) % {HEIGHT} as int) as row, cast((l_suppkey * 11 + l_orderkey) % {WIDTH} as int) as col,
    sum(l_extendedprice) / 97.00012345::double as data, sum(l_quantity) as quantity, avg(l_discount) as sky, max(l_linenumber) as line from lineitem group by 1, 2, 3)"""


def pixels(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    frame = F.floor(F.col("l_orderkey") / SPAN).cast("long").alias("frame")
    row = ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % HEIGHT).cast("int").alias("row")
    col = ((F.col("l_suppkey") * 11 + F.col("l_orderkey")) % WIDTH).cast("int").alias("col")
    sums = [(F.sum("l_extendedprice") / 97.00012345).alias("data"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("sky"), F.max("l_linenumber").alias("line")]
    return lines.groupBy(frame, row, col).agg(*sums)


# clusters


@Q.add(
    "frame_clusters",
    f"""with recursive p as (select frame, row, col from {PIXELS} where quantity > 80), i as (select *, col - row_number() over (partition by frame, row order by col) as k from p),
    r as (select frame, row, min(col) as a, max(col) as b, count(*) as n from i group by frame, row, k), v as (select *, row_number() over (order by frame, row, a) as id from r),
    e as (select x.id as u, y.id as w from v x join v y on x.frame = y.frame and y.row = x.row + 1 and y.a <= x.b + 1 and y.b >= x.a - 1),
    g as (select u, w from e union all select w, u from e), t(id, reached) as (select id, id from v union select t.id, g.w from t join g on g.u = t.reached),
    m as (select id, min(reached) as first from t group by 1)
    select v.frame, f.row as first_row, f.a as first_col, sum(v.n)::bigint as n_pixels, min(v.row) as min_row, max(v.row) as max_row, min(v.a) as min_col, max(v.b) as max_col
    from v join m on m.id = v.id join v f on f.id = m.first group by 1, 2, 3""",
)
def frame_clusters(spark, sf_dir):
    """Clusters of bright pixels of each frame with their size and extent."""
    lit = pixels(spark, sf_dir).filter("quantity > 80")
    return frames.cluster_sizes(frames.clusters(lit, ["frame"], "row", "col", HEIGHT, WIDTH, 16), ["frame"], "row", "col")


@Q.add("order_location")
def order_location(spark, sf_dir):
    """Pixels above the smooth line of their column, in clusters that are no noise, numbered in each frame."""
    lit = frames.lit_pixels(pixels(spark, sf_dir), ["frame"], "row", "col", "data")
    found = frames.clusters(lit, ["frame"], "row", "col", HEIGHT, WIDTH, 16)
    return frames.large_clusters(frames.cluster_sizes(found, ["frame"], "row", "col"), ["frame"], "row", "col", HEIGHT, WIDTH)


# fits


def three_terms(source: str, by: str, basis: list[str], value: str, weight: str = "1.0") -> str:
    """SQL for by and the three coefficients c0, c1, c2 of a least-squares fit, by Cramer's rule."""
    s = {f"g{i}{j}": f"sum({weight} * ({basis[i]}) * ({basis[j]}))" for i in range(3) for j in range(i, 3)}
    s |= {f"b{i}": f"sum({weight} * ({basis[i]}) * {value})" for i in range(3)}
    det = lambda a, b, c, d, e, f, g, h, i: f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"
    m = [["g00", "g01", "g02"], ["g01", "g11", "g12"], ["g02", "g12", "g22"]]
    whole = det(*m[0], *m[1], *m[2])
    cs = [det(*[("b" + str(r)) if k == c else m[r][k] for r in range(3) for k in range(3)]) for c in range(3)]
    return f"select {by}, n, {', '.join(f'{c} / {whole} as c{i}' for i, c in enumerate(cs))} from (select {by}, count(*) as n, {', '.join(f'{v} as {k}' for k, v in s.items())} from {source} group by {by})"


X1, Y1 = f"(2.0 * col / {WIDTH - 1} - 1)", f"(2.0 * row / {HEIGHT - 1} - 1)"


@Q.add("straylight_surface", f"with p as {PIXELS} select frame, n, round(c0, 4) as level, round(c1, 4) as by_row, round(c2, 4) as by_col from ({three_terms('(select * from p where row % 8 in (0, 7))', 'frame', ['1.0', Y1, X1], 'data')})")
def straylight_surface(spark, sf_dir):
    """Legendre surface through the pixels between the orders of each frame."""
    between = pixels(spark, sf_dir).filter("row % 8 in (0, 7)")
    basis = fits.legendre_surface(fits.on_unit(F.col("col"), WIDTH), fits.on_unit(F.col("row"), HEIGHT), 1)
    fit = fits.least_squares(between, ["frame"], basis, "data")
    c = [F.round(F.get("coefficients", F.lit(i)), 4) for i in range(3)]
    return fit.select("frame", "n", c[0].alias("level"), c[1].alias("by_row"), c[2].alias("by_col"))


def _clipped_sql() -> str:
    basis = ["1.0", "x", "(1.5 * x * x - 0.5)"]
    sql = f"with r0 as materialized (select frame, row // 8 as ord, {X1} as x, data as y, 1.0 / line as w from {PIXELS})"
    for k in range(3):
        sql += f""", f{k} as materialized ({three_terms(f'r{k}', 'frame, ord', basis, 'y', 'w')}),
            d{k} as materialized (select r.frame, r.ord, x, y, w, n, c0, c1, c2, y - (c0 + c1 * x + c2 * {basis[2]}) as off from r{k} r join f{k} f on f.frame = r.frame and f.ord = r.ord),
            s{k} as materialized (select frame, ord, stddev_pop(off) as s from d{k} group by 1, 2),
            r{k + 1} as materialized (select d.frame, d.ord, x, y, w, off from d{k} d join s{k} s on s.frame = d.frame and s.ord = d.ord where abs(off) <= 2.1 * s)"""
    return sql + ", k as (select frame, ord, count(*) as kept from r3 group by 1, 2) select f.frame, cast(f.ord as int) as ord, n, kept, round(c0, 3) as c0, round(c1, 3) as c1, round(c2, 3) as c2 from f2 f join k on k.frame = f.frame and k.ord = f.ord"


@Q.add("clipped_legendre_fit", _clipped_sql())
def clipped_legendre_fit(spark, sf_dir):
    """Weighted Legendre fits along each order in three rounds, each on what lies within 2.1 sigma of the one before."""
    rows = pixels(spark, sf_dir).select("frame", F.floor(F.col("row") / 8).cast("int").alias("ord"), fits.on_unit(F.col("col"), WIDTH).alias("x"), F.col("data").alias("y"), (F.lit(1.0) / F.col("line")).alias("w"))
    fit, left = fits.clipped_least_squares(rows, ["frame", "ord"], fits.legendre(F.col("x"), 2), "y", "w", 3, 2.1)
    kept = left.groupBy("frame", "ord").agg(F.count("*").alias("kept"))
    c = [F.round(F.get("coefficients", F.lit(i)), 3).alias(f"c{i}") for i in range(3)]
    return fit.join(kept, ["frame", "ord"]).select("frame", "ord", "n", "kept", *c)


# cut-outs and extraction


TRACES = [(0, [5.0, 0.05], 2.0, 2.5, 0, 63), (1, [14.3, 0.1, -0.0005], 1.5, 3.0, 5, 50), (2, [25.6], 3.0, 3.25, 0, 63), (3, [31.0, 0.02], 1.0, 2.0, 0, 63)]
_TRACES = ", ".join(f"({t}, {', '.join(repr(c) + '::double' for c in [*k, 0.0, 0.0][:3])}, {b!r}::double, {a!r}::double, {x1}, {x2})" for t, k, b, a, x1, x2 in TRACES)


@Q.add(
    "orderlet_cut_out",
    f"""with t(trace, c0, c1, c2, below, above, x1, x2) as (values {_TRACES}), p as {PIXELS}, m as (select frame, trace, row, col, data, (c2 * col + c1) * col + c0 as mid, below, above from p join t on col between x1 and x2),
    e as (select *, least(greatest(mid - below, 0), {HEIGHT - 1}) as lo, least(greatest(mid + above, 0), {HEIGHT - 1}) as hi from m),
    w as (select *, case when row = floor(lo) then 1 - (lo - floor(lo)) when row = floor(hi) then hi - floor(hi) else 1.0 end as weight from e where row between floor(lo) and greatest(floor(lo), floor(hi)))
    select frame, trace, col, count(*) as n, round(sum(weight), 6) as weight, round(sum(weight * data), 3) as flux from w group by 1, 2, 3""",
)
def orderlet_cut_out(spark, sf_dir):
    """Box sums along traces, with the shares of the pixels that the edges cut."""
    traces = spark.createDataFrame(TRACES, "trace int, c array<double>, below double, above double, x1 int, x2 int")
    each = pixels(spark, sf_dir)
    traces = each.select("frame").distinct().crossJoin(F.broadcast(traces))  # the traces of a detector are parameters
    cut = frames.cut_out(each, traces, "row", "col", "c", "below", "above", HEIGHT, ["frame"])
    return cut.groupBy("frame", "trace", "col").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight"), F.round(F.sum(F.col("weight") * F.col("data")), 3).alias("flux"))


CLIP, GAIN = 3.0, 200.0
EXTRACTED = f"""select frame, row // 8 as ord, row, col, data as d, sky as s, quantity * 4 + abs(data) / {GAIN} as v, case when row % 8 = 0 then 0.5 when row % 8 = 7 then 0.0 else 1.0 end as w,
    (1 + least(row % 8, 8 - row % 8)) / 20.0 as p, case when (row + col) % 9 = 0 then 0 else 1 end as m from {PIXELS}"""


def _to_the_end_sql() -> str:
    """Nine rounds, one more than a column has pixels; columns that are done keep what they have."""
    key = "frame, ord, col"
    sql = f"with q as materialized (select *, v - abs(d) / {GAIN} as v0 from ({EXTRACTED})), p0 as materialized (select frame, ord, row, col, d, s, w, p, v0, case when w > 0 then m else 0 end as m from q), "
    sql += f"s0 as materialized (select {key}, sum(m * (d - s) * w) as f, null::double as fv, false as done, 0 as rounds from p0 group by all)"
    for k in range(9):
        sql += f""", r{k} as materialized (select frame, ord, row, col, d, s, w, p, v0, m, f, done, v0 + abs(f * p + s) / {GAIN} as var, (d - f * p - s) ** 2 / nullif(v0 + abs(f * p + s) / {GAIN}, 0) * m as r from p{k} p join s{k} t using ({key})),
        p{k + 1} as materialized (select frame, ord, row, col, d, s, w, p, v0, var, case when not done and r > {CLIP * CLIP} and row = arg_max(row, struct_pack(r := r, k := -row)) over (partition by {key}) then 0 else m end as m, m as was from r{k}),
        n{k} as materialized (select {key}, sum(m * p * (d - s) * w / var) / nullif(sum(m * p * p * w / var), 0) as f, sum(m * p * w) / nullif(sum(m * p * p * w / var), 0) as fv, sum(was - m) > 0 as hit from p{k + 1} group by all),
        s{k + 1} as materialized (select {key}, case when done then t.f else n.f end as f, case when done then t.fv else n.fv end as fv, done or not hit as done, rounds + (not done)::int as rounds from s{k} t join n{k} n using ({key}))"""
    left = f"(select {key}, count(*) filter (where m = 0 and w > 0) as n_masked from p9 group by all)"
    return sql + f" select frame, cast(ord as int) as ord, col, round(f, 3) as flux, round(fv, 3) as variance, rounds, cast(n_masked as int) as n_masked from s9 join {left} using ({key})"


def cut(spark, sf_dir):
    k = F.col("row") % 8
    return pixels(spark, sf_dir).select(
        "frame",
        F.floor(F.col("row") / 8).cast("int").alias("ord"),
        "row",
        "col",
        "data",
        "sky",
        (F.col("quantity") * 4 + F.abs("data") / GAIN).alias("variance"),
        F.when(k == 0, 0.5).when(k == 7, 0.0).otherwise(1.0).alias("weight"),
        ((1 + F.least(k, 8 - k)) / 20.0).alias("profile"),
        F.when((F.col("row") + F.col("col")) % 9 == 0, 0).otherwise(1).alias("mask"),
    )


@Q.add("optimal_extract_to_end", _to_the_end_sql())
def optimal_extract_to_end(spark, sf_dir):
    """Optimal extraction with a given profile; each column masks its worst pixel until none is beyond the clip."""
    out = extraction.optimally_extracted(cut(spark, sf_dir), ["frame", "ord", "col"], CLIP, GAIN)
    return out.select("frame", "ord", "col", F.round("flux", 3).alias("flux"), F.round("variance", 3).alias("variance"), "rounds", "n_masked")


@Q.add("optimal_extract_profile")
def optimal_extract_profile(spark, sf_dir):
    """Optimal extraction with a profile that is estimated from the order before each round, until a round masks nothing."""
    out = extraction.profiled_to_end(cut(spark, sf_dir).drop("profile"), ["frame", "ord"], CLIP, width=15, knots=6, gain=GAIN)
    return out.select("frame", "ord", "col", "flux", "variance", "rounds")


# filling and smoothing


GRID = f"(select frame, a.range::int as row, b.range::int as col from (select distinct frame from {PIXELS}), range({HEIGHT}) a, range({WIDTH}) b)"


def full(spark, sf_dir):
    """Every pixel of every frame; those that no row fell on are null."""
    each = pixels(spark, sf_dir)
    places = spark.range(HEIGHT * WIDTH).select(F.floor(F.col("id") / WIDTH).cast("int").alias("row"), (F.col("id") % WIDTH).cast("int").alias("col"))
    return each.select("frame").distinct().crossJoin(F.broadcast(places)).join(each, ["frame", "row", "col"], "left")  # a frame's places


@Q.add(
    "nearest_good_pixel",
    f"""with p as (select g.frame, g.row, g.col, data from {GRID} g left join {PIXELS} p using (frame, row, col)), bad as (select * from p where data is null), good as (select * from p where data is not null),
    n as (select b.frame, b.row, b.col, arg_min(g.data, struct_pack(d := (b.row - g.row) ** 2 + (b.col - g.col) ** 2, r := g.row, c := g.col)) as data from bad b join good g on g.frame = b.frame group by 1, 2, 3)
    select frame, row, col, data from n union all select * from good""",
)
def nearest_good_pixel(spark, sf_dir):
    """Pixels without data take the value of the nearest one that has some."""
    return frames.nearest_filled(full(spark, sf_dir).select("frame", "row", "col", "data"), ["frame"], "row", "col", "data")


_TURNED = lambda at, n: f"(case when mod({at} + {2 * n}, {2 * n}) < {n} then mod({at} + {2 * n}, {2 * n}) else {2 * n - 1} - mod({at} + {2 * n}, {2 * n}) end)"


@Q.add(
    "gaussian_smoothed_frame",
    f"""with p as (select g.frame, g.row, g.col, coalesce(data, 0) as v from {GRID} g left join {PIXELS} p using (frame, row, col)),
    w as (select range - 6 as k, exp(-0.5 * ((range - 6) / 1.5) ** 2) / (select sum(exp(-0.5 * ((range - 6) / 1.5) ** 2)) from range(13)) as w from range(13)),
    a as (select g.frame, g.row, g.col, sum(w * p.v) as v from {GRID} g, w, p where p.frame = g.frame and p.row = g.row and p.col = {_TURNED("g.col + k", WIDTH)} group by 1, 2, 3)
    select g.frame, g.row, g.col, round(sum(w * a.v), 4) as smooth from {GRID} g, w, a where a.frame = g.frame and a.col = g.col and a.row = {_TURNED("g.row + k", HEIGHT)} group by 1, 2, 3""",
)
def gaussian_smoothed_frame(spark, sf_dir):
    """Each frame smoothed along its rows and then along its columns; the ends are reflected."""
    p = full(spark, sf_dir).select("frame", "row", "col", F.coalesce("data", F.lit(0.0)).alias("smooth"))
    out = frames.gaussian_smoothed(p, ["frame"], "row", "col", "smooth", 1.5)
    return out.withColumn("smooth", F.round("smooth", 4))


@Q.add("straylight_columns")
def straylight_columns(spark, sf_dir):
    """Stray light: a polynomial through each column's pixels between the orders, patched, smoothed and levelled."""
    p = full(spark, sf_dir).select("frame", "row", "col", "data")
    between = p.filter("row % 8 in (0, 7) and data is not null")
    basis = fits.powers(F.col("row").cast("double"), 2)
    fit = fits.least_squares(between, ["frame", "col"], basis, "data", least=3)
    light = p.join(fit, ["frame", "col"], "left").select("frame", "row", "col", "data", fits.evaluated(basis).alias("light"))
    patched = frames.nearest_filled(light, ["frame"], "row", "col", "light")
    smooth = frames.gaussian_smoothed(patched, ["frame"], "row", "col", "light", 3.0)
    both = smooth.join(between, ["frame", "row", "col"], "left")
    level = both.groupBy("frame").agg(F.median(F.col("data") - F.col("light")).alias("level"))
    return both.join(level, "frame").select("frame", "row", "col", F.greatest(F.col("light") + F.col("level"), F.lit(0.0)).alias("light"))


# combs


def _near_sql(source: str) -> str:
    """Peaks (g, x, rough) with the median step around them and how far they are off the comb."""
    return f"""(select g, x, rough, usual, list_sort(list_transform(list_filter(near, lambda y: y <> x), lambda y: abs((x - y) / usual - round((x - y) / usual)))) as offs
        from (select *, list_sort(steps)[(len(steps) + 1) // 2] as usual
              from (select g, x, rough, list_filter(list(step) over w, lambda s: s is not null) as steps, list(x) over w as near
                    from (select *, x - lag(x) over (partition by g order by x) as step from {source}) window w as (partition by g order by x rows between 8 preceding and 8 following))))"""


#: Peaks of one comb for each 1000 order keys: a tenth of them missing, every twentieth followed by a false one.
PEAKS = """(select o_orderkey // 1000 as g, 20.0::double * k * (1 + k * 0.0002) + j + f * 8.4 as x, k + 5000 + (o_custkey % 5 - 2) / 8.0 + f * 0.42 as rough
    from (select o_orderkey, o_custkey, o_orderkey % 1000 as k, (o_custkey % 7) * 0.05::double as j from orders where o_custkey % 10 <> 3), (values (0), (1)) t(f) where f = 0 or o_custkey % 20 = 7)"""


@Q.add(
    "comb_modes",
    f"""with a as materialized {_near_sql(PEAKS)}, t as materialized (select g, x, rough from a where offs[(len(offs) + 1) // 2] <= {combs.OFF_COMB}), b as materialized {_near_sql("t")},
    n as (select *, coalesce(round((x - lag(x) over (partition by g order by x)) / usual), 0) as step from b), c as (select *, sum(step) over (partition by g order by x rows unbounded preceding) as n from n),
    f as (select g, mode(round(rough - n)) as first from c group by 1)
    select c.g, cast(n + first as bigint) as mode, round(x, 4) as x from c join f using (g) where len(offs) > 0 qualify row_number() over (partition by c.g, n order by offs[(len(offs) + 1) // 2], x) = 1""",
)
def comb_modes(spark, sf_dir):
    """Peaks with their number in the comb, some missing and some false."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    k = key % 1000
    one = table(spark, sf_dir, "orders").filter(cust % 10 != 3).withColumn("f", F.explode(F.array(F.lit(0), F.lit(1)))).filter((F.col("f") == 0) | (cust % 20 == 7))
    x = F.lit(20.0) * k * (1 + k * 0.0002) + (cust % 7) * 0.05 + F.col("f") * 8.4
    peaks = one.select(F.floor(key / 1000).alias("g"), x.alias("x"), (k + 5000 + (cust % 5 - 2) / 8.0 + F.col("f") * 0.42).alias("rough"))
    return combs.mode_numbers(peaks, ["g"], "x", "rough").select("g", "mode", F.round("x", 4).alias("x"))


# master frames


@Q.add(
    "master_flat",
    f"""with p as (select frame, frame % 3 as lamp_id, row, col, (data - (row + 2 * col) / 10.0::double) / (1 + frame % 4) - 0.01::double * row as rate from {PIXELS}),
    q as (select lamp_id, row, col, quantile_cont(rate, [0.16, 0.5, 0.84]) as q from p group by 1, 2, 3),
    s as (select p.lamp_id, p.row, p.col, avg(rate) as mean, count(rate) as n from p join q using (lamp_id, row, col) where abs(rate - q[2]) <= 2.1 * (q[3] - q[1]) / 2 group by 1, 2, 3),
    f as (select lamp_id, row, col, n, mean, row // 8 as o, mean / nullif(600.0::double + 5 * col - (case when col = 7 then 635 else 0 end), 0) as flat from s),
    c as (select lamp_id, o, round_even(flat * 100, 0) as bin, count(*) as k from f where o > 0 and mean > 300 and flat is not null group by 1, 2, 3),
    m as (select lamp_id, o, arg_min(bin, struct_pack(a := -k, b := bin)) / 100 as mode from c group by 1, 2),
    v as (select lamp_id, row, col, n, mean, case when o > 0 and mean >= 300 then flat / (case when mean > 300 then nullif(mode, 0) else 1 end) end as v from f left join m using (lamp_id, o))
    select lamp_id, row, col, round(case when v between 0.1 and 2.5 then v else 1 end, 5) as flat, n, round(mean, 3) as stack from v""",
)
def master_flat(spark, sf_dir):
    """A flat of each lamp from all its frames; three lamps, four orders, one column without light."""
    p = pixels(spark, sf_dir).select("frame", (F.col("frame") % 3).alias("lamp_id"), "row", "col", "data", (1 + F.col("frame") % 4).cast("double").alias("exptime"))
    places = spark.range(HEIGHT * WIDTH).select(F.floor(F.col("id") / WIDTH).cast("int").alias("row"), (F.col("id") % WIDTH).cast("int").alias("col"))
    row, col = F.col("row"), F.col("col")
    bias = places.select("row", "col", ((row + 2 * col) / F.lit(10.0)).alias("bias"))
    dark = places.select("row", "col", (F.lit(0.01) * row).alias("dark"))
    lamp = places.select("row", "col", (F.lit(600.0) + 5 * col - F.when(col == 7, 635).otherwise(0)).alias("lamp"))
    orderlets = places.select("row", "col", F.floor(row / 8).cast("int").alias("orderlet"))
    out = masters.master_flat(p, bias, dark, lamp, orderlets, ["row", "col"], 300.0, 2.1, ["lamp_id"])
    return out.select("lamp_id", "row", "col", F.round("flat", 5).alias("flat"), "n", F.round("stack", 3).alias("stack"))
