"""The observation checks by keyword, over one header row per observation.

Each condition is an expression over the header's columns; limits are the instrument's.  The header is made from
the events table, one observation per event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as K
from ._common import Queries, table

Q = Queries()

#: Column of the header -> how it follows from an event.
HEADER = {
    "level": "case event_id % 4 when 0 then 'L0' when 1 then '2D' when 2 then 'L1' else 'L2' end",
    "source": "case (event_id + user_id) % 10 when 0 then 'Star' when 1 then 'Flat' when 2 then 'LFC' when 3 then 'Etalon' when 4 then 'Dark' when 5 then 'Bias' when 6 then 'ThAr' when 7 then 'UNe' when 8 then 'Sun' else 'Wide Flat' end",
    "exptime": "value",
    "elapsed": "case when user_id % 10 = 0 then 6.3 else value + 0.05 end",
    "elevation": "user_id % 90",
    "agitator": "case when user_id % 6 = 0 then 'Stopped' else 'Running' end",
    "agitator_speed": "user_id * 20.0 - 1500.0",
    "em_saturated": "user_id % 4",
    "em_columns": "100",
    "em_negative_run": "user_id % 30",
    "green_temp": "-100.0 + (user_id % 50) / 1000.0",
    "red_temp": "-101.0 + (user_id % 80) / 40.0",
    "lid_temp": "23.6 + (user_id % 7) / 7000.0",
    "lid_set": "case when user_id % 2 = 0 then 23.6002e0 end",
    "chamber_temp": "23.9 + (user_id % 5) / 5000.0",
    "chamber_set": "case when user_id % 3 = 0 then 23.9003e0 end",
    "guide_rms": "value / 1.5",
    "guide_bias": "value - 60.0",
    "guide_saturated": "user_id % 8",
    "guide_saturated_share": "(user_id % 20) / 100.0",
    "vignetted": "user_id % 17 = 0",
    "ntp_ms": "value * 1.5",
    "age_bias": "case when user_id % 23 = 0 then -99 else user_id % 12 - 6 end",
    "age_dark": "user_id % 13 - 6",
    "age_flat": "user_id % 14 - 7",
    "age_wls": "user_id % 6 - 3",
    "age_wls2": "user_id % 7 - 3",
    "age_trace": "user_id % 15 - 7",
    "age_lamp": "user_id % 16 - 8",
    "mean_flux": "value / 6.0",
    "mean_flux_red": "value / 5.0",
    "flux_p98": "value * 60.0",
    "snr_low": "value * 8.0",
    "snr_high": "value * 30.0",
    "negative_share": "(user_id % 30) / 1000.0",
    "green_first": "case when user_id % 47 = 0 then null else user_id % 5 end",
    "green_last": "35 - user_id % 3",
    "red_first": "case when user_id % 6 = 0 then 1 else 0 end",
    "red_last": "32 - user_id % 3",
    "bcv_change": "(value - 50.0) / 45.0",
    "n_nan": "user_id",
    "hk_shutter": "user_id % 3 <> 0",
    "clear_min": "case when value > 20 then 1 else 0 end",
    "monotonic": "user_id % 19 <> 0",
    "rows_green": "case when user_id % 29 = 0 then 0 else 4080 end",
    "rows_red": "case when user_id % 31 = 0 then 0 else 4080 end",
    "orders_green": "35 - (case when user_id % 37 = 0 then 1 else 0 end)",
    "orders_red": "32",
    "hk_rows": "case when user_id % 11 = 0 then 0 else 255 end",
    "n_telemetry": "case when user_id % 9 = 0 then 0 else 120 end",
    "date_gap": "(user_id % 25) / 10.0",
    "junk": "user_id % 41 = 0",
    "gaia": "case when user_id % 12 = 0 then 'x' else '123' end",
}
ALL = ["all"]
LIT = ["Flat", "LFC", "Etalon", "ThAr", "UNe", "Sun", "Star"]

#: The set points and limits of the instrument, in each condition.  Keyword, levels, sources, condition.
CHECKS = [
    ("NOTJUNK", ALL, ALL, "not junk"),
    ("MONOTWLS", ["L1"], ALL, "monotonic"),
    ("TIMCHKL0", ["L0"], ALL, "date_gap <= 0.1"),
    ("TIMCHKL2", ["L2"], ALL, "date_gap <= 0.1"),
    ("EMSAT", ["L0"], ALL, "em_saturated <= 1.5 * em_columns / 100"),
    ("EMNEG", ["L0"], ALL, "em_negative_run < 20"),
    ("LFC2DFOK", ["2D"], ["LFC"], "flux_p98 >= 4000"),
    ("LOWBIAS", ["2D"], ["Bias"], "mean_flux <= 10 and mean_flux_red <= 10"),
    ("LOWDARK", ["2D"], ["Dark"], "mean_flux <= 11 and mean_flux_red <= 13"),
    ("DATAPRL1", ["L1"], ALL, "orders_green = 35 and orders_red = 32"),
    ("CAHKPRL1", ["L1"], ALL, "hk_rows > 0"),
    ("DATAPRL2", ["L2"], ALL, "orders_green + orders_red = 67"),
    ("CAHKPR2D", ["2D"], ALL, "hk_rows = 255"),
    ("DATAPR2D", ["2D"], ALL, "rows_green = 4080 and rows_red = 4080"),
    ("POS2DSNR", ["2D"], ALL, "negative_share <= 0.01"),
    ("LFCSAT", ["L1"], ["LFC"], "snr_high < 2800"),
    ("GOODREAD", ["L0"], ALL, "not (exptime >= 7 and elapsed between 6.0 and 6.7)"),
    ("OLDBIAS", ["2D"], ["Dark", "Wide Flat", *LIT], "age_bias <> -99 and abs(age_bias) <= 5"),
    ("OLDDARK", ["2D"], ["Bias", "Wide Flat", *LIT], "age_dark <> -99 and abs(age_dark) <= 5"),
    ("OLDFLAT", ["2D"], ["Bias", "Dark", "Wide Flat", *LIT[1:]], "age_flat <> -99 and abs(age_flat) <= 5"),
    ("OLDWLS", ["L1"], ALL, "abs(age_wls) <= 2"),
    ("OLDWLS2", ["L1"], ALL, "abs(age_wls2) <= 2"),
    ("WLSL1", ["L1"], ALL, "age_wls <= 0 and age_wls2 >= 0 and age_wls <> age_wls2"),
    ("FLATSNR", ["L1"], ["Flat"], "snr_low >= 40 and snr_high < 1600"),
    ("LFCLINES", ["L1"], ["LFC"], "green_first <= 2 and green_last >= 34 and red_first <= 0 and red_last >= 31"),
    ("LFCLINEP", ["L1"], ["LFC"], "green_first <= 15 and green_last >= 34 and red_first <= 0 and red_last >= 31"),
    ("ETALINES", ["L1"], ["Etalon"], "green_first <= 2 and green_last >= 34 and red_first <= 0 and red_last >= 31"),
    ("NTPGOOD", ["L0"], ALL, "ntp_ms < 100"),
    ("GUIDGOOD", ["L0"], ["Star"], "guide_rms <= 50 and guide_bias <= 50"),
    ("TARGPLAU", ["L0"], ["Star"], "gaia = '123'"),
    ("QCPCBCV", ["L2"], ["Star"], "bcv_change <= 1 and bcv_change >= -1"),
    ("OLDTRAC", ["L1"], ["Dark", *LIT], "abs(age_trace) <= 5"),
    ("OLDLAMP", ["L1"], LIT, "abs(age_lamp) <= 5"),
    ("AGITOK", ["L0"], LIT, "agitator = 'Running' and abs(agitator_speed) > 1000"),
    ("GUIDSAT", ["L0"], ["Star"], "guide_saturated <= 3 and guide_saturated_share <= 0.1"),
    ("NOTVIGN", ["L0"], ["Star"], "not vignetted"),
    ("GOODEL", ["L0"], ["Star"], "elevation >= 30"),
    ("ETASTEMP", ["L0"], ["Etalon"], "abs(lid_temp - coalesce(lid_set, 23.6)) <= 0.0005 and abs(chamber_temp - coalesce(chamber_set, 23.9)) <= 0.0005"),
    ("TELEPRL0", ["L0"], ALL, "n_telemetry > 0"),
    ("HKSHTOPN", ["L0"], LIT, "hk_shutter"),
    ("GRCCDT10", ["L0"], ALL, "abs(green_temp + 100.0) < 0.01"),
    ("GRCCDT1", ["L0"], ALL, "abs(green_temp + 100.0) < 1"),
    ("RDCCDT10", ["L0"], ALL, "abs(red_temp + 100.0) < 0.01"),
    ("RDCCDT1", ["L0"], ALL, "abs(red_temp + 100.0) < 1"),
    ("CLEARSKY", ["L0"], ["Sun"], "clear_min = 1"),
    ("L1NAN", ["L1"], ALL, "n_nan <= 50"),
]

HEADER_SQL = "(select event_id, " + ", ".join(f"{v} as {k}" for k, v in HEADER.items()) + " from events)"

#: The same checks written out by hand, with every limit and source list anew.
MATRIX_SQL = f"""
    select event_id,
      coalesce(not junk, false) as NOTJUNK,
      case level when 'L1' then coalesce(monotonic, false) end as MONOTWLS,
      case level when 'L0' then coalesce(date_gap <= 0.1, false) end as TIMCHKL0,
      case level when 'L2' then coalesce(date_gap <= 0.1, false) end as TIMCHKL2,
      case level when 'L0' then not coalesce(em_saturated / 100.0 > 1.5 / 100, true) end as EMSAT,
      case level when 'L0' then coalesce(em_negative_run <= 19, false) end as EMNEG,
      case when level = '2D' and source = 'LFC' then coalesce(not flux_p98 < 4000, false) end as LFC2DFOK,
      case when level = '2D' and source = 'Bias' then coalesce(greatest(mean_flux, mean_flux_red) <= 10, false) end as LOWBIAS,
      case when level = '2D' and source = 'Dark' then coalesce(mean_flux <= 11 and mean_flux_red <= 13, false) end as LOWDARK,
      case level when 'L1' then orders_green = 35 and orders_red = 32 end as DATAPRL1,
      case level when 'L1' then hk_rows <> 0 end as CAHKPRL1,
      case level when 'L2' then orders_green + orders_red = 67 end as DATAPRL2,
      case level when '2D' then hk_rows = 255 end as CAHKPR2D,
      case level when '2D' then least(rows_green, rows_red) = 4080 end as DATAPR2D,
      case level when '2D' then not negative_share > 0.01 end as POS2DSNR,
      case when level = 'L1' and source = 'LFC' then coalesce(snr_high < 2800, false) end as LFCSAT,
      case level when 'L0' then coalesce(exptime < 7 or elapsed < 6.0 or elapsed > 6.7, false) end as GOODREAD,
      case when level = '2D' and source <> 'Bias' then age_bias between -5 and 5 end as OLDBIAS,
      case when level = '2D' and source <> 'Dark' then age_dark between -5 and 5 end as OLDDARK,
      case when level = '2D' and source <> 'Flat' then age_flat between -5 and 5 end as OLDFLAT,
      case level when 'L1' then age_wls between -2 and 2 end as OLDWLS,
      case level when 'L1' then age_wls2 between -2 and 2 end as OLDWLS2,
      case level when 'L1' then age_wls <= 0 and age_wls2 >= 0 and age_wls <> age_wls2 end as WLSL1,
      case when level = 'L1' and source = 'Flat' then coalesce(not snr_low < 40 and snr_high < 1600, false) end as FLATSNR,
      case when level = 'L1' and source = 'LFC' then coalesce(green_first in (0, 1, 2) and green_last in (34, 35) and red_first = 0 and red_last in (31, 32), false) end as LFCLINES,
      case when level = 'L1' and source = 'LFC' then coalesce(green_first < 16 and green_last in (34, 35) and red_first = 0 and red_last in (31, 32), false) end as LFCLINEP,
      case when level = 'L1' and source = 'Etalon' then coalesce(green_first in (0, 1, 2) and green_last in (34, 35) and red_first = 0 and red_last in (31, 32), false) end as ETALINES,
      case level when 'L0' then coalesce(ntp_ms < 100, false) end as NTPGOOD,
      case when level = 'L0' and source = 'Star' then coalesce(guide_rms <= 50 and guide_bias <= 50, false) end as GUIDGOOD,
      case when level = 'L0' and source = 'Star' then gaia = '123' end as TARGPLAU,
      case when level = 'L2' and source = 'Star' then coalesce(bcv_change between -1 and 1, false) end as QCPCBCV,
      case when level = 'L1' and source not in ('Bias', 'Wide Flat') then age_trace between -5 and 5 end as OLDTRAC,
      case when level = 'L1' and source not in ('Bias', 'Dark', 'Wide Flat') then age_lamp between -5 and 5 end as OLDLAMP,
      case when level = 'L0' and source not in ('Bias', 'Dark', 'Wide Flat') then agitator = 'Running' and (agitator_speed < -1000 or agitator_speed > 1000) end as AGITOK,
      case when level = 'L0' and source = 'Star' then guide_saturated <= 3 and not guide_saturated_share > 0.1 end as GUIDSAT,
      case when level = 'L0' and source = 'Star' then not vignetted end as NOTVIGN,
      case when level = 'L0' and source = 'Star' then elevation >= 30 end as GOODEL,
      case when level = 'L0' and source = 'Etalon' then lid_temp - ifnull(lid_set, 23.6) between -0.0005 and 0.0005 and chamber_temp - ifnull(chamber_set, 23.9) between -0.0005 and 0.0005 end as ETASTEMP,
      case level when 'L0' then n_telemetry <> 0 end as TELEPRL0,
      case when level = 'L0' and source not in ('Bias', 'Dark', 'Wide Flat') then hk_shutter end as HKSHTOPN,
      case level when 'L0' then green_temp > -100.01 and green_temp < -99.99 end as GRCCDT10,
      case level when 'L0' then green_temp > -101 and green_temp < -99 end as GRCCDT1,
      case level when 'L0' then red_temp > -100.01 and red_temp < -99.99 end as RDCCDT10,
      case level when 'L0' then red_temp > -101 and red_temp < -99 end as RDCCDT1,
      case when level = 'L0' and source = 'Sun' then clear_min = 1 end as CLEARSKY,
      case level when 'L1' then not n_nan > 50 end as L1NAN
    from {HEADER_SQL}"""


def matrix(spark, sf_dir):
    headers = table(spark, sf_dir, "events").select("event_id", *[F.expr(v).alias(k) for k, v in HEADER.items()])
    checks = [K.Check(k, lambda c=c: F.expr(c), levels, sources) for k, levels, sources, c in CHECKS]
    return K.applied(headers, checks, ["event_id"])


@Q.add("qc_by_keyword", MATRIX_SQL)
def qc_by_keyword(spark, sf_dir):
    """Every check of every observation; null where it does not apply."""
    return matrix(spark, sf_dir)


@Q.add("qc_by_keyword_summary", f"select keyword, count(*) as n, count(*) filter (where pass) as n_pass, cast(floor(100.0 * count(*) filter (where pass) / count(*)) as bigint) as percent from (unpivot (select * exclude (event_id) from ({MATRIX_SQL})) on columns(*) into name keyword value pass) group by 1")
def qc_by_keyword_summary(spark, sf_dir):
    return K.summary(matrix(spark, sf_dir), ["event_id"])
