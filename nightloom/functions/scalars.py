"""Column functions for observation ids, file names, dates, angles, spectra and loosely typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that loosely typed sources use for true, false and missing.
TRUE_TOKENS = ["1", "true", "t", "yes", "y", "open"]
FALSE_TOKENS = ["0", "false", "f", "no", "n", "closed"]
#: Planck constant (J s), speed of light (m/s), Boltzmann constant (J/K).
PLANCK, LIGHT, BOLTZMANN = 6.62607015e-34, 2.99792458e8, 1.380649e-23
#: How an observation id begins, and its pattern.
ID_PREFIX = "KP."
ID_PATTERN = r"^KP\.\d{8}\.\d{5}\.\d{2}$"


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a timestamp, to the microsecond."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def mjd(ts: Column) -> Column:
    """Modified Julian date."""
    return F.lit(40587.0) + F.unix_micros(ts.cast("timestamp")) / F.lit(86400e6)


def datecode(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def observation_id(ts: Column, nth: Column) -> Column:
    """The prefix, <yyyymmdd>.<seconds of the day, five digits>.<two digits>."""
    of_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.concat(F.lit(ID_PREFIX), datecode(ts), F.lit("."), F.lpad(of_day.cast("string"), 5, "0"), F.lit("."), F.lpad((nth % 100).cast("string"), 2, "0"))


def is_observation_id(c: Column) -> Column:
    return c.rlike(ID_PATTERN)


def datecode_of(c: Column) -> Column:
    """The date part of an id or of a file named after it."""
    return F.get(F.split(F.regexp_replace(c, r"(_2D|_L1|_L2)?(\.fits)?$", ""), r"\."), F.lit(1))


def level_filename(obs_id: Column, level: Column) -> Column:
    return F.concat(obs_id, F.when(level == "L0", F.lit("")).otherwise(F.concat(F.lit("_"), level)), F.lit(".fits"))


def level_of(name: Column) -> Column:
    """Data level that a file name tells; files without a mark are L0."""
    return F.when(name.contains("_2D"), "2D").when(name.contains("_L1"), "L1").when(name.contains("_L2"), "L2").otherwise("L0")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def observation_time(obs_id: Column) -> Column:
    """Start of the day of an id plus its seconds; 2000-01-01 for a malformed id."""
    day = F.to_date(F.substring(obs_id, 4, 8), "yyyyMMdd").cast("timestamp_ntz")
    made = F.timestamp_add("SECOND", F.substring(obs_id, 13, 5).try_cast("int"), day)
    return F.when(is_observation_id(obs_id), made).otherwise(F.lit("2000-01-01").cast("timestamp_ntz"))


def first_datecode(name: Column) -> Column:
    """The first run of eight digits, null if there is none."""
    return F.nullif(F.regexp_extract(name, r"(\d{8})", 1), F.lit(""))


def degrees(sexagesimal: Column, per_unit: float = 1.0) -> Column:
    """Degrees of 'dd:mm:ss.s' (or hours, with per_unit 15); the sign stands before the first field."""
    part = F.split(F.regexp_replace(F.trim(sexagesimal), r"^[+-]", ""), ":")
    size = F.get(part, F.lit(0)).try_cast("double") + F.get(part, F.lit(1)).try_cast("double") / 60 + F.get(part, F.lit(2)).try_cast("double") / 3600
    return F.when(F.trim(sexagesimal).startswith("-"), -size).otherwise(size) * F.lit(per_unit)


def loose_boolean(c: Column) -> Column:
    """True or false for the usual tokens of either, else null."""
    token = F.lower(F.trim(c.cast("string")))
    return F.when(token.isin(TRUE_TOKENS), True).when(token.isin(FALSE_TOKENS), False)


def age_in_days(at: Column, reference: Column, missing: int = -99) -> Column:
    """Whole days from the reference to the observation, missing where there is no reference."""
    return F.coalesce(F.datediff(at, reference), F.lit(missing))


def planck(wavelength: Column, temperature: float) -> Column:
    """Spectral radiance of a black body at a wavelength in metres."""
    return F.lit(2 * PLANCK * LIGHT**2) / F.pow(wavelength, F.lit(5.0)) / (F.exp(F.lit(PLANCK * LIGHT / (BOLTZMANN * temperature)) / wavelength) - 1)


def horner(coefficients: Column, x: Column) -> Column:
    """Polynomial with coefficients from the constant up."""
    return F.aggregate(F.reverse(coefficients), F.lit(0.0), lambda acc, c: acc * x + c)


def comb_lines(f0: Column, repetition: Column, first: int, last: int) -> Column:
    """Wavelengths in angstrom of the comb f0 + n * repetition, both in Hz."""
    return F.transform(F.sequence(F.lit(first), F.lit(last)), lambda n: F.lit(LIGHT * 1e10) / (f0 + n * repetition))


def doppler(wavelength: Column, velocity: Column) -> Column:
    """A wavelength seen from a source that recedes with a velocity in m/s."""
    return wavelength * (1 + velocity / F.lit(LIGHT))


def by_quadrant(row: Column, col: Column, half_rows: int, half_cols: int, values: list[float]) -> Column:
    """The value of the amplifier that reads a pixel: lower left, lower right, upper left, upper right."""
    low_left, low_right, up_left, up_right = map(F.lit, values)
    return F.when(row < half_rows, F.when(col < half_cols, low_left).otherwise(low_right)).otherwise(F.when(col < half_cols, up_left).otherwise(up_right))


def sun_altitude(ts: Column, latitude: float, longitude: float) -> Column:
    """Altitude of the sun in degrees by the low-precision formulas of the Astronomical Almanac (about 0.01 degrees)."""
    n = mjd(ts) - 51544.5
    mean = F.radians(280.460 + 0.9856474 * n)
    anomaly = F.radians(357.528 + 0.9856003 * n)
    ecliptic = mean + F.radians(1.915 * F.sin(anomaly) + 0.020 * F.sin(2 * anomaly))
    tilt = F.radians(23.439 - 0.0000004 * n)
    declination = F.asin(F.sin(tilt) * F.sin(ecliptic))
    ascension = F.atan2(F.cos(tilt) * F.sin(ecliptic), F.cos(ecliptic))
    sidereal = F.radians(280.46061837 + 360.98564736629 * n + longitude)
    hour = sidereal - ascension
    lat = F.radians(F.lit(latitude))
    return F.degrees(F.asin(F.sin(lat) * F.sin(declination) + F.cos(lat) * F.cos(declination) * F.cos(hour)))
