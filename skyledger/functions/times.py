"""Times of observation as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions import sky

#: Seconds that light takes for one astronomical unit, and the constant of aberration in arcseconds.
LIGHT_SECONDS, ABERRATION = 499.00478, 20.49552


def julian_date(ts: Column, places: int | None = 5) -> Column:
    value = F.unix_micros(ts).cast("double") / F.lit(86400e6) + F.lit(2440587.5)
    return value if places is None else F.round(value, places)


def julian_year(ts: Column, places: int | None = 8) -> Column:
    value = F.lit(2000.0) + (julian_date(ts, None) - F.lit(2451545.0)) / F.lit(365.25)
    return value if places is None else F.round(value, places)


def to_utc(ts: Column, zone: Column | str) -> Column:
    """The UTC of a local civil time."""
    return F.to_utc_timestamp(ts, zone)


def seconds_of(text: Column) -> Column:
    """Seconds of 'H', 'H:M', 'H:M:S' (a trailing colon is ignored; hours may be 24 or more); null if a part is no number."""
    parts = F.split(F.regexp_replace(F.trim(text), ":+$", ""), ":")
    part = lambda k: F.when(F.size(parts) > k, F.get(parts, F.lit(k)).try_cast("double")).otherwise(F.lit(0.0))
    return F.when(text.isNotNull(), part(0) * 3600 + part(1) * 60 + part(2))


def time_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.concat_ws(":", *(F.lpad(v.cast("string"), 2, "0") for v in (F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)))


def at_time(date: Column, seconds: Column, evening: bool = False) -> Column:
    """Timestamp of seconds after the start of a date; with `evening` dates, hours before noon belong to the next day."""
    later = F.when(seconds < 43200, 86400).otherwise(0) if evening else F.lit(0)
    return F.timestamp_micros((F.unix_micros(F.to_timestamp(date)) + (seconds + later) * F.lit(1e6)).cast("long"))


def end_after_start(start: Column, end: Column) -> Column:
    """An end before the start is on the next day."""
    return F.when(end < start, end + F.expr("INTERVAL 1 DAY")).otherwise(end)


def mid_time(start: Column, end: Column, exptime: Column) -> Column:
    """Half-way between start and end; without an end half the exposure time (seconds) after the start; else null."""
    micros = F.when(end.isNotNull(), (F.unix_micros(start) + F.unix_micros(end)) / 2).otherwise(F.unix_micros(start) + exptime * F.lit(5e5))
    return F.timestamp_micros(F.floor(micros).cast("long"))


def exposure_seconds(start: Column, end: Column, exptime: Column) -> Column:
    return F.coalesce(exptime, (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6))


def sun(jd: Column) -> tuple[Column, Column]:
    """Ecliptic longitude (degrees) and distance (astronomical units) of the Sun, to about 0.01 degrees."""
    n = jd - F.lit(2451545.0)
    g = F.radians(F.lit(357.528) + F.lit(0.9856003) * n)
    longitude = sky.modulo(F.lit(280.460) + F.lit(0.9856474) * n + F.lit(1.915) * F.sin(g) + F.lit(0.020) * F.sin(g * 2), 360.0)
    return longitude, F.lit(1.00014) - F.lit(0.01671) * F.cos(g) - F.lit(0.00014) * F.cos(g * 2)


def sidereal_to_ut(date: Column, sidereal_seconds: Column, longitude: Column) -> Column:
    """UT of the first transit, after noon of a date, of an equatorial star whose right ascension is the sidereal time;
    annual aberration is taken into account, whole seconds."""
    noon = F.to_timestamp(date) + F.expr("INTERVAL 12 HOURS")
    jd = julian_date(noon, None)
    right_ascension = sidereal_seconds / F.lit(240.0)
    tilt = math.cos(math.radians(sky.OBLIQUITY))
    sun_at, a = F.radians(sun(jd)[0]), F.radians(right_ascension)
    apparent = right_ascension - F.lit(ABERRATION / 3600) * (F.cos(a) * F.cos(sun_at) * F.lit(tilt) + F.sin(a) * F.sin(sun_at))
    ahead = sky.modulo(apparent - sky.sidereal_degrees(jd, longitude), 360.0)
    return F.timestamp_seconds(F.floor(F.unix_micros(noon) / F.lit(1e6) + ahead / F.lit(360.98564736629) * F.lit(86400.0)))


def heliocentric(jd: Column, ra: Column, dec: Column) -> Column:
    """Heliocentric Julian date of an observation."""
    longitude, distance = sun(jd)
    l, e = F.radians(longitude), math.radians(sky.OBLIQUITY)
    x, y, z = sky.unit_vector(ra, dec)
    toward = x * F.cos(l) + y * F.sin(l) * F.lit(math.cos(e)) + z * F.sin(l) * F.lit(math.sin(e))
    return jd - distance * toward * F.lit(LIGHT_SECONDS / 86400)


def plate_epoch(year: Column, date_orig: Column, date_obs: Column, known: Column | None = None) -> Column:
    """Epoch of a plate: one that is known already, else a year above 1800, else the middle of the year of the first date that has one."""
    number = year.cast("string").try_cast("double")
    middle = lambda c: F.regexp_extract(c.cast("string"), r"^(\d{4})", 1).try_cast("double") + F.lit(0.5)
    found = F.coalesce(F.when(number > 1800, number), middle(date_orig), middle(date_obs))
    return found if known is None else F.coalesce(known, found)


def reconciled_count(numexp: Column, *lists: Column) -> Column:
    """Number of exposures: what is stated, or the longest list of times if that is longer."""
    return F.greatest(F.coalesce(numexp, F.lit(1)), *(F.greatest(F.size(F.coalesce(x, F.array().cast("array<string>"))), F.lit(0)) for x in lists))


def padded(values: Column, n: Column) -> Column:
    """A list filled up with nulls to n entries."""
    have = F.coalesce(values, F.array().cast("array<string>"))
    return F.concat(have, F.array_repeat(F.lit(None).cast("string"), F.greatest(n - F.size(have), F.lit(0)).cast("int")))
