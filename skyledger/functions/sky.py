"""Positions on the sky as column expressions: all arithmetic stays in generated JVM code."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCSEC = 3600.0

# Rotation from ICRS to Galactic axes (Hipparcos catalogue, vol. 1), and the obliquity at J2000 in degrees.
GALACTIC = (
    (-0.0548755604162154, -0.8734370902348850, -0.4838350155487132),
    (0.4941094278755837, -0.4448296299600112, 0.7469822444972189),
    (-0.8676661490190047, -0.1980763734312015, 0.4559837761750669),
)
OBLIQUITY = 23.4392911


def modulo(value: Column, base: float) -> Column:
    """value - base * floor(value / base): from 0 to base, alike in every SQL engine."""
    return value - F.lit(base) * F.floor(value / F.lit(base))


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def from_vector(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Longitude (0 to 360) and latitude in degrees of a unit vector."""
    return modulo(F.degrees(F.atan2(y, x)), 360.0), F.degrees(F.asin(F.greatest(F.least(z, F.lit(1.0)), F.lit(-1.0))))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance in degrees (haversine, exact for small angles)."""
    h = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(F.asin(F.least(F.sqrt(h), F.lit(1.0))) * 2)


def position_angle(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Direction from the first to the second point, degrees east of north, 0 to 360."""
    d1, d2, da = F.radians(dec1), F.radians(dec2), F.radians(ra2 - ra1)
    return modulo(F.degrees(F.atan2(F.sin(da) * F.cos(d2), F.cos(d1) * F.sin(d2) - F.sin(d1) * F.cos(d2) * F.cos(da))), 360.0)


def directional_offset(ra: Column, dec: Column, angle: Column, distance: Column) -> tuple[Column, Column]:
    """The point at a distance (degrees) in the direction of a position angle."""
    d, r, p = F.radians(dec), F.radians(distance), F.radians(angle)
    sine = F.sin(d) * F.cos(r) + F.cos(d) * F.sin(r) * F.cos(p)
    turn = F.atan2(F.sin(p) * F.sin(r) * F.cos(d), F.cos(r) - F.sin(d) * sine)
    return modulo(ra + F.degrees(turn), 360.0), F.degrees(F.asin(F.greatest(F.least(sine, F.lit(1.0)), F.lit(-1.0))))


def proper_motion(ra: Column, dec: Column, pmra: Column, pmdec: Column, years: Column) -> tuple[Column, Column]:
    """Position after `years`; motions in milliarcseconds a year, that in right ascension along the great circle.

    A missing motion leaves the position as it is.
    """
    moved_ra = ra + years * pmra / F.cos(F.radians(dec)) / 3.6e6
    moved_dec = dec + years * pmdec / 3.6e6
    return F.coalesce(moved_ra, ra), F.coalesce(moved_dec, dec)


def rotated(ra: Column, dec: Column, matrix: tuple[tuple[float, ...], ...]) -> tuple[Column, Column]:
    x, y, z = unit_vector(ra, dec)
    return from_vector(*(x * a + y * b + z * c for a, b, c in matrix))


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    return rotated(ra, dec, GALACTIC)


def ecliptic(ra: Column, dec: Column, obliquity: float = OBLIQUITY) -> tuple[Column, Column]:
    c, s = math.cos(math.radians(obliquity)), math.sin(math.radians(obliquity))
    return rotated(ra, dec, ((1.0, 0.0, 0.0), (0.0, c, s), (0.0, -s, c)))


def precession_matrix(year: float, to_year: float = 2000.0) -> tuple[tuple[float, ...], ...]:
    """Equatorial precession between two epochs (IAU 1976 angles, by way of J2000)."""

    def from_j2000(t: float) -> list[list[float]]:
        zeta = math.radians((2306.2181 * t + 0.30188 * t**2 + 0.017998 * t**3) / ARCSEC)
        z = math.radians((2306.2181 * t + 1.09468 * t**2 + 0.018203 * t**3) / ARCSEC)
        theta = math.radians((2004.3109 * t - 0.42665 * t**2 - 0.041833 * t**3) / ARCSEC)
        cz, sz, ct, st, cx, sx = math.cos(z), math.sin(z), math.cos(theta), math.sin(theta), math.cos(zeta), math.sin(zeta)
        return [[cx * ct * cz - sx * sz, -sx * ct * cz - cx * sz, -st * cz], [cx * ct * sz + sx * cz, -sx * ct * sz + cx * cz, -st * sz], [cx * st, -sx * st, ct]]

    back, forth = from_j2000((year - 2000.0) / 100.0), from_j2000((to_year - 2000.0) / 100.0)
    return tuple(tuple(sum(forth[i][k] * back[j][k] for k in range(3)) for j in range(3)) for i in range(3))


def precessed(ra: Column, dec: Column, year: float, to_year: float = 2000.0) -> tuple[Column, Column]:
    return rotated(ra, dec, precession_matrix(year, to_year))


def sidereal_degrees(jd: Column, longitude: Column) -> Column:
    """Local mean sidereal time in degrees, 0 to 360."""
    days = jd - F.lit(2451545.0)
    t = days / F.lit(36525.0)
    return modulo(F.lit(280.46061837) + F.lit(360.98564736629) * days + F.lit(0.000387933) * t * t + longitude, 360.0)


def zenith_angle(ra: Column, dec: Column, jd: Column, longitude: Column, latitude: Column) -> Column:
    hour = F.radians(sidereal_degrees(jd, longitude) - ra)
    sine = F.sin(F.radians(latitude)) * F.sin(F.radians(dec)) + F.cos(F.radians(latitude)) * F.cos(F.radians(dec)) * F.cos(hour)
    return F.degrees(F.acos(F.greatest(F.least(sine, F.lit(1.0)), F.lit(-1.0))))


def airmass(zenith: Column) -> Column:
    """Rational fit by the cosine of the zenith angle; null below the horizon."""
    c = F.cos(F.radians(zenith))
    value = (F.lit(1.002432) * c * c + F.lit(0.148386) * c + F.lit(0.0096467)) / (c * c * c + F.lit(0.149864) * c * c + F.lit(0.0102963) * c + F.lit(0.000303978))
    return F.when(zenith < 90.0, value)


def sexagesimal(text: Column) -> Column:
    """Degrees (or hours) of 'd:m:s' or 'd:m'; null where a part is no number."""
    parts = F.split(F.trim(text), ":")
    number = lambda k: F.get(parts, F.lit(k)).try_cast("double")
    size = F.abs(number(0)) + F.when(F.size(parts) > 1, number(1)).otherwise(0.0) / 60.0 + F.when(F.size(parts) > 2, number(2)).otherwise(0.0) / 3600.0
    return F.when(F.ltrim(text).startswith("-"), -size).otherwise(size)


def as_sexagesimal(value: Column, signed: bool = False) -> Column:
    """'dd:mm:ss.s' of degrees or hours, rounded to tenths of a second."""
    tenths = F.round(F.abs(value) * 36000).cast("long")
    sign = F.when(value < 0, "-").otherwise("+") if signed else F.when(value < 0, "-").otherwise("")
    return F.concat(sign, F.lpad((F.floor(tenths / 36000)).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.floor(tenths / 600) % 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.floor(tenths / 10) % 60).cast("string"), 2, "0"), F.lit("."), (tenths % 10).cast("string"))


def _spread(v: Column) -> Column:
    """The low 16 bits moved to even places."""
    v = v.cast("long")
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def healpix_nested(ra: Column, dec: Column, order: int) -> Column:
    """Number of the HEALPix pixel (nested scheme, nside = 2 ** order, order to 16) that holds a position (Gorski et al. 2005)."""
    nside = float(1 << order)
    z = F.sin(F.radians(dec))
    tt = modulo(ra, 360.0) / F.lit(90.0)
    low = F.lit((1 << order) - 1).cast("long")
    # Between the polar caps
    jp = F.floor(F.lit(nside) * (F.lit(0.5) + tt - z * 0.75))
    jm = F.floor(F.lit(nside) * (F.lit(0.5) + tt + z * 0.75))
    ifp, ifm = F.shiftright(jp, order), F.shiftright(jm, order)
    face = F.when(ifp == ifm, ifp.bitwiseAND(F.lit(3).cast("long")) + 4).when(ifp < ifm, ifp).otherwise(ifm + 8)
    ix, iy = jm.bitwiseAND(low), low - jp.bitwiseAND(low)
    # In the caps
    quarter = F.least(F.floor(tt), F.lit(3).cast("long"))
    part = tt - quarter
    radius = F.lit(nside) * F.sqrt(F.lit(3.0) * (F.lit(1.0) - F.abs(z)))
    kp, km = F.least(F.floor(part * radius), low), F.least(F.floor((F.lit(1.0) - part) * radius), low)
    middle, north = F.abs(z) <= 2.0 / 3.0, z >= 0
    face = F.when(middle, face).when(north, quarter).otherwise(quarter + 8)
    ix = F.when(middle, ix).when(north, low - km).otherwise(kp)
    iy = F.when(middle, iy).when(north, low - kp).otherwise(km)
    return face * F.lit(1 << (2 * order)).cast("long") + _spread(ix) + F.shiftleft(_spread(iy), 1)


def tan_pixel(ra: Column, dec: Column, ra0: Column, dec0: Column, scale: Column, x0: Column, y0: Column) -> tuple[Column, Column]:
    """Gnomonic projection: pixel coordinates of a position, x against right ascension; null beyond 90 degrees."""
    d, d0, da = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    facing = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    xi = F.when(facing > 0, F.cos(d) * F.sin(da) / facing)
    eta = F.when(facing > 0, (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da)) / facing)
    return x0 - F.degrees(xi) / scale, y0 + F.degrees(eta) / scale


def tan_sky(x: Column, y: Column, ra0: Column, dec0: Column, scale: Column, x0: Column, y0: Column) -> tuple[Column, Column]:
    """The inverse of tan_pixel."""
    xi, eta, d0 = F.radians((x0 - x) * scale), F.radians((y - y0) * scale), F.radians(dec0)
    level = F.cos(d0) - eta * F.sin(d0)
    return modulo(ra0 + F.degrees(F.atan2(xi, level)), 360.0), F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.sqrt(xi * xi + level * level)))


def polynomial(x: Column, y: Column, terms: dict[tuple[int, int], float]) -> Column:
    """Sum of c * x**p * y**q: a plane distortion."""
    total = F.lit(0.0)
    for (p, q), c in sorted(terms.items()):
        total = total + F.lit(float(c)) * F.pow(x, F.lit(float(p))) * F.pow(y, F.lit(float(q)))
    return total


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _newton(u: Column, v: Column, value: Callable[[Column, Column], tuple[Column, ...]], steps: int) -> tuple[Column, Column]:
    """(x, y) at which `value` is (u, v), from (u, v) on by Newton steps until one is below 1e-13 of the place, `steps` at most;
    null where it doesn't get there. value: both functions and their derivatives by x, y and x, y."""

    # A lambda's expressions are computed as often as they are written, so what is used again is a variable.
    def moved(s: Column, w: Column) -> Column:
        det = w["fx"] * w["gy"] - w["fy"] * w["gx"]
        f, g = s["u"] - w["f"], s["v"] - w["g"]
        delta = F.struct(F.try_divide(w["gy"] * f - w["fy"] * g, det).alias("x"), F.try_divide(w["fx"] * g - w["gx"] * f, det).alias("y"))
        return _let(delta, lambda d: F.struct((s["x"] + d["x"]).alias("x"), (s["y"] + d["y"]).alias("y"), F.coalesce(F.abs(d["x"]) + F.abs(d["y"]) <= (F.abs(s["x"]) + F.abs(s["y"]) + 1e-6) * 1e-13, F.lit(False)).alias("done"), s["u"].alias("u"), s["v"].alias("v")))

    def step(s: Column, _: Column) -> Column:
        values = F.struct(*(c.alias(n) for c, n in zip(value(s["x"], s["y"]), ("f", "g", "fx", "fy", "gx", "gy"), strict=True)))
        return F.when(s["done"], s).otherwise(_let(values, lambda w: moved(s, w)))

    place = F.struct(u.cast("double").alias("x"), v.cast("double").alias("y"), F.lit(False).alias("done"), u.cast("double").alias("u"), v.cast("double").alias("v"))
    found = _let(place, lambda start: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: F.when(s["done"], s)))
    return found["x"], found["y"]


def _derived(terms: dict[tuple[int, int], float], by: int) -> dict[tuple[int, int], float]:
    """Terms of the derivative by x (0) or y (1)."""
    return {(p - (by == 0), q - (by == 1)): c * (p, q)[by] for (p, q), c in terms.items() if (p, q)[by]}


def undistorted(u: Column, v: Column, a: dict[tuple[int, int], float], b: dict[tuple[int, int], float], steps: int = 30) -> tuple[Column, Column]:
    """(x, y) with x + A(x, y) = u and y + B(x, y) = v, by Newton steps until they are there; null where they never are."""
    f, g = {**a, (1, 0): a.get((1, 0), 0.0) + 1}, {**b, (0, 1): b.get((0, 1), 0.0) + 1}
    wanted = (f, g, *(_derived(t, by) for t in (f, g) for by in (0, 1)))
    return _newton(u, v, lambda x, y: tuple(polynomial(x, y, t) for t in wanted), steps)


def tpv_terms(most: int = 7) -> list[tuple[int, int, int]]:
    """Powers of xi, eta and the radius in the terms of a TPV distortion, in order: for each degree those of xi and eta by falling
    powers of xi, and after those of an odd degree that of the radius."""
    out = []
    for d in range(most + 1):
        out += [(d - k, k, 0) for k in range(d + 1)] + ([(0, 0, d)] if d % 2 else [])
    return out


def _tpv(xi: Column, eta: Column, pv: dict[int, Column | float]) -> tuple[Column, Column, Column]:
    """The distorted coordinate and its derivatives by xi and eta; pv: coefficients by number, the linear one is 1 if it isn't given."""
    r = F.hypot(xi, eta)
    power = lambda x, n: F.lit(1.0) if n == 0 else x if n == 1 else F.pow(x, F.lit(float(n)))
    table, total, by_xi, by_eta = tpv_terms(), F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for k, c in sorted(({1: 1.0} | pv).items()):
        p, q, d = table[k]
        c = c if isinstance(c, Column) else F.lit(float(c))
        if d:
            total = total + c * power(r, d)
            # r has no direction at the origin, where its derivative counts as 0.
            slope = c * F.lit(float(d)) * (F.coalesce(F.try_divide(F.lit(1.0), r), F.lit(0.0)) if d == 1 else power(r, d - 2))
            by_xi, by_eta = by_xi + slope * xi, by_eta + slope * eta
            continue
        total = total + c * power(xi, p) * power(eta, q)
        by_xi = by_xi + c * float(p) * power(xi, p - 1) * power(eta, q) if p else by_xi
        by_eta = by_eta + c * float(q) * power(xi, p) * power(eta, q - 1) if q else by_eta
    return total, by_xi, by_eta


def tpv_plane(u: Column, v: Column, pv1: dict[int, Column | float], pv2: dict[int, Column | float]) -> tuple[Column, Column]:
    """Distorted plane coordinates (degrees) of linear ones; the second axis has its terms with the coordinates exchanged."""
    return _tpv(u, v, pv1)[0], _tpv(v, u, pv2)[0]


def tpv_linear(xi: Column, eta: Column, pv1: dict[int, Column | float], pv2: dict[int, Column | float], steps: int = 30) -> tuple[Column, Column]:
    """The inverse of tpv_plane; null where there is none to be found."""

    def value(x: Column, y: Column) -> tuple[Column, ...]:
        f, fx, fy = _tpv(x, y, pv1)
        g, gy, gx = _tpv(y, x, pv2)
        return f, g, fx, fy, gx, gy

    return _newton(xi, eta, value, steps)


def tpv_sky(x: Column, y: Column, ra0: Column, dec0: Column, crpix: tuple[Column, Column], cd: tuple[Column, Column, Column, Column], pv1: dict, pv2: dict) -> tuple[Column, Column]:
    """The position of a pixel by a gnomonic projection with a matrix and a TPV distortion."""
    one, zero = F.lit(1.0), F.lit(0.0)
    dx, dy = x - crpix[0], y - crpix[1]
    xi, eta = tpv_plane(cd[0] * dx + cd[1] * dy, cd[2] * dx + cd[3] * dy, pv1, pv2)
    return cd_sky(xi, eta, ra0, dec0, (zero, zero), (one, zero, zero, one))


def tpv_pixel(ra: Column, dec: Column, ra0: Column, dec0: Column, crpix: tuple[Column, Column], cd: tuple[Column, Column, Column, Column], pv1: dict, pv2: dict) -> tuple[Column, Column]:
    """The inverse of tpv_sky; null beyond 90 degrees, for a matrix without an inverse and where the distortion has none."""
    one, zero = F.lit(1.0), F.lit(0.0)
    u, v = tpv_linear(*cd_pixel(ra, dec, ra0, dec0, (zero, zero), (one, zero, zero, one)), pv1, pv2)
    det = cd[0] * cd[3] - cd[1] * cd[2]
    pixel = lambda p: F.struct((crpix[0] + F.try_divide(cd[3] * p["u"] - cd[1] * p["v"], det)).alias("x"), (crpix[1] + F.try_divide(cd[0] * p["v"] - cd[2] * p["u"], det)).alias("y"))
    at = _let(F.struct(u.alias("u"), v.alias("v")), pixel)
    return at["x"], at["y"]


def cd_sky(x: Column, y: Column, ra0: Column, dec0: Column, crpix: tuple[Column, Column], cd: tuple[Column, Column, Column, Column]) -> tuple[Column, Column]:
    """The position of a pixel by a gnomonic projection with a matrix (cd1_1, cd1_2, cd2_1, cd2_2) in degrees a pixel."""
    u, v = x - crpix[0], y - crpix[1]
    xi, eta, d0 = F.radians(cd[0] * u + cd[1] * v), F.radians(cd[2] * u + cd[3] * v), F.radians(dec0)
    level = F.cos(d0) - eta * F.sin(d0)
    return modulo(ra0 + F.degrees(F.atan2(xi, level)), 360.0), F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.sqrt(xi * xi + level * level)))


def cd_pixel(ra: Column, dec: Column, ra0: Column, dec0: Column, crpix: tuple[Column, Column], cd: tuple[Column, Column, Column, Column]) -> tuple[Column, Column]:
    """The inverse of cd_sky; null beyond 90 degrees and for a matrix without an inverse."""
    d, d0, da = F.radians(dec), F.radians(dec0), F.radians(ra - ra0)
    facing = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(da)
    xi = F.degrees(F.when(facing > 0, F.cos(d) * F.sin(da) / facing))
    eta = F.degrees(F.when(facing > 0, (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(da)) / facing))
    det = cd[0] * cd[3] - cd[1] * cd[2]
    return crpix[0] + F.try_divide(cd[3] * xi - cd[1] * eta, det), crpix[1] + F.try_divide(cd[0] * eta - cd[2] * xi, det)
