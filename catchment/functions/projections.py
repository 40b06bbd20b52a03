"""Map projections in closed form (Snyder 1987), as column expressions.

All take and return a pair of columns; angles are degrees, lengths metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The GRS80 ellipsoid, the conterminous-US Albers parameters, the sinusoidal sphere.
A, INV_F = 6378137.0, 298.257222101
ALBERS = {"lat1": 29.5, "lat2": 45.5, "lat0": 23.0, "lon0": -96.0}
SPHERE = 6371007.181

_E2 = (2 - 1 / INV_F) / INV_F
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _m(lat: float) -> float:
    r = math.radians(lat)
    return math.cos(r) / math.sqrt(1 - _E2 * math.sin(r) ** 2)


def _albers(p: dict[str, float]) -> tuple[float, float, float]:
    q1, q2, q0 = (_q(math.sin(math.radians(p[k]))) for k in ("lat1", "lat2", "lat0"))
    n = (_m(p["lat1"]) ** 2 - _m(p["lat2"]) ** 2) / (q2 - q1)
    c = _m(p["lat1"]) ** 2 + n * q1
    return n, c, A * math.sqrt(c - n * q0) / n


def to_albers(lon: Column, lat: Column, p: dict[str, float] = ALBERS) -> tuple[Column, Column]:
    n, c, rho0 = _albers(p)
    s = F.sin(F.radians(lat))
    q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    rho = A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - p["lon0"])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def from_albers(x: Column, y: Column, p: dict[str, float] = ALBERS) -> tuple[Column, Column]:
    n, c, rho0 = _albers(p)
    rho2 = x * x + (rho0 - y) * (rho0 - y)
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (c - rho2 * n * n / (A * A)) / n / _q(1.0))))
    e4, e6 = _E2**2, _E2**3
    lat = beta + (_E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    return p["lon0"] + F.degrees(F.atan2(x, rho0 - y)) / n, F.degrees(lat)


def to_sinusoidal(lon: Column, lat: Column, radius: float = SPHERE) -> tuple[Column, Column]:
    return radius * F.radians(lon) * F.cos(F.radians(lat)), radius * F.radians(lat)


def from_sinusoidal(x: Column, y: Column, radius: float = SPHERE) -> tuple[Column, Column]:
    lat = y / radius
    return F.degrees(x / (radius * F.cos(lat))), F.degrees(lat)


def to_lambert(lon: Column, lat: Column, lat1: float, lat2: float, lat0: float, lon0: float, x0: float = 0.0, y0: float = 0.0) -> tuple[Column, Column]:
    """Lambert conformal conic from a grid's mapping attributes."""
    t = lambda r: math.tan(math.pi / 4 - r / 2) / ((1 - _E * math.sin(r)) / (1 + _E * math.sin(r))) ** (_E / 2)
    r1, r2, r0 = math.radians(lat1), math.radians(lat2), math.radians(lat0)
    n = math.sin(r1) if lat1 == lat2 else math.log(_m(lat1) / _m(lat2)) / math.log(t(r1) / t(r2))
    f = _m(lat1) / (n * t(r1) ** n)
    rho0 = A * f * t(r0) ** n
    r = F.radians(lat)
    s = F.sin(r)
    rho = A * f * F.pow(F.tan(math.pi / 4 - r / 2) / F.pow((1 - _E * s) / (1 + _E * s), F.lit(_E / 2)), F.lit(n))
    theta = n * F.radians(lon - lon0)
    return x0 + rho * F.sin(theta), y0 + rho0 - rho * F.cos(theta)


def _half_angle(s: Column) -> Column:
    """Snyder's t from the sine of a latitude, without its tangent's pole."""
    return F.sqrt((1 - s) / (1 + s) * F.pow((1 + _E * s) / (1 - _E * s), F.lit(_E)))


def _cone(lat1: Column, lat2: Column, lat0: Column) -> tuple[Column, Column, Column]:
    """Exponent, scale and the origin's radius of a Lambert cone whose parallels may differ from row to row."""
    s1, s2, s0 = (F.sin(F.radians(x)) for x in (lat1, lat2, lat0))
    m1, m2 = (F.cos(F.radians(x)) / F.sqrt(1 - _E2 * s * s) for x, s in ((lat1, s1), (lat2, s2)))
    n = F.when(lat1 == lat2, s1).otherwise(F.log(m1 / m2) / F.log(_half_angle(s1) / _half_angle(s2)))
    f = m1 / (n * F.pow(_half_angle(s1), n))
    return n, f, A * f * F.pow(_half_angle(s0), n)


def _from_conformal(chi: Column) -> Column:
    """Latitude from the conformal one, in radians."""
    e4, e6, e8 = _E2**2, _E2**3, _E2**4
    terms = (_E2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520, 7 * e6 / 120 + 81 * e8 / 1120, 4279 * e8 / 161280)
    lat = chi
    for k, term in enumerate(terms, 1):
        lat = lat + term * F.sin(2 * k * chi)
    return lat


def from_lambert(x: Column, y: Column, lat1, lat2, lat0, lon0, x0=0.0, y0=0.0) -> tuple[Column, Column]:
    """The inverse of ``to_lambert``; parameters are numbers or columns.

    The latitude comes from the conformal one by a series of four terms, good to 1e-10 degrees.
    """
    lat1, lat2, lat0, lon0, x0, y0 = (p if isinstance(p, Column) else F.lit(float(p)) for p in (lat1, lat2, lat0, lon0, x0, y0))
    n, f, rho0 = _cone(lat1, lat2, lat0)
    u, v = x - x0, rho0 - (y - y0)
    sign = F.signum(n)
    rho = sign * F.sqrt(u * u + v * v)
    chi = math.pi / 2 - 2 * F.atan(F.pow(rho / (A * f), 1 / n))
    return lon0 + F.degrees(F.atan2(sign * u, sign * v) / n), F.degrees(_from_conformal(chi))


def to_lambert_by(lon: Column, lat: Column, lat1, lat2, lat0, lon0, x0=0.0, y0=0.0) -> tuple[Column, Column]:
    """``to_lambert`` with parameters that are numbers or columns."""
    lat1, lat2, lat0, lon0, x0, y0 = (p if isinstance(p, Column) else F.lit(float(p)) for p in (lat1, lat2, lat0, lon0, x0, y0))
    n, f, rho0 = _cone(lat1, lat2, lat0)
    rho, theta = A * f * F.pow(_half_angle(F.sin(F.radians(lat))), n), n * F.radians(lon - lon0)
    return x0 + rho * F.sin(theta), y0 + rho0 - rho * F.cos(theta)


def _odd(name: Column) -> Column:
    return F.raise_error(F.concat(F.lit("unknown grid mapping: "), F.coalesce(name, F.lit("none")))).cast("double")


def geographic(x: Column, y: Column, mapping: Column) -> tuple[Column, Column]:
    """Longitude and latitude of points given in the system that a grid-mapping struct names.

    ``mapping`` has grid_mapping_name, standard_parallel (one or two numbers),
    latitude_of_projection_origin, longitude_of_central_meridian, false_easting and
    false_northing; regions with different attributes may stand in one table. A system that is
    not known raises.
    """
    name = mapping["grid_mapping_name"]
    parallels = mapping["standard_parallel"]
    or_zero = lambda c: F.coalesce(mapping[c], F.lit(0.0))
    cone = from_lambert(x, y, parallels[0], F.coalesce(F.get(parallels, F.lit(1)), parallels[0]), mapping["latitude_of_projection_origin"], mapping["longitude_of_central_meridian"], or_zero("false_easting"), or_zero("false_northing"))
    flat = from_sinusoidal(x, y)
    return tuple(F.when(name == "lambert_conformal_conic", cone[k]).when(name == "sinusoidal", flat[k]).when(name == "latitude_longitude", (x, y)[k]).otherwise(_odd(name)) for k in (0, 1))


def step_by_step(points: Column, *steps) -> Column:
    """An array of points (x, y) through ``steps`` of (a, b) -> (a, b), one after another.

    Each step is computed once for a point; composed as plain expressions, a formula that uses
    its argument several times would repeat all that stands before it.
    """
    def run(step):
        def one(p: Column) -> Column:
            a, b = step(p["x"], p["y"])
            return F.struct(a.alias("x"), b.alias("y"))

        return one

    for step in steps:
        points = F.transform(points, run(step))
    return points


def geographic_steps(mapping: Column) -> tuple:
    """``geographic`` in two steps: to the conformal latitude, and from there."""
    name, parallels = mapping["grid_mapping_name"], mapping["standard_parallel"]
    conic = name == "lambert_conformal_conic"

    def cone(x: Column, y: Column) -> tuple[Column, Column]:
        n, f, rho0 = _cone(parallels[0], F.coalesce(F.get(parallels, F.lit(1)), parallels[0]), mapping["latitude_of_projection_origin"])
        u, v = x - F.coalesce(mapping["false_easting"], F.lit(0.0)), rho0 - (y - F.coalesce(mapping["false_northing"], F.lit(0.0)))
        chi = math.pi / 2 - 2 * F.atan(F.pow(F.signum(n) * F.sqrt(u * u + v * v) / (A * f), 1 / n))
        lon, lat = (F.when(name == "sinusoidal", flat).when(name == "latitude_longitude", plain).otherwise(_odd(name)) for flat, plain in zip(from_sinusoidal(x, y), (x, y), strict=True))
        return F.when(conic, mapping["longitude_of_central_meridian"] + F.degrees(F.atan2(F.signum(n) * u, F.signum(n) * v) / n)).otherwise(lon), F.when(conic, chi).otherwise(lat)

    return cone, lambda lon, lat: (lon, F.when(conic, F.degrees(_from_conformal(lat))).otherwise(lat))


def albers_steps(p: dict[str, float] = ALBERS) -> tuple:
    """``to_albers`` in two steps: to the authalic quantity, and from there."""
    n, c, rho0 = _albers(p)

    def authalic(lon: Column, s: Column) -> tuple[Column, Column]:
        return lon, A * F.sqrt(c - n * (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))) / n

    def plane(lon: Column, rho: Column) -> tuple[Column, Column]:
        theta = n * F.radians(lon - p["lon0"])
        return rho * F.sin(theta), rho0 - rho * F.cos(theta)

    return lambda lon, lat: (lon, F.sin(F.radians(lat))), authalic, plane
