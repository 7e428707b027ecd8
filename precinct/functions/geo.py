"""Distances, map projections and WKT as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Sphere radius for distances (km), Web Mercator radius (m).
EARTH_KM = 6371.0
MERCATOR_M = 6378137.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    dlat, dlng = F.radians(lat2) - F.radians(lat1), F.radians(lng2) - F.radians(lng1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def usable_coordinates(lat: Column, lng: Column) -> Column:
    """Present, not NaN and not the zero that stands for 'missing'."""
    known = lambda c: c.isNotNull() & ~F.isnan(c) & (c != 0)
    return known(lat) & known(lng)


def to_mercator(lng: Column, lat: Column) -> tuple[Column, Column]:
    x = F.radians(lng) * F.lit(MERCATOR_M)
    y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(MERCATOR_M)
    return x, y


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    lng = F.degrees(x / F.lit(MERCATOR_M))
    lat = F.degrees(F.atan(F.exp(y / F.lit(MERCATOR_M))) * 2 - F.lit(math.pi / 2))
    return lng, lat


class TransverseMercator:
    """Inverse and forward transverse Mercator by the Krueger series in n.

    Coefficients follow the published sixth-order expansions cut at n^4, which
    is far below a millimetre inside a projection zone.
    """

    def __init__(self, a, inv_f, lng0, k0, false_east, false_north):
        n = 1 / (2 * inv_f - 1)
        self.n, self.lng0, self.false_east, self.false_north = n, lng0, false_east, false_north
        self.scale = k0 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        self.ecc = math.sqrt((2 - 1 / inv_f) / inv_f)
        self.beta = (
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        )
        self.delta = (
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
            7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35,
            4279 * n**4 / 630,
        )

    def to_lnglat(self, east: Column, north: Column) -> tuple[Column, Column]:
        xi = (north - F.lit(self.false_north)) / F.lit(self.scale)
        eta = (east - F.lit(self.false_east)) / F.lit(self.scale)
        xi0, eta0 = xi, eta
        for k, b in enumerate(self.beta, start=1):
            xi0 = xi0 - F.lit(b) * F.sin(xi * (2.0 * k)) * F.cosh(eta * (2.0 * k))
            eta0 = eta0 - F.lit(b) * F.cos(xi * (2.0 * k)) * F.sinh(eta * (2.0 * k))
        conformal = F.asin(F.sin(xi0) / F.cosh(eta0))
        lat = conformal
        for k, d in enumerate(self.delta, start=1):
            lat = lat + F.lit(d) * F.sin(conformal * (2.0 * k))
        lng = F.lit(self.lng0) + F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0)))
        return lng, F.degrees(lat)


# GRS80 ellipsoid, central meridian 173, scale 0.9996, false origin (EPSG:2193).
NZTM2000 = TransverseMercator(6378137.0, 298.257222101, 173.0, 0.9996, 1600000.0, 10000000.0)


def to_wgs84(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """Projected coordinates -> (lng, lat). Knows 4326, 3857 and 2193."""
    if epsg == 4326:
        return x, y
    if epsg == 3857:
        return from_mercator(x, y)
    if epsg == 2193:
        return NZTM2000.to_lnglat(x, y)
    raise ValueError(f"unsupported coordinate system EPSG:{epsg}")


def number_text(c: Column) -> Column:
    """Shortest decimal text without a trailing ``.0``."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def wkt_point(x: Column, y: Column) -> Column:
    return F.concat_ws(" ", number_text(x), number_text(y))


def _ring_text(ring: Column) -> Column:
    points = F.transform(ring, lambda p: wkt_point(p[0], p[1]))
    return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))


def _polygon_text(rings: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(rings, _ring_text), ", "), F.lit(")"))


def multipolygon_wkt(parts: Column, is_multi: Column) -> Column:
    """Nested coordinate arrays (part -> ring -> point -> [x, y]) -> WKT."""
    bodies = F.transform(parts, _polygon_text)
    return F.when(
        is_multi, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(bodies, ", "), F.lit(")"))
    ).otherwise(F.concat(F.lit("POLYGON "), bodies[0]))
