"""Geometry: pitch offsets, map projection, sun position."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid and the scale of the universal transverse Mercator grid.
AXIS, FLATTENING, SCALE = 6378137.0, 1 / 298.257223563, 0.9996

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger series in the third flattening, orders 1 to 4.
_FORWARD = (
    _N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4,
    13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4,
    61 / 240 * _N**3 - 103 / 140 * _N**4,
    49561 / 161280 * _N**4,
)
_INVERSE = (
    _N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3 - 1 / 360 * _N**4,
    1 / 48 * _N**2 + 1 / 15 * _N**3 - 437 / 1440 * _N**4,
    17 / 480 * _N**3 - 37 / 840 * _N**4,
    4397 / 161280 * _N**4,
)
_LATITUDE = (
    2 * _N - 2 / 3 * _N**2 - 2 * _N**3 + 116 / 45 * _N**4,
    7 / 3 * _N**2 - 8 / 5 * _N**3 - 227 / 45 * _N**4,
    56 / 15 * _N**3 - 136 / 35 * _N**4,
    4279 / 630 * _N**4,
)
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def vertical_offset(x: float | Column, y: float | Column, pitch: Column) -> Column:
    """Height of a sensor at (x, y) metres from the depth sensor when the vehicle pitches (degrees)."""
    theta = F.radians(pitch)
    return x * F.sin(theta) + y * F.cos(theta)


def pitch_corrected_depth(depth: Column, x: float | Column, y: float | Column, pitch: Column) -> Column:
    return depth - vertical_offset(x, y, pitch)


def utm_zone(mean_lon: Column) -> Column:
    return (F.lit(31) + F.floor(mean_lon / 6)).cast("int")


def _central(zone: Column) -> Column:
    return zone * 6 - 183


def utm_forward(lat: Column, lon: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing in metres (northern hemisphere origin)."""
    phi, lam = F.radians(lat), F.radians(lon - _central(zone))
    sine = F.sin(phi)
    t = F.sinh(atanh(sine) - _ECC * atanh(_ECC * sine))
    xi, eta = F.atan2(t, F.cos(lam)), atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_FORWARD, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000.0 + SCALE * _RADIUS * east, SCALE * _RADIUS * north


def utm_inverse(east: Column, north: Column, zone: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees."""
    xi, eta = north / (SCALE * _RADIUS), (east - 500_000.0) / (SCALE * _RADIUS)
    xi0, eta0 = xi, eta
    for j, b in enumerate(_INVERSE, start=1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_LATITUDE, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi), _central(zone) + F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0)))


def sun_altitude(lat: Column, lon: Column, us: Column) -> Column:
    """Altitude of the sun in degrees (low-precision formulas of the Astronomical Almanac)."""
    d = us / 86_400_000_000.0 - 10957.5
    g = F.radians(357.529 + 0.98560028 * d)
    ecliptic = F.radians(280.459 + 0.98564736 * d + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    tilt = F.radians(23.439 - 0.00000036 * d)
    ascension = F.atan2(F.cos(tilt) * F.sin(ecliptic), F.cos(ecliptic))
    sin_dec = F.sin(tilt) * F.sin(ecliptic)
    hour = F.radians((18.697374558 + 24.06570982441908 * d) * 15 + lon) - ascension
    phi = F.radians(lat)
    return F.degrees(F.asin(F.sin(phi) * sin_dec + F.cos(phi) * F.sqrt(1 - sin_dec * sin_dec) * F.cos(hour)))
