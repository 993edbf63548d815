"""The Israeli grid (EPSG:2039) as latitude and longitude, by the inverse transverse Mercator series; JVM expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grid's origin, scale and offsets, the ellipsoid, and the shift to the world datum in metres.
LAT0, LON0, SCALE, X0, Y0 = 31.7343936111111, 35.2045169444444, 1.0000067, 219529.584, 626907.39
A, FLATTENING = 6378137.0, 1 / 298.257222101
SHIFT = (-48.0, 55.0, 52.0)


def _meridian(phi, e2: float, sin=math.sin):
    """Length of the meridian from the equator."""
    return A * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * sin(2 * phi) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * sin(4 * phi) - (35 * e2**3 / 3072) * sin(6 * phi))


def grid_to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of grid metres, to a few metres."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    m = F.lit(_meridian(math.radians(LAT0), e2)) + (y - Y0) / SCALE
    mu = m / (A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu)
    c, t = ep2 * F.pow(F.cos(p), 2), F.pow(F.tan(p), 2)
    w = 1 - e2 * F.pow(F.sin(p), 2)
    n, r = A / F.sqrt(w), A * (1 - e2) / F.pow(w, 1.5)
    d = (x - X0) / (n * SCALE)
    lat = p - (n * F.tan(p) / r) * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t) * F.pow(d, 6) / 720)
    lon = F.lit(math.radians(LON0)) + (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, 5) / 120) / F.cos(p)
    return _shifted(lat, lon)


def _shifted(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Degrees on the world datum of radians on the grid's, by the shift of the earth's centre."""
    e2 = FLATTENING * (2 - FLATTENING)
    n = A / F.sqrt(1 - e2 * F.pow(F.sin(lat), 2))
    x = n * F.cos(lat) * F.cos(lon) + SHIFT[0]
    y = n * F.cos(lat) * F.sin(lon) + SHIFT[1]
    z = n * (1 - e2) * F.sin(lat) + SHIFT[2]
    b = A * (1 - FLATTENING)
    flat = F.sqrt(x * x + y * y)
    theta = F.atan2(z * A, flat * b)
    out = F.atan2(z + e2 / (1 - e2) * b * F.pow(F.sin(theta), 3), flat - e2 * A * F.pow(F.cos(theta), 3))
    return F.degrees(out), F.degrees(F.atan2(y, x))
