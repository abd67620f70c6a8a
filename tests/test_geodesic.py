"""Lengths on an ellipsoid against published lines and series of another kind."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.functions import geo

BESSEL, INTERNATIONAL, WGS84 = (6377397.155, 1 / 299.1528128), (6378388.0, 1 / 297), (geo.RADIUS, geo.FLATTENING)


def dms(d, m, s=0.0):
    return math.copysign(abs(d) + m / 60 + s / 3600, d)


#: The lines of Vincenty (1975), two of Karney (2013) and its library's example; ellipsoid, latitudes, difference in longitude, metres.
LINES = [
    (BESSEL, dms(55, 45), dms(-33, 26), dms(108, 13), 14110526.170),
    (INTERNATIONAL, dms(37, 19, 54.95367), dms(26, 7, 42.83946), dms(41, 28, 35.50729), 4085966.703),
    (INTERNATIONAL, dms(35, 16, 11.24862), dms(67, 22, 14.77638), dms(137, 47, 28.31435), 8084823.839),
    (INTERNATIONAL, 1.0, -dms(0, 59, 53.83076), dms(179, 17, 48.02997), 19960000.000),
    (INTERNATIONAL, 1.0, dms(1, 1, 15.18952), dms(179, 46, 17.84244), 19780006.558),
    (WGS84, -30.0, 29.9, 179.8, 19989832.82761),
    (WGS84, 40.0, 41.79331020506, 137.84490004377, 10000000.0),
]


def lengths(spark, rows, a=geo.RADIUS, f=geo.FLATTENING):
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "k int, lon1 double, lat1 double, lon2 double, lat2 double")
    out = df.select("k", geo.geodesic(*[F.col(c) for c in ("lon1", "lat1", "lon2", "lat2")], a=a, f=f).alias("d")).orderBy("k")
    return [r["d"] for r in out.collect()]


@pytest.mark.parametrize("line", LINES)
def test_published_lines(spark, line):
    """To the millimetre, either way round and mirrored."""
    (a, f), lat1, lat2, far, want = line
    rows = [(0, lat1, far, lat2), (far, lat2, 0, lat1), (10, -lat1, 10 - far, -lat2), (360, lat1, far - 720, lat2)]
    assert lengths(spark, rows, a, f) == pytest.approx([want] * 4, abs=1e-3)


def quarter(a, f):
    """A quarter of a meridian, by Simpson's rule over its curvature."""
    e2, x = f * (2 - f), np.linspace(0, math.pi / 2, 2001)
    y = a * (1 - e2) / (1 - e2 * np.sin(x) ** 2) ** 1.5
    return (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) * (x[1] - x[0]) / 3


def test_antipodes_poles_and_equator(spark):
    half = 2 * quarter(geo.RADIUS, geo.FLATTENING)
    antipodes = [(0, 0, 180, 0), (0, 35, 180, -35), (25, -60, -155, 60), (7, 90, 99, -90)]
    assert lengths(spark, antipodes) == pytest.approx([half] * 4, abs=1e-3)
    assert lengths(spark, [(0, 90, 5, 0), (3, -90, 100, 0)]) == pytest.approx([half / 2] * 2, abs=1e-3)
    # the equator is the shortest line until its ends are (1 - f) half turns apart
    assert lengths(spark, [(0, 0, 179, 0), (-3, 0, 4, 0)]) == pytest.approx([geo.RADIUS * math.radians(179), geo.RADIUS * math.radians(7)], abs=1e-3)
    beyond = lengths(spark, [(0, 0, x, 0) for x in (179.3, 179.5, 179.8, 179.99, 180)])
    assert beyond == sorted(beyond) and beyond[0] > geo.RADIUS * math.radians(179) and beyond[-1] == pytest.approx(half, abs=1e-3)
    assert all(d < geo.RADIUS * math.radians(x) for d, x in zip(beyond[1:], (179.5, 179.8, 179.99, 180)))


def test_spheres_triangles_and_near_antipodes(spark):
    """On a sphere the great circle; anywhere lengths are symmetric, grow evenly to the antipode and keep the triangle's rule."""
    rng = np.random.default_rng(3)
    pts = np.c_[rng.uniform(-180, 180, 300), np.degrees(np.arcsin(rng.uniform(-1, 1, 300)))]
    rows = [(*p, *q) for p, q in zip(pts, pts[::-1])]
    unit = lambda p: np.array([math.cos(math.radians(p[1])) * math.cos(math.radians(p[0])), math.cos(math.radians(p[1])) * math.sin(math.radians(p[0])), math.sin(math.radians(p[1]))])
    arcs = [math.atan2(np.linalg.norm(np.cross(unit(p), unit(q))), unit(p) @ unit(q)) for p, q in zip(pts, pts[::-1])]
    assert lengths(spark, rows, 6371000.0, 0.0) == pytest.approx([6371000.0 * a for a in arcs], abs=1e-3)
    assert lengths(spark, rows) == pytest.approx([6371008.8 * a for a in arcs], rel=6e-3)
    far = [(0, lat, 180 + dx, -lat + dy) for lat in (0, 1, 30, 89) for dx in np.linspace(-0.7, 0.7, 15) for dy in (-0.4, -1e-9, 0, 0.3)]
    there, back, past = lengths(spark, far), lengths(spark, [(r[2], r[3], r[0], r[1]) for r in far]), lengths(spark, [(r[0], r[1], r[2], r[3] + (0.001 if r[3] < 89.9 else -0.001)) for r in far])
    assert there == pytest.approx(back, abs=1e-5)
    assert all(abs(x - y) < 112 for x, y in zip(there, past)) and max(there) <= 2 * quarter(geo.RADIUS, geo.FLATTENING) + 1e-3


def test_odd_values(spark):
    rows = spark.sql("select * from values (1, 0D, 0D, 0D, 0D), (2, 0D, 91D, 0D, 0D), (3, null, 0D, 0D, 0D), (4, double('NaN'), 0D, 0D, 0D), (5, 0D, 0D, double('infinity'), 0D), (6, 1D, 2D, 361D, 2D) t(k, a, b, c, d)")
    got = {r[0]: r[1] for r in rows.select("k", geo.geodesic(*map(F.col, "abcd"))).collect()}
    assert got == {1: 0.0, 2: None, 3: None, 4: None, 5: None, 6: pytest.approx(0.0, abs=1e-6)}
