"""Affine and Mercator coordinates, and lengths on an ellipsoid, as column expressions (FN13-16, GR2)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0
#: Fixed value: the flattening of WGS 84.
FLATTENING = 1 / 298.257223563
#: Rounds of Vincenty's iteration (lines that are not nearly antipodal need a few), the change at which it ends, and halvings of an azimuth.
ROUNDS, CLOSE, HALVINGS = 20, 1e-13, 60


def affine_of_bounds(left: Column, bottom: Column, right: Column, top: Column, width: Column, height: Column) -> Column:
    """The transform a..f that maps pixel corners onto a box."""
    zero = F.lit(0.0)
    parts = {"a": (right - left) / width, "b": zero, "c": left, "d": zero, "e": -(top - bottom) / height, "f": top}
    return F.struct(*[v.cast("double").alias(k) for k, v in parts.items()])


def pixel_centre(t: Column, x: Column, y: Column) -> Column:
    """Map coordinates of the centre of pixel (x, y)."""
    u, v = x + 0.5, y + 0.5
    return F.struct((t["c"] + t["a"] * u + t["b"] * v).alias("x"), (t["f"] + t["d"] * u + t["e"] * v).alias("y"))


def to_mercator(lon: Column, lat: Column) -> Column:
    return F.struct((F.radians(lon) * RADIUS).alias("x"), (F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * RADIUS).alias("y"))


def from_mercator(x: Column, y: Column) -> Column:
    return F.struct(F.degrees(x / RADIUS).alias("lon"), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2).alias("lat"))


def bounds(x: Column, y: Column) -> list[Column]:
    """Aggregates of the box around points."""
    return [F.min(x).alias("left"), F.min(y).alias("bottom"), F.max(x).alias("right"), F.max(y).alias("top")]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _named(**parts: Column) -> Column:
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def _lag(sin_a: Column, cos2_a: Column, s: Column, sin_s: Column, cos_s: Column, cos_2m: Column, f: float) -> Column:
    """By how much the longitude on the auxiliary sphere exceeds that on the ellipsoid (Vincenty, 1975, equations 10 and 11)."""
    return _let(f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a)), lambda c: (1 - c) * f * sin_a * (s + c * sin_s * (cos_2m + c * cos_s * (2 * cos_2m * cos_2m - 1))))


def _arc(p: Column, lam: Column) -> Column:
    """The great circle on the auxiliary sphere between reduced latitudes p whose longitudes differ by lam."""
    cross = lambda q: F.hypot(p["c2"] * F.sin(q), p["c1"] * p["s2"] - p["s1"] * p["c2"] * F.cos(q))
    ends = _named(sin_s=cross(lam), cos_s=p["s1"] * p["s2"] + p["c1"] * p["c2"] * F.cos(lam))
    turned = lambda e: _named(sin_s=e["sin_s"], cos_s=e["cos_s"], s=F.atan2(e["sin_s"], e["cos_s"]), sin_a=F.when(e["sin_s"] > 0, p["c1"] * p["c2"] * F.sin(lam) / e["sin_s"]).otherwise(0.0))
    squared = lambda t: _let(1 - t["sin_a"] * t["sin_a"], lambda q: _named(sin_a=t["sin_a"], cos2_a=q, s=t["s"], sin_s=t["sin_s"], cos_s=t["cos_s"], cos_2m=F.when(q > 0, t["cos_s"] - 2 * p["s1"] * p["s2"] / q).otherwise(0.0)))
    return _let(_let(ends, turned), squared)


def _leaving(p: Column, alpha: Column) -> Column:
    """The great circle that leaves the end farther from the equator, put south of it, at an azimuth; lam: the longitude at which it meets the other's latitude."""
    sin_0, north = F.sin(alpha) * p["c1"], F.cos(alpha) * p["c1"]
    far = F.sqrt(F.greatest(north * north + (p["c2"] - p["c1"]) * (p["c2"] + p["c1"]), F.lit(0.0)))  # cos(azimuth there) cos(latitude there)
    ends = lambda e: _named(s1=F.atan2(p["s1"], e["north"]), s2=F.atan2(p["s2"], e["far"]), lam=F.atan2(e["sin_0"] * p["s2"], e["far"]) - F.atan2(e["sin_0"] * p["s1"], e["north"]), sin_a=e["sin_0"])
    whole = lambda t: _let(t["s2"] - t["s1"], lambda s: _named(sin_a=t["sin_a"], cos2_a=1 - t["sin_a"] * t["sin_a"], s=s, sin_s=F.sin(s), cos_s=F.cos(s), cos_2m=F.cos(t["s1"] + t["s2"]), lam=t["lam"]))
    return _let(_let(_named(sin_0=sin_0, north=north, far=far), ends), whole)


def _along(g: Column, a: float, f: float) -> Column:
    """The length of an arc on the ellipsoid (Vincenty, 1975, equations 3, 4 and 6, with Helmert's parameter)."""
    b = a * (1 - f)
    root = F.sqrt(1 + g["cos2_a"] * ((a * a - b * b) / (b * b)))
    steps = lambda k: _named(a=(1 + k * k / 4) / (1 - k), b=k * (1 - 3 * k * k / 8))
    less = lambda m, q: m["b"] * g["sin_s"] * (q + m["b"] / 4 * (g["cos_s"] * (2 * q * q - 1) - m["b"] / 6 * q * (4 * g["sin_s"] * g["sin_s"] - 3) * (4 * q * q - 3)))
    return _let(_let(_let(root, lambda r: (r - 1) / (r + 1)), steps), lambda m: b * m["a"] * (g["s"] - less(m, g["cos_2m"])))


def geodesic(lon1: Column, lat1: Column, lon2: Column, lat2: Column, a: float = RADIUS, f: float = FLATTENING) -> Column:
    """Metres along the shortest line on an ellipsoid between two points in degrees.

    Vincenty's iteration, a few rounds for most lines. Where it does not come to rest, between nearly antipodal points,
    the azimuth at the start is halved instead, as longitude grows with it from 0 to half a turn; so every line
    has a length, that between antipodal points along a meridian. Longitudes may be any number of turns apart. A null, a
    value that is not finite or a latitude beyond 90 degrees gives null.
    """
    args = [c.cast("double") for c in (lon1, lat1, lon2, lat2)]
    turn = F.abs(F.radians(args[2] - args[0])) % (2 * math.pi)
    reduced = lambda lat: F.atan((1 - f) * F.tan(F.radians(lat)))
    given = _named(u1=reduced(args[1]), u2=reduced(args[3]), far=F.least(turn, 2 * math.pi - turn))
    start = lambda g: _named(s1=F.sin(g["u1"]), c1=F.cos(g["u1"]), s2=F.sin(g["u2"]), c2=F.cos(g["u2"]), far=g["far"])

    def length(p: Column) -> Column:
        after = lambda g: p["far"] + _lag(g["sin_a"], g["cos2_a"], g["s"], g["sin_s"], g["cos_s"], g["cos_2m"], f)
        state = lambda lam, rest, lost: _named(lam=lam, rest=rest, lost=lost)
        step = lambda t, _: F.when(t["rest"] | t["lost"], t).otherwise(_let(_let(_arc(p, t["lam"]), after), lambda lam: state(lam, F.abs(lam - t["lam"]) < CLOSE, lam > math.pi)))
        steps = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(p["far"], F.lit(False), F.lit(False)), step)
        return _let(steps, lambda t: F.when(t["rest"] & ~t["lost"], _let(_arc(p, t["lam"]), lambda g: _along(g, a, f))).otherwise(_let(_turned(p), halved)))

    def _turned(p: Column) -> Column:
        """The end farther from the equator first, and south of it; a line between the same latitudes mirrored has the same length."""
        swap = F.abs(p["s1"]) < F.abs(p["s2"])
        pick = lambda x, y: F.when(swap, p[y]).otherwise(p[x])
        side = F.when(pick("s1", "s2") > 0, -1.0).otherwise(1.0)
        return _named(s1=F.least(side * pick("s1", "s2"), F.lit(-1e-300)), c1=pick("c1", "c2"), s2=side * pick("s2", "s1"), c2=pick("c2", "c1"), far=p["far"])

    def halved(p: Column) -> Column:
        reached = lambda g: g["lam"] - _lag(g["sin_a"], g["cos2_a"], g["s"], g["sin_s"], g["cos_s"], g["cos_2m"], f)
        short = lambda mid: _let(_leaving(p, mid), reached) < p["far"]
        narrow = lambda t, _: _let((t["low"] + t["high"]) / 2, lambda mid: F.when(short(mid), _named(low=mid, high=t["high"])).otherwise(_named(low=t["low"], high=mid)))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), _named(low=F.lit(0.0), high=F.lit(math.pi)), narrow)
        return _let(_let(found, lambda t: _leaving(p, (t["low"] + t["high"]) / 2)), lambda g: _along(g, a, f))

    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    sound = finite(args[0]) & finite(args[1]) & finite(args[2]) & finite(args[3]) & (F.abs(args[1]) <= 90) & (F.abs(args[3]) <= 90)
    return F.when(sound, _let(_let(given, start), length))
