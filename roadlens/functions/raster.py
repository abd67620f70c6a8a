"""Rasters as row-major arrays, worked on by column expressions (RAS1, RAS5-9, RAS13, RAS16, RAS21, RAS26-27).

A raster of width w holds pixel (y, x) at index y * w + x. Nothing here shuffles: a raster stays in its row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold(data: Column, over: float, on: int = 255) -> Column:
    return F.transform(data, lambda v: F.when(v > over, on).otherwise(0))


def any_channel(channels: list[Column], over: float) -> Column:
    """A pixel is set if any of its channels is."""
    merged = F.arrays_zip(*[c.alias(f"c{i}") for i, c in enumerate(channels)])
    return F.transform(merged, lambda p: F.when(F.greatest(*[p[f"c{i}"] for i in range(len(channels))]) > over, 255).otherwise(0))


def positives(data: Column) -> Column:
    return F.size(F.filter(data, lambda v: v > 0)).cast("long")


def total(data: Column) -> Column:
    return F.aggregate(data, F.lit(0.0), lambda a, v: a + v)


def mean(data: Column) -> Column:
    return F.when(F.size(data) > 0, total(data) / F.size(data))


def spread(data: Column) -> Column:
    """Population standard deviation."""
    m = F.struct(mean(data).alias("m"), data.alias("d"))
    return F.element_at(F.transform(F.array(m), lambda s: F.sqrt(mean(F.transform(s["d"], lambda v: (v - s["m"]) * (v - s["m"]))))), 1)


def padded_size(dim: Column, tile: int, stride: int) -> Column:
    """The least size that whole windows cover: the tile, or the tile and a number of strides."""
    return F.when(dim <= tile, F.lit(tile)).otherwise(tile + F.ceil((dim - tile) / stride) * stride).cast("long")


def window_count(padded: Column, tile: int, stride: int) -> Column:
    return (F.floor((padded - tile) / stride) + 1).cast("long")


def reflected(i: Column, n: Column) -> Column:
    """The index below n that a reflecting border shows at index i (the edge itself is not repeated)."""
    period = F.greatest(2 * (n - 1), F.lit(1))
    return F.when(n <= 1, 0).otherwise(n - 1 - F.abs(F.pmod(i, period) - (n - 1)))


def indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def picked(data: Column, w: int, ys: Column, xs: Column) -> Column:
    """The raster made of the given rows and columns of another."""
    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: F.element_at(data, (y * w + x + 1).cast("int")))))


def padded(data: Column, h: int, w: int, to_h: int, to_w: int) -> Column:
    """Reflected right and below."""
    line = lambda n, to: F.transform(indices(F.lit(to)), lambda i: reflected(i, F.lit(n)))
    return picked(data, w, line(h, to_h), line(w, to_w))


def window(data: Column, w: int, y: Column, x: Column, tile: int) -> Column:
    """A square cut out of a raster."""
    return F.flatten(F.transform(indices(F.lit(tile)), lambda d: F.slice(data, ((y + d) * w + x + 1).cast("int"), F.lit(tile))))


def flipped_across(data: Column, h: int, w: int) -> Column:
    return picked(data, w, indices(F.lit(h)), F.reverse(indices(F.lit(w))))


def flipped_down(data: Column, h: int, w: int) -> Column:
    return picked(data, w, F.reverse(indices(F.lit(h))), indices(F.lit(w)))


def turned(data: Column, h: int, w: int) -> Column:
    """Rotated by 90 degrees counter-clockwise: w rows of h."""
    return F.flatten(F.transform(F.reverse(indices(F.lit(w))), lambda x: F.transform(indices(F.lit(h)), lambda y: F.element_at(data, (y * w + x + 1).cast("int")))))


def adjusted(data: Column, contrast: float, brightness: float) -> Column:
    return F.transform(data, lambda v: F.least(F.greatest(v * (1.0 + contrast) + brightness, F.lit(0.0)), F.lit(1.0)))


def blended(data: Column, mask: Column, colour: float, alpha: float) -> Column:
    """Mixed with a colour where the mask is set."""
    return F.zip_with(data, mask, lambda v, m: F.when(m > 0, v * (1.0 - alpha) + alpha * colour).otherwise(v))


def stretched(v: Column, low: Column, high: Column) -> Column:
    """A value on the scale 0 to 255 between two percentiles, truncated; a flat band is 0."""
    scaled = (F.least(F.greatest(v, low), high) - low) / (high - low) * 255.0
    return F.when(high > low, F.floor(scaled)).otherwise(0).cast("long")


def gaussian_blob(h: int, w: int, cx: Column, cy: Column, radius: Column) -> Column:
    """A bump of height 1 with a standard deviation of half the radius."""
    s = radius / 2.0
    bump = lambda y, x: F.exp(-((x - cx) * (x - cx) + (y - cy) * (y - cy)) / (2.0 * s * s))
    return F.flatten(F.transform(indices(F.lit(h)), lambda y: F.transform(indices(F.lit(w)), lambda x: bump(y, x))))


def shadow_polygon(x: Column, y: Column, width: Column, height: Column, angle: Column, length: Column) -> Column:
    """Corners of a building, then those of its shadow backwards; the shift is cut to whole pixels."""
    dx, dy = (length * F.cos(F.radians(angle))).cast("int"), (length * F.sin(F.radians(angle))).cast("int")
    corners = [(x, y), (x + width, y), (x + width, y + height), (x, y + height)]
    points = corners + [(a + dx, b + dy) for a, b in reversed(corners)]
    return F.array(*[F.struct(a.cast("long").alias("x"), b.cast("long").alias("y")) for a, b in points])


def placeholder(h: int, w: int, grey: bool = False) -> Column:
    """A dark raster for what is missing: 40 for each pixel in grey, 30 for each of three channels else."""
    return F.array_repeat(F.lit(40 if grey else 30), h * w * (1 if grey else 3))


def rgb(data: Column, channels: int) -> Column:
    """Three channels of bytes for each pixel of a raster of any whole numbers: grey is repeated, channels after the third go, values wrap around at 256."""
    byte = F.transform(data, lambda v: F.pmod(v.cast("long"), F.lit(256)).cast("int"))
    if channels == 1:
        return F.flatten(F.transform(byte, lambda v: F.array(v, v, v)))
    return byte if channels == 3 else F.filter(byte, lambda v, i: i % channels < 3)
