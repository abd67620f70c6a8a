"""Geographic metadata of TIFF files, read from their tags (SRC13, D12)."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the TIFF 6.0 and GeoTIFF 1.1 specifications: field types by number, and the tags that are read.
FIELD = {1: "B", 2: "c", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q"}
WIDTH, HEIGHT, BITS, SAMPLES, FORMAT = 256, 257, 258, 277, 339
SCALE, TIEPOINT, MATRIX, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113
GEOGRAPHIC_KEY, PROJECTED_KEY, PIXEL_IS_KEY = 2048, 3072, 1025
SCHEMA = (
    "width int, height int, band_count int, dtype string, is_georeferenced boolean, crs string, transform struct<a: double, b: double, c: double, d: double, e: double, f: double>, "
    "bounds struct<left: double, bottom: double, right: double, top: double>, resolution_x double, resolution_y double, nodata double"
)


def tags(content: bytes) -> dict[int, tuple]:
    """The tags of the first image of a TIFF file, classic or big; nothing if it is no TIFF or is cut short."""
    order, big = {b"II*\0": ("<", False), b"MM\0*": (">", False), b"II+\0": ("<", True), b"MM\0+": (">", True)}.get(content[:4], ("", False))
    if not order:
        return {}
    place_kind, number_kind, entry, inline = ("Q", "Q", 20, 8) if big else ("I", "H", 12, 4)
    out = {}
    try:
        (at,) = struct.unpack_from(order + place_kind, content, 8 if big else 4)
        (n,) = struct.unpack_from(order + number_kind, content, at)
        at += struct.calcsize(number_kind)
        for k in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HH{place_kind}", content, at + entry * k)
            if kind not in FIELD or count > len(content):
                continue
            place = at + entry * (k + 1) - inline
            if struct.calcsize(FIELD[kind]) * count > inline:
                (place,) = struct.unpack_from(order + place_kind, content, place)
            values = struct.unpack_from(f"{order}{count}{FIELD[kind]}", content, place)
            out[tag] = (b"".join(values),) if kind == 2 else values
    except struct.error:
        return {}
    return out


def described(content: bytes) -> tuple:
    """A row of SCHEMA; all null but is_georeferenced for files that cannot be read."""
    t = tags(content)
    if WIDTH not in t or HEIGHT not in t:
        return (None, None, None, None, False, *[None] * 6)
    w, h = t[WIDTH][0], t[HEIGHT][0]
    keys = t.get(GEO_KEYS, ())
    geo = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
    kind = {1: "uint", 2: "int", 3: "float"}.get(t.get(FORMAT, (1,))[0], "uint")
    dtype = f"{kind}{t.get(BITS, (1,))[0]}"
    matrix = None
    if MATRIX in t:
        m = t[MATRIX]
        matrix = (m[0], m[1], m[3], m[4], m[5], m[7])
    elif SCALE in t and TIEPOINT in t:
        (sx, sy), (i, j, _, x, y) = t[SCALE][:2], t[TIEPOINT][:5]
        shift = 0.5 if geo.get(PIXEL_IS_KEY) == 2 else 0.0  # a point raster ties centres, not corners
        matrix = (sx, 0.0, x - (i + shift) * sx, 0.0, -sy, y + (j + shift) * sy)
    code = geo.get(PROJECTED_KEY) or geo.get(GEOGRAPHIC_KEY)
    try:
        nodata = float(t[NODATA][0].rstrip(b"\0 ")) if NODATA in t else None
    except ValueError:
        nodata = None
    if matrix is None:
        return (w, h, t.get(SAMPLES, (1,))[0], dtype, False, None, None, None, None, None, nodata)
    a, b, c, d, e, f = matrix
    xs, ys = [c + a * u + b * v for u in (0, w) for v in (0, h)], [f + d * u + e * v for u in (0, w) for v in (0, h)]
    crs = f"EPSG:{code}" if code and code < 32767 else None
    return (w, h, t.get(SAMPLES, (1,))[0], dtype, crs is not None, crs, dict(zip("abcdef", matrix)), {"left": min(xs), "bottom": min(ys), "right": max(xs), "top": max(ys)}, abs(a), abs(e), nodata)


def tags_of(content: Column) -> Column:
    """SCHEMA of a file's content; nulls, and not georeferenced, if it is no TIFF or null."""

    @F.pandas_udf(SCHEMA)
    def of(content: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([described(bytes(c or b"")) for c in content], columns=[c.split()[0] for c in "width height band_count dtype is_georeferenced crs transform bounds resolution_x resolution_y nodata".split()]).astype({"width": "Int32", "height": "Int32", "band_count": "Int32"})

    return of(content)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """path and SCHEMA of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", tags_of(F.col("content")).alias("m")).select("path", "m.*")
