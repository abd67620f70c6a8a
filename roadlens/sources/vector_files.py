"""Lines from GeoJSON files and Shapefiles, with their attributes (SRC16-17)."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.errors import SourceError
from roadlens.operators import vectors

COLLECTION = "struct<crs: struct<properties: struct<name: string>>, features: array<struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>>"
POINTS = "array<struct<x: double, y: double>>"
#: Fixed values of the Shapefile specification (1998): the file's code, and the types that are made of parts.
CODE, LINES = 9994, (3, 5, 13, 15, 23, 25)
#: Fixed value of the dBASE format: what ends the list of fields.
END_OF_FIELDS = 0x0D


def _as_points(pairs):
    return F.transform(pairs, lambda p: F.struct(F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")))


def geojson(spark: SparkSession, path: str, ending: str | None = None) -> DataFrame:
    """path, crs, feature, part, points, properties of the LineStrings and MultiLineStrings of GeoJSON files.

    Files that are no collection of features give no rows; points have to be two at least. ending: a pattern of the names
    of files below a folder; there may be none.
    """
    reader = spark.read.option("pathGlobFilter", ending).option("recursiveFileLookup", "true") if ending else spark.read
    files = reader.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.from_json("value", COLLECTION).alias("c"))
    features = files.select("path", F.coalesce("c.crs.properties.name", F.lit("EPSG:4326")).alias("crs"), F.posexplode("c.features").alias("feature", "f"))
    kind, raw = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    lines = F.when(kind == "LineString", F.array(F.from_json(raw, "array<array<double>>"))).when(kind == "MultiLineString", F.from_json(raw, "array<array<array<double>>>"))
    out = features.select("path", "crs", "feature", F.posexplode(lines).alias("part", "l"), F.col("f.properties").alias("properties"))
    return out.filter(F.size("l") >= 2).select("path", "crs", F.col("feature").cast("long").alias("feature"), F.col("part").cast("long").alias("part"), _as_points(F.col("l")).alias("points"), "properties")


def lines_of(content: bytes) -> list[list[np.ndarray]]:
    """For each record of a Shapefile, its parts as arrays of points; records of points or null shapes have none."""
    if len(content) < 100 or struct.unpack_from(">i", content)[0] != CODE:
        return []
    at, out = 100, []
    while at + 12 <= len(content):
        words, kind = struct.unpack_from(">i", content, at + 4)[0], struct.unpack_from("<i", content, at + 8)[0]
        parts: list[np.ndarray] = []
        if kind in LINES:
            n_parts, n_points = struct.unpack_from("<2i", content, at + 44)
            begins = [*struct.unpack_from(f"<{n_parts}i", content, at + 52), n_points]
            points = np.frombuffer(content, "<f8", 2 * n_points, at + 52 + 4 * n_parts).reshape(-1, 2)
            parts = [points[a:b] for a, b in zip(begins, begins[1:])]
        out.append(parts)
        at += 8 + 2 * words
    return out


def attributes_of(content: bytes) -> list[dict[str, str | None] | None]:
    """For each record of a dBASE file its fields as text, blank ones null; None for records marked as deleted.

    Text is UTF-8, or Latin-1 where it is not. A file that is cut off has the records that are whole; one that is no such file has none.
    """
    if len(content) < 33:
        return []
    count, head, width = struct.unpack_from("<IHH", content, 4)
    fields, at, begin = [], 32, 1
    while at + 32 <= min(head, len(content)) and content[at] != END_OF_FIELDS:
        size = content[at + 16]
        fields.append((_text(content[at : at + 11].split(b"\0")[0]), begin, begin + size))
        at, begin = at + 32, begin + size
    if not fields or width < begin:
        return []
    rows = (content[k : k + width] for k in range(head, min(head + count * width, len(content) - width + 1), width))
    return [None if r[:1] == b"*" else {name: _text(r[a:b]).strip(" \0") or None for name, a, b in fields} for r in rows]


def _text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _files(spark: SparkSession, path: str, ending: str) -> DataFrame:
    """path, stem, content of the files of an ending; stem: the path without it."""
    pattern = "".join(f"[{c}{c.upper()}]" for c in ending)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{pattern}").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.regexp_replace("path", r"\.[^./]*$", "").alias("stem"), "content")


def shapefile(spark: SparkSession, path: str, attributes: bool = False) -> DataFrame:
    """path, feature, part, points of the lines and rings of .shp files; points have to be two at least.

    attributes: with properties too, a map of text by name from the .dbf file of the same name (the first by path, if
    endings differ in case). Records are matched by their number; without a file, or where the record is deleted, it is null.
    """

    @F.pandas_udf(f"array<struct<feature: long, part: long, points: {POINTS}>>")
    def read(contents: pd.Series) -> pd.Series:
        return pd.Series([[{"feature": i, "part": k, "points": [{"x": x, "y": y} for x, y in p.tolist()]} for i, parts in enumerate(lines_of(bytes(c))) for k, p in enumerate(parts) if len(p) > 1] for c in contents])

    @F.pandas_udf("array<map<string, string>>")
    def fields(contents: pd.Series) -> pd.Series:
        return pd.Series([attributes_of(bytes(c)) for c in contents])

    lines = _files(spark, path, "shp").select("path", "stem", F.inline(read("content")))
    if not attributes:
        return lines.drop("stem")
    tables = _files(spark, path, "dbf")
    first = tables.groupBy("stem").agg(F.min("path").alias("path")).select("path")  # of the listing: no file is opened for it
    known = tables.join(first, "path", "left_semi").select("stem", F.posexplode(fields("content")).alias("feature", "properties"))
    return lines.join(known.withColumn("feature", F.col("feature").cast("long")), ["stem", "feature"], "left").select("path", "feature", "part", "points", "properties")


def all_lines(spark: SparkSession, folder: str, attributes: bool = False) -> DataFrame:
    """path, crs, feature, part, points of every vector file below a folder, under the reference system of the first; attributes: with properties too."""
    shapes = shapefile(spark, folder, attributes).withColumn("crs", F.lit(None).cast("string"))
    features = geojson(spark, folder, "*json")
    both = (features if attributes else features.drop("properties")).unionByName(shapes)
    first = both.agg(F.min_by("crs", "path").alias("c")).first()
    if first is None or not both.limit(1).count():
        raise SourceError(f"no lines below {folder}")
    return both.withColumn("crs", F.lit(first["c"]))


def mask_of(spark: SparkSession, folder: str, height: int = 1024, width: int = 1024, reach: float = 5.0) -> DataFrame:
    """x, y: the pixels of one mask that lie within reach (in pixels) of any line below a folder (RAS23).

    The mask spans the box of all lines; a box without width or height is one pixel wide or high.
    """
    lines = all_lines(spark, folder)
    point = lines.select(F.explode("points").alias("p"))
    box = F.broadcast(point.agg(F.min("p.x").alias("l"), F.min("p.y").alias("b"), F.max("p.x").alias("r"), F.max("p.y").alias("t")))  # one row
    x = lambda p: F.when(F.col("r") > F.col("l"), (p["x"] - F.col("l")) / (F.col("r") - F.col("l")) * width).otherwise(0.5) - 0.5
    y = lambda p: F.when(F.col("t") > F.col("b"), (F.col("t") - p["y"]) / (F.col("t") - F.col("b")) * height).otherwise(0.5) - 0.5
    placed = lines.join(box).select(F.transform("points", lambda p: F.struct(x(p).alias("x"), y(p).alias("y"))).alias("points"))
    return vectors.burnt(vectors.segments(placed), height=height, width=width, reach=reach)
