"""Lines as GeoJSON and back, and lines burnt into masks (SRC16-18, RAS22-25, FIL9, SNK7, FN13-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import geo

FEATURE = "struct<type: string, geometry: struct<type: string, coordinates: array<array<double>>>, properties: map<string, string>>"
WAY = "struct<type: string, id: bigint, geometry: array<struct<lon: double, lat: double>>, tags: map<string, string>>"
#: The classes of ways that count as roads.
HIGHWAYS = ("motorway", "trunk", "primary", "secondary", "tertiary", "residential", "unclassified", "road")


def feature(points: Column, source: str = "roadlens", crs: str | Column = "pixel") -> Column:
    """A GeoJSON feature, as text, of an array of points (x, y)."""
    coordinates = F.transform(points, lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates")).alias("geometry"), F.create_map(F.lit("source"), F.lit(source), F.lit("crs"), F.lit(crs)).alias("properties")))


def vertices(features: DataFrame, *keys: str, column: str = "feature") -> DataFrame:
    """keys, k (0 first), x, y: the points of LineString features held as text. Others give no rows."""
    read = features.withColumn("__f", F.from_json(column, FEATURE)).filter((F.col("__f.geometry.type") == "LineString") & (F.size("__f.geometry.coordinates") > 0))
    return read.select(*keys, F.posexplode("__f.geometry.coordinates").alias("k", "__p")).select(*keys, F.col("k").cast("long").alias("k"), F.element_at("__p", 1).alias("x"), F.element_at("__p", 2).alias("y"))


def ways(replies: DataFrame, *keys: str, column: str = "reply") -> DataFrame:
    """keys, way_id, highway, name, points: ways of at least two points from saved map replies; a class of 'road' and an empty name where they lack tags."""
    elements = replies.select(*keys, F.explode(F.from_json(column, f"struct<elements: array<{WAY}>>")["elements"]).alias("e"))
    real = elements.filter((F.col("e.type") == "way") & (F.size("e.geometry") >= 2))
    tag = lambda k, other: F.coalesce(F.try_element_at(F.col("e.tags"), F.lit(k)), F.lit(other))
    points = F.transform("e.geometry", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    return real.select(*keys, F.col("e.id").alias("way_id"), tag("highway", "road").alias("highway"), tag("name", "").alias("name"), points.alias("points"))


def segments(lines: DataFrame, *keys: str, points: str = "points") -> DataFrame:
    """keys, x1, y1, x2, y2: the stretches between neighbouring points of lines."""
    pairs = F.arrays_zip(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))).alias("a"), F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))).alias("b"))
    return lines.select(*keys, F.explode(pairs).alias("s")).select(*keys, *[F.col(f"s.{e}.{c}").cast("double").alias(f"{c}{i}") for i, e in ((1, "a"), (2, "b")) for c in ("x", "y")])


def burnt(segments_: DataFrame, *keys: str, height: int, width: int, reach: float) -> DataFrame:
    """keys, x, y: the pixels of a mask that lie within reach of any segment, each once.

    A segment makes rows only for the pixels of its own box, so the work follows the drawn area, not lines times pixels;
    pixels that many segments touch are merged before the shuffle.
    """
    low = lambda a, b: F.greatest(F.ceil(F.least(a, b) - reach), F.lit(0)).cast("int")
    high = lambda a, b, n: F.least(F.floor(F.greatest(a, b) + reach), F.lit(n - 1)).cast("int")
    span = lambda a, b, n: F.when(low(a, b) <= high(a, b, n), F.sequence(low(a, b), high(a, b, n)))
    boxed = segments_.withColumn("y", F.explode(span(F.col("y1"), F.col("y2"), height))).withColumn("x", F.explode(span(F.col("x1"), F.col("x2"), width)))
    ux, uy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.least(F.greatest(((F.col("x") - F.col("x1")) * ux + (F.col("y") - F.col("y1")) * uy) / F.greatest(ux * ux + uy * uy, F.lit(1e-12)), F.lit(0.0)), F.lit(1.0))
    a, b = F.col("x") - F.col("x1") - t * ux, F.col("y") - F.col("y1") - t * uy
    return boxed.filter(a * a + b * b <= reach * reach).select(*keys, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y")).distinct()


def map_features(lines: DataFrame, *keys: str, references: DataFrame | None = None, source: str = "roadlens") -> DataFrame:
    """keys, line, feature: centre lines (points in pixels) as GeoJSON features (RAS25).

    references: keys, crs, transform of georeferenced rasters; their lines are in map coordinates, of the pixels' centres.
    All others stay in pixels.
    """
    if references is None:
        return lines.select(*keys, "line", feature(F.col("points"), source).alias("feature"))
    known = lines.join(references.select(*keys, F.col("crs").alias("__crs"), F.col("transform").alias("__t")), list(keys), "left")
    placed = F.transform("points", lambda p: F.when(F.col("__t").isNotNull(), geo.pixel_centre(F.col("__t"), p["x"], p["y"])).otherwise(F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))))
    crs = F.when(F.col("__t").isNull(), F.lit("pixel")).otherwise(F.coalesce("__crs", F.lit("unknown")))
    return known.select(*keys, "line", feature(placed, source, crs).alias("feature"))


def collection(features: DataFrame, by: str, column: str = "feature") -> DataFrame:
    """by, collection: GeoJSON FeatureCollections as text, one for each file that is to be written (by), whose size bounds a row."""
    return features.groupBy(by).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.array_sort(F.collect_list(column))), F.lit("]}")).alias("collection"))
