"""The nearest segment of each point (GR2, extension), by grid cells: rings grow until they hold one, then cells shrink around it.

Cells of a level are twice as wide as those of the level below, and only whether a segment lies in a cell is kept of
them. A point goes up until a segment lies in its cell or a neighbour of it. Two levels higher, its cell and the eight around
it hold the nearest one for certain; from there it goes down again. At each level it keeps the cells that may still hold the nearest:
those not farther than the farthest corner of another. Only in the last ones distances to segments are taken.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import cut

from .overlay import PAD, covered

#: Levels that are looked at between two cuts of the lineage.
STRIDE = 4
#: Cells are longs at any level; coordinates beyond this many cells of the lowest level are an error.
MOST = 1 << 40


def distance2(px: Column, py: Column) -> Column:
    """The squared distance of a point to the segment x1, y1, x2, y2, which may be a point too."""
    ux, uy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    vx, vy = px - F.col("x1"), py - F.col("y1")
    square = ux * ux + uy * uy
    t = F.when(square > 0, F.least(F.greatest((vx * ux + vy * uy) / square, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    dx, dy = vx - t * ux, vy - t * uy
    return dx * dx + dy * dy


def _finite(*names: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) for c in names])


def _levels(spots: DataFrame, lines: DataFrame, size: float) -> int:
    """A level at which a point's cell and those around it hold everything."""
    far = spots.agg(F.max(F.greatest(F.abs("px"), F.abs("py")) / size).alias("d")).union(lines.agg(F.max(F.greatest(F.abs("cx"), F.abs("cy")).cast("double")).alias("d")))
    return math.ceil(math.log2((far.agg(F.max("d")).first()[0] or 0.0) + 2)) + 3


def _pyramid(lines: DataFrame, top: int) -> Callable[..., DataFrame]:
    """Tables (level, cx, cy) of the cells that hold segments: of one level or of all from 1 on. Higher ones are made from those of STRIDE, which are far fewer."""
    up = lambda c, base: F.expr(f"shiftright(c{c}, level - {base})").alias(f"c{c}")
    made = lambda cells, base, a, b: cut(cells.select("cx", "cy", F.explode(F.sequence(F.lit(a), F.lit(b))).alias("level")).select("level", up("x", base), up("y", base)).distinct())
    low = made(lines, 0, 0, STRIDE)
    high = made(low.filter(F.col("level") == STRIDE).drop("level"), STRIDE, STRIDE + 1, max(top, STRIDE + 1))
    return lambda level=None: low.filter("level > 0").union(high) if level is None else (low if level <= STRIDE else high).filter(F.col("level") == level)


def _around(points: DataFrame, level: Column, size: float) -> DataFrame:
    """px, py, level, cx, cy: the cells of a level in which the points lie, and the eight around each."""
    steps = F.sequence(F.lit(-1), F.lit(1))
    at = points.select("px", "py", level.alias("level"))
    width = F.lit(float(size)) * F.pow(F.lit(2.0), F.col("level"))
    here = at.select("px", "py", "level", *[F.floor(F.col(f"p{c}") / width).cast("long").alias(f"__{c}") for c in "xy"])
    wide = here.withColumn("__i", F.explode(steps)).withColumn("__j", F.explode(steps))
    return wide.select("px", "py", "level", (F.col("__x") + F.col("__i")).alias("cx"), (F.col("__y") + F.col("__j")).alias("cy"))


def _open(cells: DataFrame, level: int, size: float) -> DataFrame:
    """The cells (px, py, cx, cy) of each point that may hold its nearest segment."""
    h = size * 2**level
    pad = size * PAD * 4  # covers reach so far over a cell's border, and some more for rounding
    low, high = (lambda c: F.col(f"c{c}") * h - pad), (lambda c: (F.col(f"c{c}") + 1) * h + pad)
    off = lambda c: F.greatest(low(c) - F.col(f"p{c}"), F.col(f"p{c}") - high(c), F.lit(0.0))
    over = lambda c: F.greatest(F.col(f"p{c}") - low(c), high(c) - F.col(f"p{c}"))
    square = lambda d: d("x") * d("x") + d("y") * d("y")
    told = cells.withColumns({"__near": square(off), "__far": square(over)})
    least = F.min("__far").over(Window.partitionBy("px", "py"))
    return told.withColumn("__least", least).filter(F.col("__near") <= F.col("__least")).select("px", "py", "cx", "cy")


def nearest(points: DataFrame, segments: DataFrame, size: float) -> DataFrame:
    """px, py, way, d: for each different place of points (px, py) its nearest segment (way, x1, y1, x2, y2), and how far it is.

    size: of the lowest cells, about the length of a segment. Distances are in the plane of the coordinates. Of ways
    equally near (as doubles) the smallest counts. Rows with a coordinate that is null or not finite, or without a way, are not looked at;
    without segments there are no rows. Repeated points are looked at once, repeated segments too. The work of a place is a few
    cells at each level and the segments in the last of them: let cells not be much wider than the space between ways.
    """
    spots = points.select(*[F.col(c).cast("double").alias(c) for c in ("px", "py")]).filter(_finite("px", "py")).select(*[(F.col(c) + 0.0).alias(c) for c in ("px", "py")]).distinct()
    lines = segments.select("way", *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).filter(_finite("x1", "y1", "x2", "y2") & F.col("way").isNotNull())
    lines = lines.groupBy("x1", "y1", "x2", "y2").agg(F.min("way").alias("way"))
    held = lambda c: F.when(F.abs(F.col(c)) / size < MOST, F.col(c)).otherwise(F.raise_error(F.lit("a coordinate is too far out for cells of this size")).cast("double")).alias(c)
    spots, lines = cut(spots.select(held("px"), held("py"))), cut(covered(lines.select("way", *[held(c) for c in ("x1", "y1", "x2", "y2")]), size))
    top = _levels(spots, lines, size)
    grid = _pyramid(lines, top)
    # up: a point stops where a segment lies in its cell or beside it; most do at once, the others look at all levels together
    met = _around(spots, F.lit(0), size).join(grid(0), ["level", "cx", "cy"]).select("px", "py").distinct()
    met = cut(met.withColumn("level", F.lit(0)))
    rest = spots.join(met, ["px", "py"], "left_anti")
    above = _around(rest, F.explode(F.sequence(F.lit(1), F.lit(max(top - 2, 1)))), size).join(grid(), ["level", "cx", "cy"])
    starts = met.union(cut(above.groupBy("px", "py").agg(F.min("level").alias("level")).select("px", "py", "level")))
    highest = starts.agg(F.max("level")).first()[0]
    # down
    cells = None
    for at in range(-1 if highest is None else highest + 2, -1, -1):
        here = _around(starts.filter(F.col("level") == at - 2), F.lit(at), size).drop("level")
        if cells is not None:
            child = lambda c: (F.col(f"c{c}") * 2 + F.col(f"__{c}")).alias(f"c{c}")
            both = F.array(F.lit(0), F.lit(1))
            here = here.unionByName(cells.withColumn("__x", F.explode(both)).withColumn("__y", F.explode(both)).select("px", "py", child("x"), child("y")))
        cells = _open(here.join(grid(at).drop("level"), ["cx", "cy"]), at, size)
        cells = cut(cells) if at % STRIDE == 0 else cells
    if cells is None:
        cells = spots.limit(0).select("px", "py", F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"))
    return _best(cells, lines)


def _best(cells: DataFrame, lines: DataFrame) -> DataFrame:
    """px, py, way, d of the cells (px, py, cx, cy; a cut table) with the lines in them (a cut table too).

    First the least distance, which tasks keep in a hash table as they go, then the least of the ways that are as far: the pair
    of both at once would have all distances sorted.
    """
    d = distance2(F.col("px"), F.col("py"))
    least = cells.join(lines, ["cx", "cy"]).groupBy("px", "py").agg(F.min(d).alias("least"))
    met = cells.join(least, ["px", "py"]).join(lines, ["cx", "cy"]).filter(d == F.col("least"))
    return met.groupBy("px", "py", "least").agg(F.min("way").alias("way")).select("px", "py", "way", F.sqrt("least").alias("d"))


def enriched(edges: DataFrame, ways: DataFrame, size: float, reach: float | None = None) -> DataFrame:
    """edges (x1, y1, x2, y2 and any other columns) with way_id, highway, name and way_distance of the way nearest to their middle.

    ways: way_id, highway, name, points (array<struct<x, y>>) in the plane of the edges, as `vectors.ways` gives them once they are projected; of a
    way_id with several rows the attributes of the least. A way of one point counts as that point. Beyond
    `reach`, for edges without a place, or without any way, the four are null. No edge is dropped or repeated; columns of these names are replaced.
    """
    new = ("way_id", "highway", "name", "way_distance")
    edges = edges.select(*[F.col(f"`{c}`") for c in edges.columns if c not in new])
    middle = {f"__m{c}": (F.col(f"{c}1").cast("double") + F.col(f"{c}2").cast("double")) / 2 + 0.0 for c in "xy"}
    placed = edges.withColumns(middle)
    ring = F.filter("points", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    pair = lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))
    stretches = F.when(F.size(ring) == 1, F.transform(ring, lambda p: pair(p, p))).otherwise(F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), pair))
    segments = ways.select(F.col("way_id").alias("way"), F.inline(stretches))
    got = nearest(placed.select(F.col("__mx").alias("px"), F.col("__my").alias("py")), segments, size)
    got = got if reach is None else got.filter(F.col("d") <= reach)
    tags = ways.filter("way_id is not null").groupBy("way_id").agg(F.min(F.struct("highway", "name")).alias("__tags"))
    attributes = got.join(tags, got["way"] == tags["way_id"]).select(F.col("px").alias("__mx"), F.col("py").alias("__my"), "way_id", F.col("__tags.highway").alias("highway"), F.col("__tags.name").alias("name"), F.col("d").alias("way_distance"))
    return placed.join(attributes, ["__mx", "__my"], "left").select(*[F.col(f"`{c}`") for c in edges.columns], *new)
