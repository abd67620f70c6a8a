"""Flood zones over road edges (GR4, extension): which edges a polygon touches, by a join over grid cells.

Zones and edges are never compared as wholes. The sides of a zone's ring and the edges lie in the cells that they cross, and
meet there, where an exact test tells whether they touch. An edge that touches no side is inside or outside as its first
point is: cells that no side crosses are inside by the crossings of their row's middle line, row by row, so that a large zone is
spread over the rows of its cover; in the others the point is tested against the sides in its row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import cut, small

#: By so large a part of a cell covers reach over its border, so that rounding loses nothing.
PAD = 1e-6


#: Zones of one place go in lists of about so many; so many lists at most are broadcast.
LIST, LISTS = 1_000, 2_000
PLACE = ["x1", "y1", "x2", "y2"]


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def sides(zones: DataFrame) -> DataFrame:
    """zone, x1, y1, x2, y2: the sides of zones' rings (points array<struct<x, y>>), closed if they are not. Sides of no length go."""
    ring = F.filter("points", lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    n = F.size(ring)
    both = F.transform(ring, lambda p, k: F.struct(p["x"].cast("double").alias("x1"), p["y"].cast("double").alias("y1"), F.get(ring, (k + 1) % n)["x"].cast("double").alias("x2"), F.get(ring, (k + 1) % n)["y"].cast("double").alias("y2")))
    return zones.select("zone", F.inline(both)).filter("x1 <> x2 or y1 <> y2")


def covered(rows: DataFrame, size: float) -> DataFrame:
    """rows (x1, y1, x2, y2 and any other columns) with cx, cy: a row for each cell that the segment crosses, row by row of the grid."""
    pad = size * PAD
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = rows.withColumn("cy", F.explode(F.sequence(_cell(low - pad, size), _cell(high + pad, size))))
    # where the segment enters and leaves the row of cells
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * ((y - F.col("y1")) / (F.col("y2") - F.col("y1"))))
    inside = lambda y: F.greatest(F.least(y, high), low)
    a, b = at(inside(F.col("cy") * size - pad)), at(inside((F.col("cy") + 1) * size + pad))
    level = F.col("y1") == F.col("y2")
    left, right = F.when(level, F.least("x1", "x2")).otherwise(F.least(a, b)), F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(a, b))
    return lines.withColumn("cx", F.explode(F.sequence(_cell(left - pad, size), _cell(right + pad, size))))


def _turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """On which side of a to b the point c lies: 1, -1 or 0."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def touching(a: str, b: str) -> Column:
    """Whether two segments have a point in common; a and b: the prefixes of their columns."""
    p = lambda s, k: (F.col(f"{s}x{k}"), F.col(f"{s}y{k}"))
    turns = [_turn(*p(s, 1), *p(s, 2), *p(o, k)) for s, o in ((a, b), (b, a)) for k in (1, 2)]
    apart = lambda c: (F.greatest(f"{a}{c}1", f"{a}{c}2") < F.least(f"{b}{c}1", f"{b}{c}2")) | (F.greatest(f"{b}{c}1", f"{b}{c}2") < F.least(f"{a}{c}1", f"{a}{c}2"))
    return (turns[0] * turns[1] <= 0) & (turns[2] * turns[3] <= 0) & ~apart("x") & ~apart("y")


def _named(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.withColumnsRenamed({f"{c}{k}": f"{prefix}{c}{k}" for c in "xy" for k in (1, 2)})


def _shapes(rows: DataFrame, by: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The different shapes of rows (name, n: how many have it, by), and rows with the name of theirs. Both are cut tables."""
    shapes = cut(rows.groupBy(*by).agg(F.count("*").alias("n")).withColumn(name, F.monotonically_increasing_id()))
    return shapes, cut(rows.join(shapes, by).drop(*by))


def _meetings(roads: DataFrame, zones: DataFrame, size: float) -> DataFrame:
    """road, zone: each segment (road, x1, y1, x2, y2) and ring (zone, points) that touch, or of which one holds the other, once."""
    rim, cells = sides(zones), covered(sides(zones), size)
    crossed = _named(covered(roads, size), "a").join(_named(cells, "b"), ["cx", "cy"]).filter(touching("a", "b")).select("road", "zone")
    # cells of the middle lines between crossings, that no side enters
    middle = (F.col("cy") + 0.5) * size
    rows = rim.withColumn("cy", F.explode(F.sequence(_cell(F.least("y1", "y2"), size), _cell(F.greatest("y1", "y2"), size)))).filter((F.col("y1") > middle) != (F.col("y2") > middle))
    rows = rows.select("zone", "cy", (F.col("x1") + (F.col("x2") - F.col("x1")) * ((middle - F.col("y1")) / (F.col("y2") - F.col("y1")))).alias("x"))
    line = Window.partitionBy("zone", "cy").orderBy("x")
    spans = rows.select("zone", "cy", "x", F.lead("x").over(line).alias("end"), F.row_number().over(line).alias("k")).filter("k % 2 = 1 and end is not null")
    first, last = F.ceil(F.col("x") / size - 0.5).cast("long"), F.floor(F.col("end") / size - 0.5).cast("long")
    inner = spans.withColumns({"first": first, "last": last}).filter("first <= last").select("zone", "cy", F.explode(F.sequence("first", "last")).alias("cx"))
    border = cells.select("zone", "cx", "cy").distinct()
    inner = inner.join(border, ["zone", "cx", "cy"], "left_anti")
    starts = roads.select("road", F.col("x1").alias("px"), F.col("y1").alias("py"), _cell(F.col("x1"), size).alias("cx"), _cell(F.col("y1"), size).alias("cy"))
    within = starts.join(inner, ["cx", "cy"]).select("road", "zone")
    # beside a side: crossings of the ray to the right, of the zone's sides that reach the point's height
    near = starts.join(border, ["cx", "cy"]).select("road", "px", "py", "cy", "zone")
    tall = rim.withColumn("cy", F.explode(F.sequence(_cell(F.least("y1", "y2"), size), _cell(F.greatest("y1", "y2"), size))))
    to_right = ((F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))) & (F.col("px") < (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    safe = F.when(F.col("y1") != F.col("y2"), to_right).otherwise(False)
    beside = near.join(tall, ["zone", "cy"]).groupBy("road", "zone").agg(F.sum(safe.cast("int")).alias("n")).filter("n % 2 = 1").select("road", "zone")
    return crossed.union(within).union(beside).distinct()


def flooded(edges: DataFrame, zones: DataFrame, size: float) -> DataFrame:
    """src, dst, zone: each edge (src, dst, x1, y1, x2, y2) and zone (zone, points) that touches or holds it, once.

    size: of a grid cell, about the length of an edge. Inside is by the even-odd rule; the ring itself counts. Edges with a
    null coordinate, and zones without points, touch nothing; empty tables give an empty one. Edges and zones of the same
    place are looked at once: their pairs are spelt out last, from lists of LIST zones at most, and not shuffled again.
    """
    roads = edges.select("src", "dst", *[F.col(c).cast("double").alias(c) for c in PLACE]).dropna(subset=PLACE).distinct()
    lines, roads = _shapes(roads, PLACE, "road")
    rings, named = _shapes(zones.select("zone", "points").filter("points is not null").distinct(), ["points"], "ring")
    # what is named by several places may come more than once
    repeated = lambda df, *by: df.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n").withColumn("again", F.lit(True))
    marked = lambda df, again, *by: df.join(again, reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]), "left").select(*df.columns, F.coalesce("again", F.lit(False)).alias("again"))
    roads_again, zones_again = repeated(roads, "src", "dst"), repeated(named, "zone")
    lists = marked(named, zones_again, "zone").groupBy("ring", "again", F.pmod(F.xxhash64("zone"), F.ceil(F.col("n") / LIST)).alias("part")).agg(F.collect_list(F.struct("zone")).alias("zones"))
    lists = small(cut(lists.select("ring", F.col("again").alias("z"), "zones")), LISTS)
    met = _meetings(lines, rings.select(F.col("ring").alias("zone"), "points"), size).withColumnRenamed("zone", "ring")
    pairs = met.join(marked(roads, roads_again, "src", "dst").select("road", "src", "dst", "again"), "road").join(lists, "ring")
    once = lambda rows: rows.select("src", "dst", F.explode("zones").alias("z")).select("src", "dst", "z.zone")
    if not roads_again.limit(1).count() and not zones_again.limit(1).count():
        return once(pairs)
    pairs = cut(pairs.withColumn("again", F.col("again") | F.col("z")))
    return once(pairs.filter("not again")).union(once(pairs.filter("again")).distinct())
