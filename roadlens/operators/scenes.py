"""Scenes in tiles: centre lines, regions and road graphs across tile borders as those of the whole scene (GR1-2, RAS24, extension).

A scene's tiles lie side by side: row and col of a grid whose tiles are `side` pixels wide and high, but for the last ones.
tiles: scene (a whole number from 0 to below 2^21), row, col, height, width and data (bytes, row by row; above 0 is road). Tiles that are
missing count as empty; each is given once. A tile only ever sees a rim of its neighbours; a scene is never in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut

from . import graphs, kernels
from .components import connected_components

#: A pixel's place is one long: scene, y and x, of so many bits each.
BITS = 21
KEYS = ("scene", "row", "col")
RIM = "row: long, col: long, dy: int, dx: int, block: binary"


def _place(scene: int, y, x):
    return (int(scene) << 2 * BITS) | (np.asarray(y, np.int64) << BITS) | np.asarray(x, np.int64)


def _pixels(data: bytes, height: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(int(height), -1) if height else np.zeros((0, 0), np.uint8)


def _rimmed(tiles: DataFrame, rim: int) -> DataFrame:
    """scene, row, col, height, width, parts: each tile with the blocks of its neighbours within `rim` pixels (dy, dx, block); its own is 0, 0.

    A tile sends eight blocks, so what is shuffled is the tiles and their borders, and a row holds nine blocks at most.
    """

    @F.pandas_udf(f"array<struct<{RIM}>>")
    def sent(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for rows, cols, heights, data in batches:
            out = []
            for r, c, h, d in zip(rows, cols, heights, data):
                m = _pixels(d, h)
                cuts = {-1: slice(0, rim), 0: slice(None), 1: slice(-rim, None)}  # what a neighbour above, beside or below sees
                blocks = [(a, b, np.ascontiguousarray(m[cuts[a], cuts[b]])) for a in (-1, 0, 1) for b in (-1, 0, 1)]
                out.append([{"row": r + a, "col": c + b, "dy": -a, "dx": -b, "block": x.tobytes()} for a, b, x in blocks if (a, b) == (0, 0) or x.any()])
            yield pd.Series(out)

    shape = F.struct("height", "width")
    known = F.when(F.col("scene").between(0, (1 << BITS) - 1), F.col("scene").cast("long")).otherwise(F.raise_error(F.lit("a scene has to be numbered from 0 to below 2^21")).cast("long"))
    rows = tiles.select(known.alias("scene"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("height").cast("int").alias("height"), F.col("width").cast("int").alias("width"), "data")
    blocks = rows.select("scene", shape.alias("__of"), F.explode(sent("row", "col", "height", "data")).alias("b"))
    own = (F.col("b.dy") == 0) & (F.col("b.dx") == 0)
    part = F.struct(F.col("b.dy").alias("dy"), F.col("b.dx").alias("dx"), F.col("__of.height").alias("h"), F.col("__of.width").alias("w"), F.col("b.block").alias("block"))
    met = blocks.groupBy("scene", F.col("b.row").alias("row"), F.col("b.col").alias("col")).agg(F.max(F.when(own, F.col("__of"))).alias("__of"), F.collect_list(part).alias("parts"))
    return met.filter("__of is not null").select(*KEYS, "__of.height", "__of.width", "parts")


def _joined(height: int, width: int, parts, rim: int) -> np.ndarray:
    """A tile with its rim; what no neighbour covers is empty."""
    m = np.zeros((height + 2 * rim, width + 2 * rim), np.uint8)
    for p in parts:
        h, w = (min(rim, p["h"]) if p["dy"] else p["h"]), (min(rim, p["w"]) if p["dx"] else p["w"])
        block = np.frombuffer(p["block"], np.uint8).reshape(h, w)
        y = {-1: rim - h, 0: rim, 1: rim + height}[p["dy"]]
        x = {-1: rim - w, 0: rim, 1: rim + width}[p["dx"]]
        h, w = min(h, m.shape[0] - y), min(w, m.shape[1] - x)
        m[y : y + h, x : x + w] = block[:h, :w]
    return m


def thinned(tiles: DataFrame, side: int, rim: int = 16) -> DataFrame:
    """The tiles with their scenes' centre lines as data (0 and 1).

    A pass of thinning looks two pixels far, so rim / 2 passes on a tile with its rim are right within the tile. Rims are then
    exchanged again, until no pass changes a tile: a round for each rim / 2 pixels of half the widest road. A rim is no wider than a tile.
    """
    if side < 2:
        raise ValueError("tiles have to be two pixels wide at least")
    passes = max(min(rim, side) // 2, 1)

    @F.pandas_udf("data binary, changed boolean")
    def step(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for heights, widths, parts in batches:
            rows = []
            for h, w, p in zip(heights, widths, parts):
                last = kernels.thinned(_joined(h, w, p, 2 * passes), passes - 1)
                inner = (slice(2 * passes, 2 * passes + h), slice(2 * passes, 2 * passes + w))
                now = kernels.thinned(last, 1)
                rows.append((np.ascontiguousarray(now[inner]).astype(np.uint8).tobytes(), bool((now[inner] != (last[inner] > 0)).any())))
            yield pd.DataFrame(rows, columns=["data", "changed"])

    now = tiles
    while True:
        now = cut(_rimmed(now, 2 * passes).withColumn("__s", step("height", "width", "parts")).select(*KEYS, "height", "width", "__s.data", "__s.changed"))
        if not now.filter("changed").limit(1).count():
            return now.drop("changed")


def regions(tiles: DataFrame, side: int) -> DataFrame:
    """scene, region, pixels: the regions (neighbours touch at sides or corners) of whole scenes; region: the least place of a border or first pixel of it.

    Tiles name their own regions; pixels on both sides of a border are links, and components of the links unite regions.
    """

    @F.pandas_udf("own array<struct<region: long, pixels: long>>, links array<struct<a: long, b: long>>")
    def labelled(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for scenes, rows, cols, heights, widths, parts in batches:
            out = []
            for s, r, c, h, w, p in zip(scenes, rows, cols, heights, widths, parts):
                m = _joined(h, w, p, 1)
                y, x, label = graphs.regions(m[1:-1, 1:-1])
                places = _place(s, y + r * side, x + c * side)
                first, counts = np.unique(label, return_counts=True)
                own = [{"region": int(places[k]), "pixels": int(n)} for k, n in zip(first, counts)]
                pairs = set()
                for k in np.flatnonzero((y == 0) | (x == 0) | (y == h - 1) | (x == w - 1)).tolist():
                    a, b = int(y[k]), int(x[k])
                    pairs.add((int(places[label[k]]), int(places[k])))
                    pairs |= {(int(places[k]), int(_place(s, a + i + r * side, b + j + c * side))) for i in (-1, 0, 1) for j in (-1, 0, 1) if not (0 <= a + i < h and 0 <= b + j < w) and m[a + i + 1, b + j + 1]}
                out.append((own, [{"a": a, "b": b} for a, b in pairs if a != b]))
            yield pd.DataFrame(out, columns=["own", "links"])

    told = cut(_rimmed(tiles, 1).select("scene", labelled(*KEYS, "height", "width", "parts").alias("t")).select("scene", "t.*"))
    names = connected_components(told.select(F.inline("links")), "a", "b")
    own = told.select("scene", F.inline("own")).join(names, F.col("region") == F.col("node"), "left")
    return own.groupBy("scene", F.coalesce("component", "region").alias("region")).agg(F.sum("pixels").alias("pixels"))


def road_graph(skeleton: DataFrame, side: int) -> DataFrame:
    """scene, src, dst, weight: centre lines of whole scenes (as `thinned` gives them) as edges between end points and junctions, by their length in pixels.

    src and dst are places, the smaller first. Tiles trace their own pixels and stop where a line leaves them; pieces that meet at
    such a place, where no other line does, are one edge. A closed line without any node begins and ends at its leftmost pixel, the uppermost of these.
    """

    @F.pandas_udf("array<struct<a: long, b: long, a_node: boolean, b_node: boolean, first: long, straight: long, slanted: long>>")
    def traced(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for scenes, rows, cols, heights, widths, parts in batches:
            out = []
            for s, r, c, h, w, p in zip(scenes, rows, cols, heights, widths, parts):
                m = _joined(h, w, p, 1) > 0
                degree = np.zeros((h, w), int)
                outside = np.zeros((h, w), bool)
                framed = m.copy()
                framed[1:-1, 1:-1] = False
                for i in (0, 1, 2):
                    for j in (0, 1, 2):
                        if (i, j) != (1, 1):
                            degree += m[i : i + h, j : j + w]
                            outside |= framed[i : i + h, j : j + w]
                own = m[1:-1, 1:-1]
                stops = frozenset(zip(*(v.tolist() for v in np.nonzero(own & outside)[::-1])))
                at = lambda q: int(_place(s, q[1] + r * side, q[0] + c * side))  # noqa: E731, B023
                far = lambda q: (q[0] + c * side, q[1] + r * side)  # noqa: E731, B023
                pieces = []
                for chain in kernels.lines(own, stops):
                    slanted = sum(u[0] != v[0] and u[1] != v[1] for u, v in zip(chain, chain[1:]))
                    a, b = chain[0], chain[-1]
                    loop = a == b and degree[a[1], a[0]] == 2 and a not in stops
                    first = min(map(far, chain))
                    pieces.append({"a": at(a), "b": at(b), "a_node": bool(loop or degree[a[1], a[0]] != 2), "b_node": bool(loop or degree[b[1], b[0]] != 2), "first": (first[0] << BITS) | first[1], "straight": len(chain) - 1 - slanted, "slanted": slanted})
                # steps over a border: each is told by the tile of its smaller place; only that tile's end has a known degree
                for x, y in sorted(stops):
                    for i in (-1, 0, 1):
                        for j in (-1, 0, 1):
                            if framed[y + i + 1, x + j + 1]:
                                a, b = at((x, y)), at((x + j, y + i))
                                q = min(far((x, y)), far((x + j, y + i)))
                                pieces.append({"a": a, "b": b, "a_node": bool(degree[y, x] != 2), "b_node": None, "first": (q[0] << BITS) | q[1], "straight": int(not (i and j)), "slanted": int(bool(i and j))})
                out.append(pieces)
            yield pd.Series(out)

    told = cut(_rimmed(skeleton, 1).select("scene", F.inline(traced(*KEYS, "height", "width", "parts"))))
    # a step over a border is told from either side, each with what it knows of its own end
    across = told.filter("b_node is null")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    steps = across.groupBy("scene", low.alias("a"), high.alias("b")).agg(
        F.max(F.when(F.col("a") == low, F.col("a_node"))).alias("a_node"), F.max(F.when(F.col("a") == high, F.col("a_node"))).alias("b_node"), F.min("first").alias("first"), F.min("straight").alias("straight"), F.min("slanted").alias("slanted"),
    )
    pieces = cut(told.filter("b_node is not null").unionByName(steps))
    ends = pieces.filter("not a_node and not b_node").select("a", "b")
    names = connected_components(ends, "a", "b")
    cuts = pieces.withColumn("__c", F.when(~F.col("a_node"), F.col("a")).when(~F.col("b_node"), F.col("b")))
    whole = cuts.join(names, F.col("__c") == F.col("node"), "left").withColumn("__c", F.coalesce("component", "__c"))
    nodes = F.filter(F.array(F.when(F.col("a_node"), F.col("a")), F.when(F.col("b_node"), F.col("b"))), lambda p: p.isNotNull())
    single = whole.filter("__c is null").select("scene", "a", "b", "first", "straight", "slanted")
    # at most two ends of a line are nodes
    met = whole.filter("__c is not null").withColumn("__n", nodes).groupBy("scene", "__c").agg(F.min(F.array_min("__n")).alias("a"), F.max(F.array_max("__n")).alias("b"), F.min("first").alias("first"), F.sum("straight").alias("straight"), F.sum("slanted").alias("slanted"))
    start = F.shiftleft(F.col("scene").cast("long"), 2 * BITS).bitwiseOR(F.shiftleft(F.col("first").bitwiseAND((1 << BITS) - 1), BITS)).bitwiseOR(F.shiftright("first", BITS))
    lined = met.select("scene", F.coalesce("a", start).alias("a"), F.coalesce("b", start).alias("b"), "first", "straight", "slanted")
    return single.union(lined).select("scene", low.alias("src"), high.alias("dst"), (F.col("straight") + F.col("slanted") * F.sqrt(F.lit(2.0))).alias("weight"))


def ends_of(place: Column) -> Column:
    """scene, y and x of a place."""
    part = (1 << BITS) - 1
    return F.struct(F.shiftright(place, 2 * BITS).alias("scene"), F.shiftright(place, BITS).bitwiseAND(part).alias("y"), place.bitwiseAND(part).alias("x"))
