"""Connected components of a link table by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut, small

from .unions import join_roots

#: A table of at most so many rows (two numbers each) is broadcast.
FEW = 500_000
#: In larger graphs, nodes with more neighbours than this are hubs: their rows meet the least neighbour by broadcast, not in one task.
HUB = 10_000
#: Links that a task takes at a time to leave out those that say nothing new.
CHUNK = 1_000_000


def _with_least(rows: DataFrame, few: bool, hub: int) -> DataFrame:
    """rows (u, v) with m, the least v of the same u. No task holds all rows of a hub.

    The least is an aggregation with map-side combine. If there are few rows, so are the leasts, and they are broadcast.
    Else hubs alone are: at most one for each `hub` rows. Should even they be many, they are joined by shuffle like the
    others, where AQE may split them, as both sides have exchanges.
    """
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    if few:
        return rows.join(F.broadcast(least.select("u", "m")), "u")
    least = cut(least)
    hubs = small(least.filter(F.col("n") > hub).select("u", "m"), FEW)
    rest = rows.join(hubs, "u", "left_anti").join(least.filter(F.col("n") <= hub).select("u", "m"), "u")
    return rows.join(hubs, "u").select("u", "v", "m").union(rest.select("u", "v", "m"))


def _telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) in chunks: of each chunk a star for each of its components, which connects the same nodes by fewer links."""

    def stars(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy() for b in rows]) for k in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = join_roots(np.arange(len(nodes)), at[: len(u)], at[len(u) :])
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["u", "v"])

    rows, n = [], 0
    for b in batches:
        rows.append(b)
        n += b.num_rows
        if n >= CHUNK:
            yield stars(rows)
            rows, n = [], 0
    if n:
        yield stars(rows)


def connected_components(links: DataFrame, left: str, right: str, few: int = FEW, hub: int = HUB) -> DataFrame:
    """node, component: for every id that has a link, the smallest id it reaches.

    First each task replaces links that lie together by fewer with the same components; links that are in no order gain
    nothing by that and lose nothing. Each round is two aggregations with map-side combine and two joins in which hubs are broadcast, and ends in a
    checkpoint, so neither lineage nor any task grows with a component. Links with a null end and loops are ignored; an
    empty table gives an empty one.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), a.isNull().alias("x"), b.isNull().alias("y")).filter("not x and not y and u > v").select("u", "v")
    edges = cut(pairs.mapInArrow(_telling, "u long, v long").distinct())
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    seen = edges.agg(mark.alias("m")).first()["m"]
    while seen["n"]:
        is_small = 2 * seen["n"] <= few
        # large star: the larger neighbours of a node, and then the node's least, point to each other
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        wide = _with_least(both, is_small, hub).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        wide = wide if is_small else cut(wide)
        # small star: the smaller neighbours of a node, and the node, point to the least of them
        near = _with_least(wide, is_small, hub)
        edges = cut(near.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct())
        now = edges.agg(mark.alias("m")).first()["m"]
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
