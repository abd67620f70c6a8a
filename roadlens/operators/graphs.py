"""Road graphs (GR1-5): the plans that the reference only declares. Labelled an extension."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from xml.sax.saxutils import quoteattr

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions import geo
from roadlens.session import cut, drop_path, new_path, small

from .components import FEW, connected_components
from .unions import join_roots


def edges(links: DataFrame, a: str, b: str, weight: Column) -> DataFrame:
    """src, dst, weight: each pair of nodes once, with the sum of its weights."""
    return links.groupBy(F.col(a).alias("src"), F.col(b).alias("dst")).agg(weight.alias("weight"))


def degrees(edges_: DataFrame) -> DataFrame:
    """node, degree, weighted: partial sums are made before the shuffle, so a hub is no hot key."""
    ends = edges_.select(F.inline(F.array(F.struct(F.col("src").alias("node"), "weight"), F.struct(F.col("dst").alias("node"), "weight"))))
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted"))


def degree_centrality(edges_: DataFrame) -> DataFrame:
    """node, degree, centrality: degree / (nodes - 1)."""
    d = degrees(edges_)
    n = d.agg(F.count("*").alias("__n"))  # one row
    return d.join(F.broadcast(n)).select("node", "degree", F.when(F.col("__n") > 1, F.col("degree") / (F.col("__n") - 1)).otherwise(0.0).alias("centrality"))


def components(edges_: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """node, component: the smallest node that each node reaches; a node with loops only is a component of its own."""
    nodes = edges_.select(F.col(a).alias("node")).union(edges_.select(F.col(b).alias("node"))).distinct()
    found = connected_components(edges_, a, b)
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def largest_component(component_rows: DataFrame) -> DataFrame:
    """size: the number of nodes of the largest component; one row."""
    return component_rows.groupBy("component").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("size"))


def without(edges_: DataFrame, failed: DataFrame) -> DataFrame:
    """The edges that stand when nodes fail (a column node) or edges do (src and dst, either way round)."""
    if "node" in failed.columns:
        nodes = cut(failed.select("node").distinct())
        return reduce(lambda rows, end: rows.join(small(nodes.withColumnRenamed("node", end)), end, "left_anti"), ("src", "dst"), edges_)
    both = failed.select("src", "dst").union(failed.select("dst", "src"))
    return edges_.join(both, ["src", "dst"], "left_anti")


def failure(edges_: DataFrame, failed: DataFrame) -> DataFrame:
    """nodes_before, lcc_before, lcc_after, ratio: how much of the largest component is left when nodes fail (node) or edges do (src, dst).

    Edges may be repeated, and are read twice.
    """
    was, now = components(edges_), components(without(edges_, failed))
    counts = was.agg(F.count("*").alias("nodes_before"))
    out = counts.join(F.broadcast(largest_component(was).withColumnRenamed("size", "lcc_before"))).join(F.broadcast(largest_component(now).withColumnRenamed("size", "lcc_after")))
    return out.withColumn("ratio", F.when(F.col("lcc_before") > 0, F.col("lcc_after") / F.col("lcc_before")).otherwise(0.0))


def regions(on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """y, x and region (named by the number of its first pixel) of the set pixels of a mask; neighbours touch at sides or corners.

    Runs of a row are united with those they touch in the row above, so the work follows the runs and not how far a region winds.
    """
    y, x = np.nonzero(on)
    if not len(y):
        return y, x, y
    new = np.r_[True, (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)]
    run = np.cumsum(new) - 1
    first, last = np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:], len(y)] - 1
    number = np.full((on.shape[0] + 1, on.shape[1] + 2), -1)  # of the run at each pixel, with a border
    number[y + 1, x + 1] = run
    pairs = [(run[met], above[met]) for above in (number[y, x], number[y, x + 1], number[y, x + 2]) for met in [above >= 0]]
    label = join_roots(np.arange(len(first)), *(np.concatenate(side) for side in zip(*pairs)))
    return y, x, first[label[run]]


def pixel_components(masks: DataFrame, *keys: str, data: str = "data", width: str = "width") -> DataFrame:
    """keys, components, largest: 8-connected regions of masks held as arrays. A raster is labelled where it lies."""

    @F.pandas_udf("components long, largest long")
    def labelled(pixels: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for arrays, widths in pixels:
            rows = []
            for p, w in zip(arrays, widths):
                sizes = np.bincount(regions(np.asarray(p).reshape(-1, int(w)) > 0)[2])
                rows.append((int((sizes > 0).sum()), int(sizes.max(initial=0))))
            yield pd.DataFrame(rows, columns=["components", "largest"])

    return masks.withColumn("__m", labelled(data, width)).select(*keys, "__m.*")


def both_ways(edges_: DataFrame, weight: str | None = None, path: str | None = None) -> DataFrame:
    """src, dst, w: every edge but loops from either end, once, with the least of its weights (1 without). A weight that is no positive number is an error.

    Kept are edges one way round, in a cut table or, for rounds that look at them often, as columns in files at `path`.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    sound = F.when((w > 0) & (w < float("inf")), w).otherwise(F.raise_error(F.lit("a length has to be a positive number")).cast("double"))
    once = edges_.filter("src <> dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), sound.alias("w")).groupBy("a", "b").agg(F.min("w").alias("w"))
    if path is None:
        kept = cut(once)
    else:
        once.write.parquet(path)
        kept = edges_.sparkSession.read.schema(once.schema).parquet(path)
    return kept.select(F.inline(F.array(*[F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), "w") for a, b in (("a", "b"), ("b", "a"))])))


def _onward(front: DataFrame, both: DataFrame) -> DataFrame:
    """A cut front (seed, node, d) joined with the edges that leave it. A front of FEW rows goes to the edges, which then are not shuffled."""
    return small(front, FEW).join(both, F.col("node") == F.col("src"))


def distances(edges_: DataFrame, seeds: DataFrame) -> DataFrame:
    """seed, node, d: how many edges each node is from each seed that it can be reached from, by breadth-first joins.

    A round writes what it has reached, once. Neighbours of the last front are in it, in the one before or not yet reached,
    so a round looks at these two and not at all that was seen. Rounds go on until nothing new is reached, however far.
    There is a row for each seed and node reached; so seeds are to be few or dealt with in turn.
    """
    spark = edges_.sparkSession
    path, ends = new_path(spark, "distances"), new_path(spark, "edges")
    both = both_ways(edges_, path=ends)
    front, last, step = cut(seeds.select(F.col("node").alias("seed"), "node", F.lit(0).alias("d")).distinct()), None, 0
    front.write.parquet(path)
    while front.limit(1).count():
        step += 1
        onward = _onward(front, both).select("seed", F.col("dst").alias("node")).distinct()
        known = front if last is None else front.union(last)
        front, last = cut(onward.join(known, ["seed", "node"], "left_anti").withColumn("d", F.lit(step))), front
        front.write.mode("append").parquet(path)
    drop_path(spark, ends)
    return spark.read.schema(front.schema).parquet(path)


def _least(rows: list[DataFrame]) -> DataFrame:
    """seed, node and the least d of several tables."""
    return reduce(DataFrame.unionByName, rows).groupBy("seed", "node").agg(F.min("d").alias("d"))


def lengths(edges_: DataFrame, seeds: DataFrame, weight: str = "weight", step: float | None = None) -> DataFrame:
    """seed, node, d: the length of the shortest path from each seed to every node that it reaches (GR3).

    Distances are settled by ranges of `step` (the greatest weight, unless given). The nodes of the lowest range that is open
    are relaxed until none of it gets nearer, where only rows that changed are written and go on; then the range is
    written to the result. No edge leads further back than the greatest weight, so older ranges are not looked at again. An edge without a
    positive length is an error; of edges between the same nodes the shortest counts. Lengths are added as doubles.
    """
    spark = edges_.sparkSession
    path, ends = new_path(spark, "lengths"), new_path(spark, "edges")
    both = both_ways(edges_, weight, ends)
    longest = both.agg(F.max("w")).first()[0] or 1.0
    step = step or longest
    open_ = cut(seeds.select(F.col("node").alias("seed"), "node", F.lit(0.0).alias("d")).distinct())
    open_.limit(0).write.parquet(path)
    settled: list[tuple[float, DataFrame]] = []
    while (low := open_.agg(F.min("d")).first()[0]) is not None:
        limit = max((math.floor(low / step) + 1) * step, math.nextafter(low, math.inf))
        found, front = [open_], open_.filter(F.col("d") < limit)
        while True:
            reached = _onward(front, both).groupBy("seed", F.col("dst").alias("node")).agg(F.min(F.col("d") + F.col("w")).alias("d"))
            known = _least([*found, *(rows for _, rows in settled)]).withColumnRenamed("d", "old")
            nearer = cut(reached.join(known, ["seed", "node"], "left").filter("old is null or d < old").select("seed", "node", "d"))
            if not nearer.limit(1).count():
                break
            found.append(nearer)
            front = nearer.filter(F.col("d") < limit)
        now = cut(_least(found)) if len(found) > 1 else open_
        done, open_ = now.filter(F.col("d") < limit), now.filter(F.col("d") >= limit)
        done.write.mode("append").parquet(path)
        settled = [(end, rows) for end, rows in [*settled, (limit, done)] if end > limit - longest]
    drop_path(spark, ends)
    return spark.read.schema(open_.schema).parquet(path)


def closeness(edges_: DataFrame, seeds: DataFrame, weight: str | None = None) -> DataFrame:
    """node, reached, distance, closeness of the seeds given, in edges or by length; closeness is reached / distance, 0 for a node alone."""
    found = distances(edges_, seeds) if weight is None else lengths(edges_, seeds, weight)
    sums = found.groupBy("seed").agg((F.count("*") - 1).alias("reached"), F.sum("d").alias("distance"))
    return sums.select(F.col("seed").alias("node"), "reached", "distance", F.when(F.col("distance") > 0, F.col("reached") / F.col("distance")).otherwise(0.0).alias("closeness"))


def _summed(nodes: DataFrame, arcs: DataFrame) -> DataFrame:
    """seed, node, value of nodes (seed, node, own): its own value and those of all that have an arc (seed, src, dst) to it.

    Arcs make no circle. A round sends on the values of nodes that have all of theirs; others wait, with what they have got so far.
    """
    spark = nodes.sparkSession
    path = new_path(spark, "sums")
    to = arcs.groupBy("seed", F.col("dst").alias("node")).agg(F.count("*").alias("due"))
    known = nodes.join(to, ["seed", "node"], "left").select("seed", "node", "own", F.coalesce("due", F.lit(0)).alias("due"))
    known = cut(known)
    # an arc knows what its end waits for
    sent = cut(arcs.join(known.select("seed", F.col("node").alias("dst"), "own", "due"), ["seed", "dst"]))
    front = cut(known.filter("due = 0").select("seed", "node", F.col("own").alias("value")))
    front.write.parquet(path)
    waiting = None
    while front.limit(1).count():
        got = front.withColumnRenamed("node", "src").join(sent, ["seed", "src"]).select("seed", F.col("dst").alias("node"), "own", "due", "value", F.lit(1).cast("long").alias("got"))
        got = got if waiting is None else got.unionByName(waiting)
        now = cut(got.groupBy("seed", "node").agg(F.first("own").alias("own"), F.first("due").alias("due"), F.sum("value").alias("value"), F.sum("got").alias("got")))
        front, waiting = now.filter("got = due").select("seed", "node", (F.col("own") + F.col("value")).alias("value")), now.filter("got < due")
        front.write.mode("append").parquet(path)
    return spark.read.schema(front.schema).parquet(path)


def betweenness(edges_: DataFrame, seeds: DataFrame, weight: str | None = None) -> DataFrame:
    """node, betweenness: shares of shortest paths from the seeds that go through a node (Brandes, 2001), in edges or by length.

    Edges that lie on shortest paths are arcs away from the seed. Along them paths are counted; against them each node
    hands on (1 + what depends on it) / paths, which is 1 / paths and the sum of what it gets. With all nodes as seeds each
    unordered pair counts once (the sum is halved). Lengths tie if they are equal as doubles: give whole numbers where that
    matters. Tables hold a row for each seed and node reached, so seeds are to be few or dealt with in turn.
    """
    both = both_ways(edges_, weight)
    found = cut(distances(edges_, seeds) if weight is None else lengths(edges_, seeds, weight))
    near, far = (found.select("seed", F.col("node").alias(end), F.col("d").alias(f"d_{end}")) for end in ("src", "dst"))
    arcs = cut(near.join(both, "src").join(far, ["seed", "dst"]).filter(F.col("d_src") + F.col("w") == F.col("d_dst")).select("seed", "src", "dst"))
    paths = cut(_summed(found.select("seed", "node", F.when(F.col("seed") == F.col("node"), 1.0).otherwise(0.0).alias("own")), arcs).withColumnRenamed("value", "paths"))
    handed = _summed(paths.select("seed", "node", (1 / F.col("paths")).alias("own")), arcs.select("seed", F.col("dst").alias("src"), F.col("src").alias("dst")))
    due = paths.join(handed, ["seed", "node"]).withColumn("due", F.when(F.col("seed") == F.col("node"), 0.0).otherwise(F.col("paths") * F.col("value") - 1))
    return due.groupBy("node").agg((F.sum("due") / 2).alias("betweenness"))


def _steps(points: str, far: Callable[[Column, Column], Column]) -> Column:
    """The sum of far over neighbouring points."""
    each = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1), far)
    return F.aggregate(each, F.lit(0.0), lambda a, x: a + x)


def skeleton_graph(lines: DataFrame, *keys: str, references: DataFrame | None = None) -> DataFrame:
    """keys, src, dst, weight: centre lines (points: x, y) as edges between their ends, weighted by their length in pixels (GR2).

    references: keys, crs, transform of georeferenced rasters in EPSG:4326 or 3857, one row for each; the weights of their lines are metres on
    the ellipsoid, between the pixels' centres. Rasters in other systems, or without a reference, have no metres: their weight is null.
    A node is the place of its pixel, as y * 2^20 + x.
    """
    place = lambda p: p["y"].cast("long") * (1 << 20) + p["x"]
    if references is None:
        length = _steps("points", lambda a, b: F.sqrt(F.pow(a["x"] - b["x"], 2) + F.pow(a["y"] - b["y"], 2)))
    else:
        lines = lines.select(*keys, "points").join(references.select(*keys, F.col("crs").alias("__crs"), F.col("transform").alias("__t")), list(keys), "left")
        on_earth = lambda p: F.when(F.col("__crs") == "EPSG:3857", geo.from_mercator(p["x"], p["y"])).when(F.col("__crs") == "EPSG:4326", F.struct(p["x"].alias("lon"), p["y"].alias("lat")))
        lines = lines.withColumn("__map", F.transform("points", lambda p: geo.pixel_centre(F.col("__t"), p["x"], p["y"])))
        lines = lines.withColumn("__earth", F.transform("__map", on_earth))
        length = _steps("__earth", lambda a, b: geo.geodesic(a["lon"], a["lat"], b["lon"], b["lat"]))
    return lines.select(*keys, place(F.element_at("points", 1)).alias("src"), place(F.element_at("points", -1)).alias("dst"), length.alias("weight"))


def _xml(value: Column) -> Column:
    """Text as it may stand in XML: signs escaped, characters that XML has not left out."""
    plain = F.regexp_replace(value.cast("string"), r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]", "")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        plain = F.replace(plain, F.lit(sign), F.lit(name))
    return plain


#: The types of GraphML's keys.
XML_TYPES = {"string": "string", "double": "double", "float": "float", "int": "int", "bigint": "long", "boolean": "boolean"}


def graphml(edges_: DataFrame, by: str, nodes: DataFrame | None = None) -> DataFrame:
    """by, graphml: undirected graphs as GraphML text, one for each file that is to be written (by), whose size bounds a row (GR2).

    edges_: by, src, dst and attributes; nodes: by, node and attributes. Nodes that only edges name are declared too, without
    any. Attributes may be text, numbers or booleans; a null one is left out. Rows without both ends, or without a node, go. Nodes and edges are in order, so the same rows give the same text.
    """
    def data(df: DataFrame, known: set[str], short: str) -> tuple[str, Column]:
        names = [c for c in df.columns if c not in known]
        kinds = dict(df.dtypes)
        if wrong := [c for c in names if kinds[c] not in XML_TYPES]:
            raise ValueError(f"GraphML has no type for {', '.join(wrong)}")
        of = {"n": "node", "e": "edge"}[short]
        keys = "".join(f'<key id="{short}{k}" for="{of}" attr.name={quoteattr(c)} attr.type="{XML_TYPES[kinds[c]]}"/>' for k, c in enumerate(names))
        return keys, F.concat(F.lit(""), *[F.coalesce(F.concat(F.lit(f'<data key="{short}{k}">'), _xml(F.col(f"`{c}`")), F.lit("</data>")), F.lit("")) for k, c in enumerate(names)])

    edges_ = edges_.dropna(subset=["src", "dst"])
    edge_keys, edge_data = data(edges_, {by, "src", "dst"}, "e")
    named = edges_.select(by, F.inline(F.array(F.struct(F.col("src").alias("node")), F.struct(F.col("dst").alias("node"))))).withColumn("__d", F.lit(""))
    node_keys = ""
    if nodes is not None:
        node_keys, node_data = data(nodes, {by, "node"}, "n")
        named = named.unionByName(nodes.dropna(subset=["node"]).select(by, "node", node_data.alias("__d")))
    declared = named.groupBy(by, "node").agg(F.max("__d").alias("__d"))
    one = declared.select(by, F.lit(0).alias("k"), F.col("node").alias("a"), F.col("node").alias("b"), F.concat(F.lit('<node id="'), _xml(F.col("node")), F.lit('">'), F.col("__d"), F.lit("</node>")).alias("t"))
    two = edges_.select(by, F.lit(1).alias("k"), F.col("src").alias("a"), F.col("dst").alias("b"), F.concat(F.lit('<edge source="'), _xml(F.col("src")), F.lit('" target="'), _xml(F.col("dst")), F.lit('">'), edge_data, F.lit("</edge>")).alias("t"))
    texts = one.union(two).groupBy(by).agg(F.array_sort(F.collect_list(F.struct("k", "a", "b", "t"))).alias("__t"))
    head = f'<?xml version="1.0" encoding="UTF-8"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns">{node_keys}{edge_keys}<graph edgedefault="undirected">'
    return texts.select(by, F.concat(F.lit(head), F.concat_ws("", F.transform("__t", lambda r: r["t"])), F.lit("</graph></graphml>")).alias("graphml"))


def pruned(edges_: DataFrame, least: float) -> DataFrame:
    """The edges (src, dst, weight) of the components whose edges together weigh at least so much (GR1)."""
    named = edges_.join(components(edges_).withColumnRenamed("node", "src"), "src")
    heavy = cut(named.groupBy("component").agg(F.sum("weight").alias("__w")).filter(F.col("__w") >= least).select("component"))
    return named.join(heavy, "component", "left_semi").select(*edges_.columns)


def reachability(component_rows: DataFrame) -> DataFrame:
    """nodes, pairs, reachable: one row; reachable is the share of ordered pairs of different nodes that can reach each other."""
    sizes = component_rows.groupBy("component").agg(F.count("*").cast("double").alias("n"))
    out = sizes.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("nodes"), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0.0)).alias("pairs"))
    return out.select(F.col("nodes").cast("long").alias("nodes"), F.col("pairs").cast("long").alias("pairs"), F.when(F.col("nodes") > 1, F.col("pairs") / (F.col("nodes") * (F.col("nodes") - 1))).otherwise(0.0).alias("reachable"))


def resilience(edges_: DataFrame, failed: DataFrame, seeds: DataFrame, weight: str | None = None) -> DataFrame:
    """connectivity, reach, detour, index: what failing nodes or edges leave, one row (GR5; definitions of our own).

    connectivity: the largest component after, over that before. reach: reachable pairs after, over those before. detour:
    the mean distance, in edges or by length, from the seeds to what they still reach, over that before to the same nodes.
    index: the mean of connectivity, reach and 1 / detour.
    """
    rest = without(edges_, failed)
    was, now = components(edges_), components(rest)
    a, b = reachability(was).select(F.col("pairs").alias("p0")), reachability(now).select(F.col("pairs").alias("p1"))
    sizes = largest_component(was).withColumnRenamed("size", "l0").join(F.broadcast(largest_component(now).withColumnRenamed("size", "l1"))).join(F.broadcast(a)).join(F.broadcast(b))
    from_seeds = lambda e: distances(e, seeds) if weight is None else lengths(e, seeds, weight)
    known = from_seeds(edges_).withColumnRenamed("d", "d0").join(from_seeds(rest).withColumnRenamed("d", "d1"), ["seed", "node"])
    far = known.agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    over = lambda x, y: F.when(F.col(y) > 0, F.col(x) / F.col(y)).otherwise(F.lit(1.0))
    out = sizes.join(F.broadcast(far)).select(over("l1", "l0").alias("connectivity"), over("p1", "p0").alias("reach"), over("d1", "d0").alias("detour"))
    return out.withColumn("index", (F.col("connectivity") + F.col("reach") + 1 / F.col("detour")) / 3)
