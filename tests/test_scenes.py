"""Scenes in tiles against the same scenes as wholes."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import graphs, kernels, scenes


def tiles(spark, masks, side):
    rows = []
    for s, m in enumerate(masks):
        for r in range(0, m.shape[0], side):
            for c in range(0, m.shape[1], side):
                t = np.ascontiguousarray(m[r : r + side, c : c + side]).astype(np.uint8)
                rows.append((s, r // side, c // side, *t.shape, bytearray(t.tobytes()), "x"))
    return spark.createDataFrame(rows, "scene long, row int, col int, height int, width int, data binary, parts string")


def whole(rows, masks, side):
    out = [np.full(m.shape, 9) for m in masks]
    for t in rows:
        y, x = t["row"] * side, t["col"] * side
        out[t["scene"]][y : y + t["height"], x : x + t["width"]] = np.frombuffer(t["data"], np.uint8).reshape(t["height"], t["width"])
    return out


def drawn(rng, h, w):
    """Roads of several widths, rings and dots."""
    m, (y, x) = np.zeros((h, w), bool), np.indices((h, w))
    for _ in range(5):
        p, q, r = rng.uniform(0, (h, w)), rng.uniform(0, (h, w)), rng.uniform(0.5, 5)
        u = q - p
        t = np.clip(((y - p[0]) * u[0] + (x - p[1]) * u[1]) / (u @ u), 0, 1)
        m |= (y - p[0] - t * u[0]) ** 2 + (x - p[1] - t * u[1]) ** 2 <= r * r
    c = rng.uniform((8, 8), (h - 8, w - 8))
    m |= np.abs(np.hypot(y - c[0], x - c[1]) - 6) < 1.3
    return m | (rng.uniform(size=(h, w)) < 0.01)


def place(s, x, y):
    return (s << 42) | (y << 21) | x


def edges(masks):
    """src, dst, weight of whole skeletons."""
    out = Counter()
    for s, m in enumerate(masks):
        for chain in kernels.lines(m):
            a, b = sorted((place(s, *chain[0]), place(s, *chain[-1])))
            if len(chain) > 1:
                out[s, a, b, round(sum(np.hypot(p[0] - q[0], p[1] - q[1]) for p, q in zip(chain, chain[1:])), 6)] += 1
    return out


@pytest.mark.parametrize("side, rim", [(8, 16), (13, 2), (40, 16)])
def test_tiles_are_their_scene(spark, side, rim):
    rng = np.random.default_rng(side)
    loop = np.zeros((20, 37), bool)
    loop[3:16, 5:30], loop[4:15, 6:29] = True, False  # a closed line that no junction ends
    loop[18, 0:37] = True
    masks = [drawn(rng, 41, 53), drawn(rng, 24, 24), loop, np.ones((30, 30), bool), np.zeros((9, 9), bool)]
    given = tiles(spark, masks, side)
    thin = scenes.thinned(given, side, rim)
    for got, m in zip(whole(thin.collect(), masks, side), masks):
        assert np.array_equal(got, kernels.thinned(m))
    skeletons = [kernels.thinned(m) for m in masks]
    rows = scenes.road_graph(thin, side).collect()
    assert Counter((r["scene"], r["src"], r["dst"], round(r["weight"], 6)) for r in rows) == edges(skeletons)
    sizes = Counter((s, int(n)) for s, m in enumerate(masks) for n in np.bincount(graphs.regions(m)[2]) if n)
    assert Counter((r["scene"], r["pixels"]) for r in scenes.regions(given, side).collect()) == sizes


def test_noise_missing_tiles_and_empty_tables(spark):
    """Lines that wind over corners; what is missing is empty."""
    rng = np.random.default_rng(5)
    masks = [rng.uniform(size=(27, 31)) < share for share in (0.2, 0.35, 0.6)]
    for side in (5, 8):
        given = tiles(spark, masks, side)
        assert Counter((r["scene"], r["src"], r["dst"], round(r["weight"], 6)) for r in scenes.road_graph(given, side).collect()) == edges(masks)
    sizes = Counter((s, int(n)) for s, m in enumerate(masks) for n in np.bincount(graphs.regions(m)[2]) if n)
    assert Counter((r["scene"], r["pixels"]) for r in scenes.regions(given, 8).collect()) == sizes
    masks[0][8:16, 8:16] = False
    left = given.filter("not (row = 1 and col = 1)").filter("scene = 0")
    assert Counter(r["pixels"] for r in scenes.regions(left, 8).collect()) == Counter(int(n) for n in np.bincount(graphs.regions(masks[0])[2]) if n)
    none = given.limit(0)
    assert scenes.regions(none, 8).count() == scenes.road_graph(none, 8).count() == scenes.thinned(none, 8).count() == 0


def test_scenes_out_of_range_and_places(spark):
    bad = spark.createDataFrame([(1 << 21, 0, 0, 1, 1, bytearray(b"\1"))], "scene long, row int, col int, height int, width int, data binary")
    with pytest.raises(Exception, match="has to be numbered"):
        scenes.regions(bad, 8).collect()
    with pytest.raises(ValueError):
        scenes.thinned(bad, 1)
    at = spark.createDataFrame([(place(77, 5, 9),)], "p long").select(scenes.ends_of(F.col("p")).alias("e")).first()["e"]
    assert (at["scene"], at["x"], at["y"]) == (77, 5, 9)
