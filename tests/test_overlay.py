"""Flood zones over edges against a comparison of every edge with every zone."""

import numpy as np
import pytest

from roadlens.operators import graphs, overlay


def turn(a, b, c):
    return float(np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])))


def touch(a, b, c, d):
    boxes = all(max(a[k], b[k]) >= min(c[k], d[k]) and max(c[k], d[k]) >= min(a[k], b[k]) for k in (0, 1))
    return boxes and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0


def hit(edge, ring):
    a, b = edge[2:4], edge[4:6]
    pairs = [(p, q) for p, q in zip(ring, ring[1:] + ring[:1]) if p != q]
    odd = sum((p[1] > a[1]) != (q[1] > a[1]) and a[0] < (q[0] - p[0]) * (a[1] - p[1]) / (q[1] - p[1]) + p[0] for p, q in pairs) % 2
    return any(touch(a, b, p, q) for p, q in pairs) or odd == 1


def frames(spark, edges, zones):
    e = spark.createDataFrame(edges, "src long, dst long, x1 double, y1 double, x2 double, y2 double")
    return e, spark.createDataFrame([(z, [{"x": x, "y": y} for x, y in ring]) for z, ring in zones], "zone string, points array<struct<x: double, y: double>>")


@pytest.mark.parametrize("whole, size", [(True, 1.0), (True, 3.0), (False, 2.5), (False, 40.0)])
def test_all_pairs(spark, whole, size):
    """Whole coordinates lie on the grid's lines, on corners and on each other."""
    rng = np.random.default_rng(int(size * 10))
    draw = (lambda n: rng.integers(-12, 13, (n, 2)).astype(float)) if whole else (lambda n: rng.uniform(-12, 12, (n, 2)))
    edges = []
    for k in range(250):
        a, step = draw(1)[0], draw(1)[0] / (1 if k % 5 == 0 else 6)
        b = a + (np.round(step) if whole else step)
        edges.append((k, k + 1000, *map(float, (*a, *b))))
    zones = [(f"z{k}", [tuple(map(float, p)) for p in draw(int(n))]) for k, n in enumerate(rng.integers(1, 9, 12))]
    zones += [("all", [(-50.0, -50.0), (50.0, -50.0), (50.0, 50.0), (-50.0, 50.0)]), ("closed", [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0), (0.0, 0.0)])]
    got = {(r["src"], r["dst"], r["zone"]) for r in overlay.flooded(*frames(spark, edges, zones), size).collect()}
    assert got == {(e[0], e[1], z) for e in edges for z, ring in zones if hit(e, ring)}
    assert {z for _, _, z in got} >= {"all", "closed"}


def test_odd_rows_and_what_a_flood_leaves(spark):
    edges, zones = frames(spark, [(1, 2, 0.0, 0.0, 1.0, 0.0), (2, 3, 1.0, 0.0, 2.0, 0.0), (3, 4, 2.0, 0.0, 3.0, 0.0), (4, 5, None, 0.0, 3.0, 0.0), (9, 9, 1.5, 0.2, 1.5, 0.2)], [("a", [(1.4, -1.0), (1.6, -1.0), (1.6, 1.0), (1.4, 1.0)]), ("none", [])])
    out = overlay.flooded(edges, zones, 1.0)
    assert sorted(tuple(r) for r in out.collect()) == [(2, 3, "a"), (9, 9, "a")]
    left = graphs.failure(edges.select("src", "dst"), out.select("src", "dst")).first()
    assert (left["lcc_before"], left["lcc_after"]) == (5, 3)
    assert overlay.flooded(edges.limit(0), zones, 1.0).count() == overlay.flooded(edges, zones.limit(0), 1.0).count() == 0


def test_places_are_looked_at_once_and_pairs_are_spelt_out_last(spark, monkeypatch):
    """Copies of an edge and of a zone; an edge with two places and a zone of two rings are named once for each other."""
    box = lambda x: [(x, 0.0), (x + 2.0, 0.0), (x + 2.0, 2.0), (x, 2.0)]
    edges = [(k, -k, 0.5, 0.5, 1.5, 0.5) for k in range(40)] + [(3, -3, 0.5, 0.5, 1.5, 0.5), (7, -7, 5.5, 0.5, 6.0, 0.5), (90, 91, 5.5, 0.5, 6.0, 0.5), (92, 93, 50.0, 0.0, 51.0, 0.0)]
    zones = [(f"z{k}", box(0.0)) for k in range(30)] + [("z5", box(5.0)), ("z6", box(5.0)), ("z6", box(5.0)), (None, box(5.0))]
    seen = []
    meetings = overlay._meetings
    monkeypatch.setattr(overlay, "_meetings", lambda roads, rings, size: seen.append((roads.count(), rings.count())) or meetings(roads, rings, size))
    monkeypatch.setattr(overlay, "LIST", 7)
    got = [(r["src"], r["dst"], r["zone"]) for r in overlay.flooded(*frames(spark, edges, zones), 1.0).collect()]
    assert seen == [(3, 2)]
    assert len(got) == len(set(got))
    assert set(got) == {(e[0], e[1], z) for e in edges for z, ring in zones if hit(e, ring)}
