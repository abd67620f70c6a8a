"""Nearest segments against a comparison of every point with every segment."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.operators import nearest

SEGMENTS = "way long, x1 double, y1 double, x2 double, y2 double"


def apart(p, s):
    (x1, y1, x2, y2), u = s, (s[2] - s[0], s[3] - s[1])
    square = u[0] * u[0] + u[1] * u[1]
    v = (p[0] - x1, p[1] - y1)
    t = min(max((v[0] * u[0] + v[1] * u[1]) / square, 0.0), 1.0) if square > 0 else 0.0
    d = (v[0] - t * u[0], v[1] - t * u[1])
    return d[0] * d[0] + d[1] * d[1]


def brute(points, segments):
    return {p: min((apart(p, s[1:]), s[0]) for s in segments) for p in points}


def found(spark, points, segments, size):
    got = nearest.nearest(spark.createDataFrame(points, "px double, py double"), spark.createDataFrame(segments, SEGMENTS), size).collect()
    assert len({(r["px"], r["py"]) for r in got}) == len(got)
    return {(r["px"], r["py"]): (r["d"], r["way"]) for r in got}


@pytest.mark.parametrize("whole, size", [(True, 1.0), (True, 4.0), (False, 1.5), (False, 90.0)])
def test_all_pairs(spark, whole, size):
    """Near points, far ones and segments on the grid's lines; whole coordinates make many ties."""
    rng = np.random.default_rng(int(size * 10))
    spot = (lambda n, r: rng.integers(-r, r + 1, (n, 2)).astype(float)) if whole else (lambda n, r: rng.uniform(-r, r, (n, 2)))
    points = [tuple(map(float, p)) for p in np.r_[spot(120, 20), spot(25, 400), spot(5, 30) + 3000.0]]
    starts = spot(50, 25)
    steps = spot(50, 6) * (rng.uniform(size=(50, 1)) < 0.9)
    segments = [(int(k) % 37, *map(float, (*a, *(a + b)))) for k, (a, b) in enumerate(zip(starts, steps))]
    segments += segments[:5]
    got, want = found(spark, points + points[:9], segments, size), brute(points, segments)
    assert got.keys() == want.keys()
    assert {p: w for p, (_, w) in got.items()} == {p: w for p, (_, w) in want.items()}
    assert all(d * d == pytest.approx(want[p][0], rel=1e-12, abs=1e-18) for p, (d, _) in got.items())


def test_one_segment_far_away_and_a_ring_of_equals(spark):
    assert found(spark, [(0.0, 0.0)], [(7, 1e6, 3.0, 1e6, 9.0)], 1.0) == {(0.0, 0.0): (pytest.approx(np.hypot(1e6, 3)), 7)}
    ring = [(k + 5, 30 * float(np.cos(a)), 30 * float(np.sin(a)), 30 * float(np.cos(a)), 30 * float(np.sin(a))) for k, a in enumerate(np.linspace(0, 6.2, 40))] + [(3, 30.0, 0.0, 30.0, 0.0)]
    assert found(spark, [(0.0, 0.0)], ring, 1.0)[0.0, 0.0] == (pytest.approx(30.0), brute([(0.0, 0.0)], ring)[0.0, 0.0][1])


def test_odd_rows_and_attributes(spark):
    nan = float("nan")
    assert found(spark, [(0.0, 0.0)], [], 1.0) == {} == found(spark, [], [(1, 0.0, 0.0, 1.0, 1.0)], 1.0)
    assert found(spark, [(None, 0.0), (nan, 1.0), (-0.0, 2.0)], [(None, 0.0, 0.0, 0.0, 0.0), (1, nan, 0.0, 1.0, 1.0), (2, 0.0, 5.0, 1.0, 5.0)], 1.0) == {(0.0, 2.0): (3.0, 2)}
    edges = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 0.0, "a"), (1, 0.0, 0.0, 2.0, 0.0, "a"), (2, 0.0, 50.0, 2.0, 50.0, "b"), (3, None, 0.0, 2.0, 0.0, "c")], "src long, x1 double, y1 double, x2 double, y2 double, name string")
    points = "way_id long, highway string, name string, points array<struct<x: double, y: double>>"
    ways = spark.createDataFrame([(9, "primary", "Long Road", [(-5.0, 1.0), (0.0, 1.0), (9.0, 1.0)]), (9, "tertiary", "", []), (8, "road", "", [(1.0, 60.0)]), (7, "road", "x", None)], points)
    out = nearest.enriched(edges, ways, 2.0, reach=5.0)
    assert out.columns == ["src", "x1", "y1", "x2", "y2", "way_id", "highway", "name", "way_distance"]
    rows = sorted(tuple(r)[0:1] + tuple(r)[5:] for r in out.filter("src < 3").collect())
    assert rows == [(1, 9, "primary", "Long Road", 1.0)] * 2 + [(2, None, None, None, None)]
    assert out.filter("src = 3").select("way_id").collect() == [(None,)]
    assert nearest.enriched(edges, ways, 2.0).filter("src = 2").first()["way_distance"] == 10.0
    assert nearest.enriched(edges, ways.limit(0), 2.0).filter(F.col("way_id").isNull()).count() == 4
    assert nearest.enriched(edges.limit(0), ways, 2.0).count() == 0


def test_no_sort_of_all_distances(spark):
    """Of ways as near the least counts, and the distances go into hash tables: an aggregation that sorts holds every pair."""
    from roadlens.session import cut

    cells = cut(spark.createDataFrame([(0.0, 0.0, 0, 0), (0.0, 0.0, 1, 0), (5.0, 5.0, 1, 0)], "px double, py double, cx long, cy long"))
    lines = cut(spark.createDataFrame([(w, x, 1.0, x, 1.0, c, 0) for w, x, c in ((9, 0.0, 0), (4, 0.0, 1), (7, 0.0, 0), (1, 3.0, 1))], "way long, x1 double, y1 double, x2 double, y2 double, cx long, cy long"))
    out = nearest._best(cells, lines)
    assert {tuple(r) for r in out.collect()} == {(0.0, 0.0, 4, 1.0), (5.0, 5.0, 1, 20.0**0.5)}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
