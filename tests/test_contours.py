"""Borders of masks against brute force, and the features that are made of them."""

import json

import re

import numpy as np
import pytest

from roadlens.operators import kernels, occlusion, vectors


def regions(cells, steps):
    """cell -> the smallest cell of its region."""
    out = {}
    for start in sorted(cells):
        if start in out:
            continue
        todo, out[start] = [start], start
        while todo:
            y, x = todo.pop()
            for dy, dx in steps:
                p = (y + dy, x + dx)
                if p in cells and p not in out:
                    out[p] = start
                    todo.append(p)
    return out


SIDES = [(0, 1), (1, 0), (0, -1), (-1, 0)]
ALL = SIDES + [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def brute(m):
    """Sorted (hole, set of points): one border for each region and each stretch of background that touches it at a side."""
    h, w = m.shape
    on = {(int(y), int(x)) for y, x in np.argwhere(m)}
    off = {(y, x) for y in range(-1, h + 1) for x in range(-1, w + 1)} - on
    of, around = regions(on, ALL), regions(off, SIDES)
    met = {}
    for y, x in on:
        for dy, dx in SIDES:
            if (y + dy, x + dx) in off:
                met.setdefault((of[y, x], around[y + dy, x + dx]), set()).add((x, y))
    # a region's outer border is with what surrounds it, which reaches further up than the region does
    return sorted((around_ > region, sorted(points)) for (region, around_), points in met.items())


def checked(m):
    found = kernels.contours(m)
    assert sorted((hole, sorted(set(points))) for hole, points in found) == brute(m)
    for _, points in found:
        steps = [(abs(b[0] - a[0]), abs(b[1] - a[1])) for a, b in zip(points, points[1:] + points[:1])]
        assert len(points) == 1 or all(max(s) == 1 for s in steps)  # closed, each point a neighbour of the next


def test_all_masks_of_4_by_4():
    for k in range(1 << 16):
        checked(np.array([k >> b & 1 for b in range(16)]).reshape(4, 4))


def test_random_masks():
    rng = np.random.default_rng(1)
    for k in range(300):
        checked(rng.random((rng.integers(1, 20), rng.integers(1, 20))) < (0.2, 0.5, 0.8)[k % 3])


def test_known_borders():
    square = np.ones((3, 3), int)
    assert kernels.contours(square) == [(False, [(0, 0), (0, 1), (0, 2), (1, 2), (2, 2), (2, 1), (2, 0), (1, 0)])]
    square[1, 1] = 0
    assert [hole for hole, _ in kernels.contours(square)] == [False, True] and len(kernels.contours(square)[1][1]) == 4
    assert kernels.contours(np.ones((1, 3))) == [(False, [(0, 0), (1, 0), (2, 0), (1, 0)])]
    assert kernels.contours(np.ones((1, 1))) == [(False, [(0, 0)])] and kernels.contours(np.zeros((2, 2))) == []


@pytest.mark.parametrize("as_bytes", [True, False])
def test_contours_of_tables(spark, as_bytes):
    m = np.zeros((8, 10), np.uint8)
    m[1:6, 1:6], m[3, 3], m[0, 9], m[7, :4] = 1, 0, 1, 1
    rows = [("a", bytearray(m.tobytes()) if as_bytes else m.ravel().tolist(), 10), ("b", None, 10), ("c", bytearray(10) if as_bytes else [0] * 10, 10)]
    df = spark.createDataFrame(rows, f"id string, data {'binary' if as_bytes else 'array<int>'}, width int")
    out = occlusion.contours(df, "id").orderBy("line").collect()
    points = [[tuple(p) for p in r["points"]] for r in out]
    assert [(r["id"], r["line"], r["hole"]) for r in out] == [("a", 0, False), ("a", 1, True), ("a", 2, False)]  # the single pixel goes
    assert points == [[(1, 1), (1, 5), (5, 5), (5, 1)], [(2, 3), (3, 2), (4, 3), (3, 4)], [(0, 7), (3, 7)]]
    assert occlusion.contours(df, "id", least=1).count() == 4
    line = occlusion.contours(df, "id", thin=True).collect()
    assert len(line) >= 2 and all(len(r["points"]) >= 2 for r in line)
    features = [json.loads(r[0]) for r in spark.createDataFrame(out).select(vectors.feature("points")).collect()]
    assert [f["geometry"]["type"] for f in features] == ["LineString"] * 3


def test_borders_are_handed_over_as_arrays_of_numbers(spark):
    """Not as Python objects for each point: the function that follows them is one on Arrow arrays. Null, empty and byte masks too."""
    from pyspark.util import PythonEvalType

    from roadlens.operators import occlusion

    masks = [(0, [1.0] * 9, 3), (1, None, 3), (2, [0.0] * 4, 2), (3, [0.0, 1.0, None, 0.0], 2)]
    df = spark.createDataFrame(masks, "id long, data array<double>, width int").withColumn("b", occlusion.borders("data", "width"))
    assert PythonEvalType.SQL_SCALAR_ARROW_UDF in [int(n) for n in re.findall(r"\], (\d+)", df._jdf.queryExecution().executedPlan().toString())]
    got = {r["id"]: [(b["hole"], [tuple(p) for p in b["points"]]) for b in r["b"]] for r in df.collect()}
    assert got[1] == got[2] == [] and got[3] == [(False, [(1, 0)])]
    assert [hole for hole, _ in got[0]] == [False] and len(got[0][0][1]) == 8
    stored = spark.createDataFrame([(bytearray([0, 1, 0, 0]), 2)], "data binary, width int").select(occlusion.borders("data", "width").alias("b")).first()["b"]
    assert [(b["hole"], [tuple(p) for p in b["points"]]) for b in stored] == [(False, [(1, 0)])]
