"""Graphs beyond components, training rows, sinks and small functions, against plain Python."""

import json
from collections import deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.errors import LeakageError
from roadlens.functions import text
from roadlens.operators import graphs, occlusion, splits, training, vectors
from roadlens.plans import catalogue
from roadlens.sources import tables, vector_files

SF_SMALL = "/root/testdata/sf0.001"
ROADS = [(1, 2), (2, 3), (3, 4), (4, 5), (2, 6), (6, 4), (5, 7), (8, 9)]


def graph(spark, pairs=ROADS):
    return spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src long, dst long, weight double")


def nodes(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "node long")


def brandes(pairs, seeds):
    near: dict = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    total = {n: 0.0 for n in near}
    for s in seeds:
        d, paths, order, queue = {s: 0}, {s: 1}, [], deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in d:
                    d[w] = d[v] + 1
                    queue.append(w)
                if d[w] == d[v] + 1:
                    paths[w] = paths.get(w, 0) + paths[v]
        due = dict.fromkeys(d, 0.0)
        for w in reversed(order):
            for v in near[w]:
                if d.get(v) == d[w] - 1:
                    due[v] += paths[v] / paths[w] * (1 + due[w])
            if w != s:
                total[w] += due[w] / 2
    return total


def test_betweenness(spark):
    got = {r["node"]: r["betweenness"] for r in graphs.betweenness(graph(spark), nodes(spark, *range(1, 10))).collect()}
    assert got == pytest.approx(brandes(ROADS, range(1, 10)))


def test_what_failures_leave(spark):
    out = graphs.failure(graph(spark), spark.createDataFrame([(5, 4)], "src long, dst long")).first()
    assert (out["nodes_before"], out["lcc_before"], out["lcc_after"]) == (9, 7, 5)
    r = graphs.resilience(graph(spark), nodes(spark, 3), nodes(spark, 1)).first()
    # without node 3 all others still reach each other, on ways of equal length
    assert (r["connectivity"], r["reach"], r["detour"]) == (6 / 7, 32 / 44, 1.0)
    longer = graphs.resilience(graph(spark, [(1, 2), (2, 3), (3, 4), (4, 1)]), spark.createDataFrame([(1, 2)], "src long, dst long"), nodes(spark, 1)).first()
    assert (longer["connectivity"], longer["reach"], longer["detour"]) == (1.0, 1.0, 6 / 4)
    assert graphs.reachability(graphs.components(graph(spark))).first()["pairs"] == 44


def test_skeletons_become_graphs_and_are_pruned(spark):
    m = np.zeros((20, 20), int)
    m[4, 2:18] = 1
    m[10, 3:6] = 1
    lines = occlusion.centre_lines(spark.createDataFrame([("a", m.ravel().tolist(), 20)], "id string, data array<int>, width int"), "id")
    edges = graphs.skeleton_graph(lines, "id")
    assert sorted((r["src"] % (1 << 20), r["src"] >> 20, r["dst"] % (1 << 20), r["weight"]) for r in edges.collect()) == [(2, 4, 17, 15.0), (3, 10, 5, 2.0)]
    assert [r["weight"] for r in graphs.pruned(edges.drop("id"), 5.0).collect()] == [15.0]


def naive_thinned(mask):
    """Zhang and Suen, pixel by pixel."""
    h, w = mask.shape
    at = lambda m, y, x: int(0 <= y < h and 0 <= x < w and m[y, x])
    m, changed = (mask > 0).astype(int), True
    while changed:
        changed = False
        for first in (True, False):
            gone = []
            for y in range(h):
                for x in range(w):
                    p = [at(m, y + a, x + b) for a, b in ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))]
                    rises = sum(p[k] == 0 and p[(k + 1) % 8] == 1 for k in range(8))
                    n, e, s, v = p[0], p[2], p[4], p[6]
                    free = n * e * s == 0 and e * s * v == 0 if first else n * e * v == 0 and n * s * v == 0
                    if m[y, x] and 2 <= sum(p) <= 6 and rises == 1 and free:
                        gone.append((y, x))
            for y, x in gone:
                m[y, x], changed = 0, True
    return m


def test_skeleton_nodes_of_the_whole_table(spark):
    data = {r["vec_id"]: np.array(r["embedding"]).reshape(8, 8) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    got = {r["vec_id"]: (r["pixels"], r["endpoints"], r["junctions"]) for r in catalogue.QUERIES["q_skeleton_nodes"](spark, SF_SMALL).collect()}
    assert set(got) == set(data)
    for i, x in data.items():
        s = naive_thinned(x)
        around = {(y, v): sum(s[a, b] for a in range(max(0, y - 1), min(8, y + 2)) for b in range(max(0, v - 1), min(8, v + 2))) - 1 for y, v in zip(*np.nonzero(s))}
        assert got[i] == (s.sum(), sum(n == 1 for n in around.values()), sum(n > 2 for n in around.values()))


def test_training_rows_are_drawn_by_epoch(spark):
    rng = np.random.default_rng(0)
    mask = np.zeros((32, 32), np.uint8)
    mask[8:16] = 255
    rows = [(f"t{i}", 32, 32, bytearray(rng.integers(0, 256, (32, 32, 3), dtype=np.uint8).tobytes()), bytearray(mask.tobytes()) if i else None) for i in range(9)]
    df = spark.createDataFrame(rows, "tile_id string, height int, width int, rgb binary, mask binary")
    a, b, c, plain = ({r["tile_id"]: (r["rgb"], r["mask"]) for r in training.training_rows(d, e, p, {}).collect()} for d, e, p in ((df, 0, 0.5), (df.repartition(3), 0, 0.5), (df, 1, 0.5), (df, 0, -1.0)))
    assert a == b != c and len(a) == 8
    assert plain == {r[0]: (bytes(r[3]), bytes(r[4])) for r in rows[1:]} and 0 < sum(a[k] != plain[k] for k in a) < 8
    assert all(m == mask.tobytes() for _, m in a.values())


def test_lines_in_map_coordinates(spark):
    lines = spark.createDataFrame([("a", 0, [(0, 0), (2, 1)]), ("b", 0, [(0, 0), (1, 1)])], "id string, line int, points array<struct<x: int, y: int>>")
    known = spark.createDataFrame([("a", "EPSG:3857", (2.0, 0.0, 100.0, 0.0, -3.0, 200.0))], "id string, crs string, transform struct<a: double, b: double, c: double, d: double, e: double, f: double>")
    out = {r["id"]: json.loads(r["feature"]) for r in vectors.map_features(lines, "id", references=known).collect()}
    assert out["a"]["geometry"]["coordinates"] == [[101.0, 198.5], [105.0, 195.5]] and out["a"]["properties"]["crs"] == "EPSG:3857"
    assert out["b"]["geometry"]["coordinates"] == [[0.0, 0.0], [1.0, 1.0]] and out["b"]["properties"]["crs"] == "pixel"


def test_one_mask_of_a_folder_of_lines(spark, tmp_path):
    for k, line in enumerate(([[0, 0], [0, 10]], [[0, 5], [10, 5]])):
        (tmp_path / f"{k}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "LineString", "coordinates": line}}]}))
    on = {(r["x"], r["y"]) for r in vector_files.mask_of(spark, str(tmp_path), 10, 10, 0.6).collect()}
    assert {(0, y) for y in range(10)} <= on and {(x, 4) for x in range(10)} | {(x, 5) for x in range(10)} <= on and (5, 0) not in on and (9, 9) not in on


def test_splits_that_share_tiles_are_refused(spark):
    df = spark.createDataFrame([("a", "train"), ("b", "val"), ("c", "test")], "tile_id string, split string")
    assert splits.verified(df, "tile_id") is df
    with pytest.raises(LeakageError, match="train_val: 1"):
        splits.verified(df.union(spark.createDataFrame([("a", "val")], df.schema)), "tile_id")


def test_split_tables_and_their_metadata(spark, tmp_path):
    rows = [(f"t{i}", "s" if i % 2 else "u", f"i{i}", f"p{i}", None, 1.23456, 2.0, 0, i, ("train", "val")[i % 3 == 0]) for i in range(6)]
    df = spark.createDataFrame(rows, "tile_id string, source_dataset string, source_image_id string, image_tile_path string, mask_tile_path string, road_pixel_pct double, image_std double, row int, col int, split string")
    tables.write_splits(df, str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "tiles"))
    assert back.count() == 6 and {r["road_pixel_pct"] for r in back.collect()} == {"1.2346"} and back.filter("split = 'val'").count() == 2
    meta = tables.read_json(spark, str(tmp_path / "split_metadata")).first().asDict(True)
    assert meta["counts"] == {"train": 4, "val": 2, "test": 0, "total": 6} and meta["source_distribution"]["val"] == {"s": 1, "u": 1} and meta["random_seed"] == 42


def test_history_grows(spark, tmp_path):
    for epoch in (1, 2):
        tables.append_history(spark, [{"epoch": epoch, "train_loss": 0.5, "val_loss": None, "val_dice": 0.1, "val_iou": 0.1, "val_precision": 0.1, "val_recall": 0.1, "learning_rate": 0.001}], str(tmp_path / "h"))
    assert [r["epoch"] for r in tables.read_history(spark, str(tmp_path / "h")).orderBy("epoch").collect()] == [1, 2]


def test_clocks_and_experiments(spark):
    assert [r[0] for r in spark.createDataFrame([(0.0,), (3661.9,), (86400.0 + 59,)], "s double").select(text.clock(F.col("s"))).collect()] == ["00:00:00", "01:01:01", "00:00:59"]
    name = lambda *n: tables.next_experiment(spark.createDataFrame([(x,) for x in n], "name string")).first()["name"]
    assert (name(), name("experiment_007", "experiment_x", "other_900"), name("experiment_999")) == ("experiment_001", "experiment_008", "experiment_1000")
