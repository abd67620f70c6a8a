"""Edge cases of the engine's operators, against NumPy or plain Python."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.errors import RatioError
from roadlens.functions import geo, numbers, raster, text
from roadlens.operators import graphs, kernels, master, metrics, occlusion, splits, stats, tiling, vectors


def first(df):
    return df.first().asDict()


def test_names_and_sizes(spark):
    df = spark.createDataFrame([("a/b_sat.JPG", 1536, "x_r0x1_c00z"), ("noext", 0, "s_9_r003_c012"), (".hidden", None, None), ("a.tar.gz", 5 * 1024**5, "r")], "p string, n long, t string")
    out = [r.asDict() for r in df.select(text.stem(F.col("p")).alias("s"), text.extension(F.col("p")).alias("e"), text.image_id(F.col("p")).alias("i"), text.human_size(F.col("n")).alias("h"), text.index_in(F.col("t"), "r", 2).alias("r"), text.index_in(F.col("t"), "c", 1).alias("c")).collect()]
    assert [o["s"] for o in out] == ["b_sat", "noext", ".hidden", "a.tar"]
    assert [o["e"] for o in out] == [".jpg", "", "", ".gz"]
    assert out[0]["i"] == "b"
    assert [o["h"] for o in out] == ["1.5 KB", "0.0 B", None, "5.0 PB"]
    assert [(o["r"], o["c"]) for o in out] == [(0, 0), (3, 12), (0, 0), (0, 0)]


def test_sizes_round_as_python_prints_them(spark):
    sizes = [1280, 1792, 1177, 1126, 1023, 1024, 1048575, 1048576, 157286, 9 * 1024**4 // 4, 11 * 1024**4 // 4, 3 * 10**15, 5 * 1024**5, 2**62, *range(1000, 3000, 7)]
    near = [x for k in range(10) for half in [(2 * k + 1) / 20] for x in (half, float(np.nextafter(half, 0)), float(np.nextafter(half, 1)), 3 + half)] + [0.96, -1.25, 99.95, 1e15]

    def ladder(n, units):
        for u in units[:-1]:
            if n < 1024:
                return f"{n:.1f} {u}"
            n /= 1024
        return f"{n:.1f} {units[-1]}"

    for units in (text.UNITS, text.UNITS[:5]):
        got = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", text.human_size(F.col("n"), units).alias("h")).collect()
        assert [r["h"] for r in got] == [ladder(r["n"], units) for r in got]
    got = spark.createDataFrame([(x,) for x in near], "x double").select("x", text.one_decimal(F.col("x")).alias("h")).collect()
    assert [r["h"] for r in got] == [f"{r['x']:.1f}" for r in got]


def test_format_bytes_agrees_with_sql_beyond_terabytes_and_longs(spark, tmp_path):
    import duckdb

    from roadlens.plans import record_queries, registry

    spark.range(64).selectExpr("id * 10000000 doc_id", "id % 5 + 16 n_chars", "id % 3 source", "id % 2 lang").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in record_queries.q_format_bytes(spark, str(tmp_path)).collect()}
    want = duckdb.sql(registry.ORACLES["q_format_bytes"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")).fetchall()
    assert got == set(want) and any(len(size) > 10 for _, _, size in got)


def test_reflection_is_numpys(spark):
    for n, to in itertools.product(range(1, 8), (8, 13)):
        got = first(spark.range(1).select(F.transform(raster.indices(F.lit(to)), lambda i: raster.reflected(i, F.lit(n))).alias("x")))["x"]
        assert list(got) == np.pad(np.arange(n), (0, to - n), mode="reflect").tolist() if n > 1 else set(got) == {0}


@pytest.mark.parametrize("h,w", [(4, 4), (5, 7), (3, 9), (1, 1)])
def test_windows_of_padded_rasters(spark, h, w):
    x = np.random.default_rng(h * 10 + w).normal(size=(h, w))
    df = spark.createDataFrame([(1, x.ravel().tolist())], "id long, data array<double>")
    got = {(r["row"], r["col"]): np.array(r["window"]).reshape(4, 4) for r in tiling.windows(df, h, w, 4, 2).collect()}
    size = lambda n: 4 if n <= 4 else 4 + -(-(n - 4) // 2) * 2
    full = np.pad(x, ((0, size(h) - h), (0, size(w) - w)), mode="reflect" if min(h, w) > 1 else "edge")
    want = {(i, j): full[2 * i : 2 * i + 4, 2 * j : 2 * j + 4] for i in range((size(h) - 4) // 2 + 1) for j in range((size(w) - 4) // 2 + 1)}
    assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)


def test_turns_of_oblong_rasters(spark):
    x = np.arange(12.0).reshape(3, 4)
    out = first(spark.createDataFrame([(x.ravel().tolist(),)], "d array<double>").select(raster.turned(F.col("d"), 3, 4).alias("t"), raster.flipped_across(F.col("d"), 3, 4).alias("a"), raster.flipped_down(F.col("d"), 3, 4).alias("u")))
    assert out["t"] == np.rot90(x).ravel().tolist() and out["a"] == x[:, ::-1].ravel().tolist() and out["u"] == x[::-1].ravel().tolist()


def test_limits_themselves_are_kept_and_ties_go_by_row(spark):
    rows = [("a", r, c, 1.0, 9.0) for r in range(3) for c in range(3)] + [("b", 0, 0, 0.01, 5.0), ("b", 0, 1, 0.0099, 5.0), ("b", 0, 2, 0.01, 4.99), ("c", 0, 0, None, 9.0)]
    df = spark.createDataFrame(rows, "image_id string, row long, col long, road_pixel_pct double, image_std double").repartition(3)
    kept = {(r["image_id"], r["row"], r["col"]) for r in tiling.best(df, ["row", "col"]).collect()}
    assert kept == {("a", r, c) for r in (0, 1) for c in range(3)} | {("b", 0, 0)}
    counts = first(tiling.statistics(df.filter("image_id <> 'c'"), ["row", "col"]))
    assert [counts[k] for k in ("windows_total", "valid", "kept", "tiles_capped", "discarded", "generated")] == [12, 10, 7, 3, 2, 9]
    none = first(tiling.statistics(df.limit(0), ["row", "col"]))
    assert none["windows_total"] == 0 and none["keep_rate"] == 0 and none["road_mean"] == 0


@pytest.mark.parametrize("sizes", [(1, 2, 3, 7, 100)])
def test_splits_cover_everything_once(spark, sizes):
    rows = [(f"g{g}", f"{g}-{i}") for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, id string").repartition(4)
    got = {r["id"]: r["split"] for r in splits.stratified(df, "source", "id").collect()}
    assert got.keys() == {i for _, i in rows}
    for g, n in enumerate(sizes):
        own = [got[f"{g}-{i}"] for i in range(n)]
        train, val = max(1, int(n * 0.7)), max(1, int(n * 0.15))
        val = max(0, n - train) if n - train - val < 0 else val
        assert (own.count("train"), own.count("val"), own.count("test")) == (train, val, n - train - val)
    simple = [r["split"] for r in splits.simple(df, "id").collect()]
    n = len(rows)
    assert (simple.count("train"), simple.count("val")) == (int(n * 0.7), int(n * 0.15))
    again = {r["id"]: r["split"] for r in splits.stratified(df.repartition(7), "source", "id").collect()}
    assert again == got
    with pytest.raises(RatioError):
        splits.simple(df, "id", 0.7, 0.2, 0.2)
    assert splits.simple(df.limit(0), "id").count() == 0


def test_last_occlusion_wins_and_zero_is_not_null(spark):
    tiles = spark.createDataFrame([("t1", "s", "i1", 0.0), ("t2", "s", "i2", None)], "tile_id string, source_dataset string, source_image_id string, avg_road_width_px double").withColumns({"tile_width": F.lit(512), "tile_height": F.lit(256), "road_density": F.lit(0.1), "max_road_width_px": F.lit(1.0), "road_pixel_pct": F.lit(12.34567), "split": F.lit("valid"), "image_tile_path": F.lit("p"), "mask_tile_path": F.lit(None).cast("string")})
    occ = spark.createDataFrame([("t1", 1, "a", "light", 1.0, 0.5), ("t1", 2, "b", "heavy", 0.0, None)], "image_id string, ordinal int, occlusion_type string, severity string, coverage_pct double, road_coverage_pct double")
    geo_ = spark.createDataFrame([("i2", "x.json")], "source_image_id string, reference string")
    table = master.master(tiles, occ, geo_)
    assert tuple(table.columns) == tuple(master.COLUMNS)
    out = {r["image_id"]: r for r in table.collect()}
    assert (out["t1"]["occlusion_type"], out["t1"]["occlusion_coverage_pct"], out["t1"]["occlusion_road_coverage_pct"]) == ("b", 0.0, None)
    assert (out["t2"]["geospatial_metadata_reference"], out["t1"]["geospatial_metadata_reference"], out["t2"]["image_dimensions"], out["t2"]["split"]) == ("x.json", "", "512x256", "val")
    legacy = {r["image_id"]: r for r in master.legacy_csv(table).collect()}
    assert legacy["t1"]["occlusion_coverage_pct"] == "" and legacy["t1"]["avg_road_width_px"] == "" and legacy["t1"]["road_pixel_pct"] == "12.3457"


def test_statistics_skip_nulls_and_have_defaults(spark):
    df = spark.createDataFrame([(None, 0.0, 1.0, 0.5)], "avg_road_width_px double, max_road_width_px double, road_pixel_pct double, road_density double")
    out = first(stats.quality(df))
    assert out["width_mean"] == 0 and out["widest_max"] == 0 and out["road_mean"] == 1.0
    assert first(stats.class_imbalance(df.limit(0)))["recommendation"] == "severe"
    flat = [r.asDict() for r in stats.histogram(spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double"), "v", 4).collect()]
    assert flat == [{"bin": 0, "low": 2.0, "high": 3.0, "n": 2}]
    level = stats.percentile_stretch(spark.createDataFrame([("a", 5.0)] * 3 + [("b", float(i)) for i in range(101)], "k string, v double"), "k", "v").collect()
    assert {(r["k"], r["level"], r["n"]) for r in level if r["k"] == "a"} == {("a", 0, 3)}
    assert {r["level"]: r["n"] for r in level if r["k"] == "b"}[255] == 3


def test_metrics_of_empty_targets_and_short_batches(spark):
    df = spark.createDataFrame([(0, [-1.0, -2.0], [0, 0])], "batch long, logits array<double>, targets array<int>")
    out = first(metrics.by_batch(df))
    assert out["precision"] == out["recall"] == out["iou"] == 1.0
    x, t = np.array([0.3, -2.0, 40.0, -40.0]), np.array([1, 0, 1, 1])
    loss = first(metrics.losses(spark.createDataFrame([(0, x.tolist(), t.tolist())], "batch long, logits array<double>, targets array<int>"), 0.0, 1.0, 0.0))
    p = 1 / (1 + np.exp(-x))
    assert loss["bce"] == pytest.approx(np.mean(np.maximum(x, 0) - x * t + np.log1p(np.exp(-np.abs(x)))))
    assert loss["combined"] == pytest.approx(1 - (2 * (p * t).sum() + 1e-7) / (p.sum() + t.sum() + 1e-7))
    ids = spark.createDataFrame([(i,) for i in random.Random(1).sample(range(1000), 103)], "id long").repartition(5)
    dealt = metrics.batches(ids, 10, "id", ranges=7).collect()
    assert [r["batch"] for r in sorted(dealt, key=lambda r: r["id"])] == [i // 10 for i in range(103)]


def test_early_stop(spark):
    values = [0.1, 0.3, 0.3, 0.2, 0.1, 0.25, 0.29, 0.9]
    rows = metrics.early_stop(spark.createDataFrame(list(enumerate(values)), "epoch int, m double"), "m", patience=5).orderBy("epoch").collect()
    assert [r["waited"] for r in rows] == [0, 0, 1, 2, 3, 4, 5, 0] and [r["stopped"] for r in rows] == [False] * 6 + [True, True]


def closed_form(mask):
    """The chamfer distance by its formula, pixel by pixel."""
    far = lambda a, b: max(a, b) - 2 * min(a, b) + 2.1969 * min(a, b) if max(a, b) >= 2 * min(a, b) else (2 * min(a, b) - max(a, b)) * 1.4 + abs(a - b) * 2.1969
    clear = list(zip(*np.nonzero(mask == 0)))
    return np.array([[min((far(abs(y - b), abs(x - a)) for b, a in clear), default=np.inf) if mask[y, x] else 0.0 for x in range(mask.shape[1])] for y in range(mask.shape[0])])


@pytest.mark.parametrize("mask", [np.zeros((8, 8)), np.eye(8), np.pad(np.ones((3, 8)), ((2, 3), (0, 0))), np.random.default_rng(3).random((9, 7)) > 0.3])
def test_chamfer_is_its_formula(mask):
    got, want = kernels.chamfer(mask), closed_form(mask.astype(int))
    assert np.allclose(got, want)


def test_road_widths(spark):
    band = np.zeros((64, 64), int)
    band[20:28] = 255
    df = spark.createDataFrame([(1, [0] * 64, 8), (2, band.ravel().tolist(), 64)], "id long, data array<int>, width int")
    out = {r["id"]: r for r in occlusion.road_width(df, "id").collect()}
    assert (out[1]["avg_road_width_px"], out[1]["max_road_width_px"], out[1]["road_density"]) == (None, None, 0.0)
    assert out[2]["avg_road_width_px"] == 5.0 and out[2]["max_road_width_px"] == 8.0 and out[2]["road_density"] == 0.125


def test_skeletons_and_lines(spark):
    m = np.zeros((12, 12), int)
    m[2:5, 1:11] = 1
    m[2:11, 5:8] = 1
    df = spark.createDataFrame([(1, m.ravel().tolist(), 12), (2, [0] * 16, 4)], "id long, data array<int>, width int")
    nodes = {r["id"]: r for r in occlusion.skeleton_nodes(df, "id").collect()}
    assert nodes[1]["endpoints"] == 3 and nodes[1]["junctions"] >= 1 and nodes[2]["pixels"] == 0
    lines = occlusion.centre_lines(df, "id").collect()
    points = {(p["x"], p["y"]) for r in lines for p in r["points"]}
    assert len(points) == nodes[1]["pixels"] and all(m[y, x] for x, y in points)
    ring = np.zeros((7, 7), int)
    ring[1, 2:5] = ring[5, 2:5] = ring[2:5, 1] = ring[2:5, 5] = 1
    assert len(kernels.lines(ring)) == 1 and len(kernels.lines(ring)[0]) == ring.sum() + 1


@pytest.mark.parametrize("kind", occlusion.TYPES)
def test_occlusions_are_repeatable_and_cover_what_they_say(spark, kind):
    rng = np.random.default_rng(0)
    rgb, road = rng.integers(0, 256, (64, 64, 3), dtype=np.uint8), np.zeros((64, 64), np.uint8)
    road[30:34] = 255
    rows = [(f"t{i}", 64, 64, bytearray(rgb.tobytes()), bytearray(road.tobytes()) if i else None, kind, s) for i, s in enumerate(occlusion.SEVERITIES)]
    df = spark.createDataFrame(rows, "tile_id string, height int, width int, rgb binary, mask binary, occlusion_type string, severity string")
    a, b = ({r["image_id"]: r for r in occlusion.simulate(d).collect()} for d in (df, df.repartition(3)))
    assert a == b
    for r in a.values():
        cover = np.frombuffer(r["cover"], np.uint8).reshape(64, 64)
        assert r["coverage_pct"] == round(100 * float((cover > 0).mean()), 2)
        assert r["road_coverage_pct"] == (round(100 * float((cover[30:34] > 0).mean()), 2) if r["image_id"] != "t0" else 0)
        if kind in ("tree_canopy", "building_shadow"):
            changed = (np.frombuffer(r["occluded"], np.uint8).reshape(64, 64, 3) != rgb).any(2)
            assert not changed[cover == 0].any()
    assert a["t2"]["coverage_pct"] > 0


def test_canopies_reach_what_they_aim_at():
    rng = np.random.default_rng(1)
    rgb, road = rng.integers(0, 256, (512, 512, 3), dtype=np.uint8), np.zeros((512, 512), np.uint8)
    for severity, (low, high) in occlusion.TARGET["tree_canopy"].items():
        for k in range(7):
            start = time.process_time()
            out, cover = occlusion.occlude(rgb, road, "tree_canopy", severity, occlusion.generator(k, severity))
            assert low <= cover.mean() <= high + 0.02 and time.process_time() - start < 4
            assert np.array_equal(out[~cover], rgb[~cover]) and (out[cover] != rgb[cover]).any(1).mean() > 0.9


@pytest.mark.parametrize("kind", occlusion.TYPES)
def test_tiles_of_any_size_end(kind):
    for h, w in [(n, n) for n in range(1, 17)] + [(1, 40), (40, 1), (3, 100)]:
        for severity in occlusion.SEVERITIES:
            out, cover = occlusion.occlude(np.full((h, w, 3), 99, np.uint8), np.zeros((h, w), np.uint8), kind, severity, occlusion.generator(1, h, w, severity))
            assert out.shape == (h, w, 3) and cover.shape == (h, w)


@pytest.mark.parametrize("size", [(512, 512), (96, 96), (60, 200)])
def test_one_shadow_has_its_closed_form(monkeypatch, size):
    """What is left of the light is 1 - (1 - 0.4 d)(1 - 0.35)^2 at a share d of the greatest distance to the light; the tile's edge is none."""
    monkeypatch.setattr(occlusion, "SHADOWS", 1)
    seen = 0
    for k in range(12):
        out, cover = occlusion.occlude(np.full((*size, 3), 200, np.uint8), np.zeros(size, np.uint8), "building_shadow", "heavy", occlusion.generator(k))
        if not cover.any() or cover.all():
            continue
        d = kernels.chamfer(cover)
        want = np.where(cover, 200 * (1 - (1 - 0.4 * d / d.max()) * 0.65**2), 200)
        assert np.abs(out[:, :, 0] - want).max() <= 1 and (out[cover] < 200).all()
        assert out.min() >= int(200 * 0.5775) and out[cover].max() <= 200 * (0.5775 + 0.169) + 1
        seen += cover[0].any() or cover[-1].any() or cover[:, 0].any() or cover[:, -1].any()
    assert seen  # some touch the tile's edge


def test_shadows_and_clouds_and_vehicles_of_a_whole_tile():
    rng = np.random.default_rng(1)
    rgb, road = rng.integers(0, 256, (512, 512, 3), dtype=np.uint8), np.zeros((512, 512), np.uint8)
    road[250:270] = 255
    for k in range(5):
        for kind in ("building_shadow", "cloud_cover"):
            shares = [occlusion.occlude(rgb, road, kind, s, occlusion.generator(k, kind, s))[1].mean() for s in occlusion.SEVERITIES]
            assert shares[0] >= 0.04 and shares == sorted(shares)
        out, cover = occlusion.occlude(rgb, road, "vehicle", "heavy", occlusion.generator(k, "v"))
        assert 8 * 8 * 15 * 0.3 < cover.sum() < 20 * 25 * 45 and cover[:200].sum() == 0
        # the last row and column painted are not covered
        beyond = (out != rgb).any(2) & ~cover
        assert beyond.any() and not (beyond & ~(np.roll(cover, 1, 0) | np.roll(cover, 1, 1) | np.roll(cover, (1, 1), (0, 1)))).any()


def test_occlusion_while_training_keeps_masks(spark):
    rgb, road = np.full((32, 32, 3), 90, np.uint8), np.zeros((32, 32), np.uint8)
    road[10:14] = 255
    rows = [(f"t{i}", 32, 32, bytearray(rgb.tobytes()), bytearray(road.tobytes()), t, s) for i, (t, s) in enumerate([("vehicle", "heavy"), (None, None), ("tree_canopy", "light")])]
    df = spark.createDataFrame(rows, "tile_id string, height int, width int, rgb binary, mask binary, occlusion_type string, severity string")
    out = {r["tile_id"]: r for r in occlusion.applied(df).collect()}
    assert [out[f"t{i}"]["rgb"] == rgb.tobytes() for i in range(3)] == [False, True, False] and all(r["mask"] == road.tobytes() for r in out.values())


def test_lines_burnt_in(spark):
    rng = np.random.default_rng(5)
    segs = [(int(i % 3), *map(float, rng.uniform(-4, 14, 4))) for i in range(12)] + [(3, 2.0, 2.0, 2.0, 2.0), (4, 50.0, 50.0, 60.0, 60.0)]
    df = spark.createDataFrame(segs, "id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r["id"], r["x"], r["y"]) for r in vectors.burnt(df, "id", height=10, width=12, reach=1.5).collect()}

    def near(s, x, y):
        d = np.array([s[3] - s[1], s[4] - s[2]])
        t = np.clip(((x - s[1]) * d[0] + (y - s[2]) * d[1]) / max(d @ d, 1e-12), 0, 1)
        return np.hypot(x - s[1] - t * d[0], y - s[2] - t * d[1]) <= 1.5

    assert got == {(s[0], x, y) for s in segs for x in range(12) for y in range(10) if near(s, x, y)}
    line = spark.createDataFrame([(1, [(0, 0), (3, 4), (5, 5)])], "id int, points array<struct<x:int,y:int>>")
    assert [(r["x1"], r["y2"]) for r in vectors.segments(line, "id").collect()] == [(0.0, 4.0), (3.0, 5.0)]
    text_ = line.select(vectors.feature(F.col("points")).alias("f"), F.lit("a").alias("by"))
    assert vectors.collection(text_, "by", "f").first()["collection"].startswith('{"type":"FeatureCollection","features":[{"type":"Feature"')


def test_ways_with_defaults(spark):
    reply = '{"elements":[{"type":"way","id":1,"geometry":[{"lon":1,"lat":2}],"tags":{}},{"type":"way","id":2,"geometry":[{"lon":1,"lat":2},{"lon":3,"lat":4}]},{"type":"node","id":3}]}'
    out = [r.asDict(True) for r in vectors.ways(spark.createDataFrame([(reply,), ("no json",), (None,)], "reply string")).collect()]
    assert out == [{"way_id": 2, "highway": "road", "name": "", "points": [{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}]}]


def test_affine_and_mercator(spark):
    t = geo.affine_of_bounds(F.lit(10.0), F.lit(0.0), F.lit(20.0), F.lit(8.0), F.lit(5), F.lit(4))
    p = first(spark.range(1).select(geo.pixel_centre(t, F.lit(0), F.lit(0)).alias("p"), geo.to_mercator(F.lit(180.0), F.lit(0.0)).alias("m")))
    assert (p["p"]["x"], p["p"]["y"]) == (11.0, 7.0) and p["m"]["x"] == pytest.approx(20037508.342789244) and abs(p["m"]["y"]) < 1e-8


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_graphs(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200)]
    nodes = {n for p in pairs for n in p}
    df = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src long, dst long, weight double")
    want = brute_components(pairs, nodes)
    for _ in range(3):
        want = {n: want[want[n]] for n in nodes}
    assert {r["node"]: r["component"] for r in graphs.components(df).collect()} == want
    sizes = lambda roots: max(list(roots.values()).count(r) for r in roots.values())
    out = first(graphs.failure(df, spark.createDataFrame([(115,)], "node long")))
    rest = [(a, b) for a, b in pairs if 115 not in (a, b)]
    assert out["lcc_before"] == sizes(want) and out["lcc_after"] == sizes(brute_components(rest, {n for p in rest for n in p}))
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(4)], "src long, dst long, weight double")
    assert {r["node"]: r["closeness"] for r in graphs.closeness(chain, spark.createDataFrame([(0,), (2,)], "node long")).collect()} == {0: 0.4, 2: 4 / 6}
    assert {r["node"]: r["centrality"] for r in graphs.degree_centrality(chain).collect()} == {0: 0.25, 1: 0.5, 2: 0.5, 3: 0.5, 4: 0.25}


def test_closeness_reaches_the_end_of_a_long_road(spark):
    n = 70
    chain = spark.createDataFrame([(i, i + 1, 1.0) for i in range(n)], "src long, dst long, weight double")
    (out,) = graphs.closeness(chain, spark.createDataFrame([(0,)], "node long")).collect()
    assert (out["reached"], out["distance"], out["closeness"]) == (n, n * (n + 1) // 2, 2 / (n + 1))


def test_pixel_components(spark):
    m = [1, 0, 0, 1, 0, 1, 0, 0, 0, 0, 0, 1, 1, 1, 0, 1]
    out = graphs.pixel_components(spark.createDataFrame([(1, m, 4), (2, [0] * 4, 2)], "id long, data array<int>, width int"), "id").collect()
    assert {(r["id"], r["components"], r["largest"]) for r in out} == {(1, 4, 2), (2, 0, 0)}


def test_uniform_numbers_are_uniform(spark):
    u = np.array([r["u"] for r in spark.range(4000).select(numbers.uniform(1, F.col("id"), 2).alias("u")).collect()])
    assert 0 <= u.min() and u.max() < 1 and abs(np.histogram(u, 10, (0, 1))[0] - 400).max() < 90
