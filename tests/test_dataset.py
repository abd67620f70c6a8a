"""The plan from image files to the master table."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens import config
from roadlens.operators import tiling
from roadlens.plans import dataset
from roadlens.sources import images, manifests, tables

from test_sources import picture, tiff


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("images") / "train"
    top.mkdir()
    for k, (h, w) in enumerate([(64, 64), (80, 100), (30, 40), (64, 64), (64, 64)]):
        rgb, mask = picture(h, w, k, road=k != 3)
        (top / f"{k}_sat.png").write_bytes(images.png(rgb))
        if k != 2:
            (top / f"{k}_mask.png").write_bytes(images.png(mask if k != 4 else mask[:32]))
    (top / "5_sat.png").write_bytes(b"no picture")
    (top / "7_sat.tif").write_bytes(tiff("<", [(33550, "d", [2.0, 3.0, 0.0]), (33922, "d", [0.0, 0.0, 0.0, 100.0, 200.0, 0.0]), (34735, "H", [1, 1, 0, 2, 1025, 0, 1, 1, 3072, 0, 1, 3857])]))
    return top.parent


def manifest(spark, folder, endings=("png",) * 7 + ("tif",)):
    rows = [(str(k), "train", f"file:{folder}/train/{k}_sat.{e}", f"{folder}/train/{k}_mask.png" if k != 7 else None) for k, e in enumerate(endings)]
    return spark.createDataFrame([*rows, ("8", "val", f"{folder}/train/0_sat.png", None)], manifests.MANIFEST)


SMALL = config.Config(tile_size=32, stride=16, max_tiles_per_image=4, occlusion_samples=5)


def test_files_to_master_table(spark, folder, tmp_path):
    made = dataset.build(spark, manifest(spark, folder), str(folder / "train"), SMALL)
    known = {r["image_id"]: r for r in made.records.collect()}
    assert set(known) == {"0", "1", "2", "3", "4"} and known["2"]["validation_errors"] == ["mask_unreadable"] and known["0"]["road_pixel_pct"] == 12.5
    assert known["4"]["validation_errors"] == ["size_mismatch"] and known["0"]["md5_mask"] and known["2"]["md5_mask"] is None and known["0"]["windows"] == 9
    assert {(r["image_id"], r["reason"]) for r in made.failures.collect()} == {("5", "image_unreadable"), ("6", "image_missing"), ("7", "image_unreadable")}
    cut = made.tiles.drop("rgb", "mask").collect()
    assert {i: sum(r["source_image_id"] == i for r in cut) for i in "01234"} == {"0": 4, "1": 4, "2": 0, "3": 0, "4": 0}
    best = {(r["row"], r["col"]): r["road_pixel_pct"] for r in cut if r["source_image_id"] == "0"}
    assert best == {(1, 0): 25.0, (1, 1): 25.0, (1, 2): 25.0, (0, 0): 12.5}
    tables.write_master(made.master, str(tmp_path / "m"))
    back = tables.read_master(spark, str(tmp_path / "m/csv"))
    assert back.count() == 8 and back.filter("occlusion_type is not null").count() == 5
    assert back.agg(F.max("max_road_width_px")).first()[0] == 8.0
    again = tiling.rehydrated(back.withColumnRenamed("image_id", "tile_id"), stride=16).collect()
    assert {(r["tile_id"], r["row"], r["col"], r["x_end"]) for r in again} == {(r["tile_id"], r["row"], r["col"], r["x_end"]) for r in cut}
    tables.write_report(made.report, str(tmp_path / "r"))
    assert {r["total_masks"] for r in spark.read.json(str(tmp_path / "r")).collect()} == {4}
    # nothing but the step that brings images and masks together deals out pixels
    for df in (made.tiles, made.occlusions, made.master):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any("rgb" in line or "mask#" in line for line in plan.splitlines() if re.search(r"\bExchange\b", line))


def test_images_without_masks_are_tiled_if_no_road_is_asked_for(spark, folder):
    rows = manifest(spark, folder).filter("image_id in ('0', '2')").withColumn("mask_path", F.when(F.col("image_id") == "0", F.col("mask_path")))
    made = dataset.build(spark, rows, str(folder / "train"), config.Config(tile_size=32, stride=32, min_road_pixel_pct=0.0, occlusion_samples=3))
    out = {(r["source_image_id"], r["row"], r["col"]): r["mask"] is None for r in made.tiles.collect()}
    assert out == {("0", y, x): False for y in (0, 1) for x in (0, 1)} | {("2", 0, x): True for x in (0, 1)}
    assert made.master.filter("road_density = 0").count() >= 2 and made.occlusions.count() == 3


def test_large_images_are_scaled_before_they_are_cut(spark, folder):
    made = dataset.build(spark, manifest(spark, folder).filter("image_id = '0'"), str(folder / "train"), config.Config(tile_size=16, stride=16, min_road_pixel_pct=0.0, max_dimension=32))
    assert made.records.first()["windows"] == 4 and {r["road_pixel_pct"] for r in made.tiles.collect()} == {12.5}


def test_whole_size_images(spark, tmp_path):
    want = {}
    for k in range(6):
        rng = np.random.default_rng(k)
        rgb, mask = rng.integers(0, 256, (1024, 1024, 3), dtype=np.uint8), np.zeros((1024, 1024), np.uint8)
        mask[100 * k : 100 * k + 8] = 255
        (tmp_path / f"{k}_sat.png").write_bytes(images.png(rgb))
        (tmp_path / f"{k}_mask.png").write_bytes(images.png(mask))
        shares = {(y // 256, x // 256): 100 * float((mask[y : y + 512, x : x + 512] > 0).mean()) for y in (0, 256, 512) for x in (0, 256, 512)}
        want[str(k)] = sorted(((-s, p) for p, s in shares.items() if s >= 0.01))[:6]
    rows = spark.createDataFrame([(str(k), "train", f"{tmp_path}/{k}_sat.png", f"{tmp_path}/{k}_mask.png") for k in range(6)], manifests.MANIFEST)
    made = dataset.build(spark, rows, str(tmp_path), config.Config(occlusion_samples=4))
    got: dict = {}
    for r in made.tiles.drop("rgb", "mask").collect():
        got.setdefault(r["source_image_id"], []).append((-r["road_pixel_pct"], (r["row"], r["col"])))
    assert {k: sorted(v) for k, v in got.items()} == want
    assert {(r["windows"], min(r["kept"], 6) == len(want[r["image_id"]])) for r in made.records.collect()} == {(9, True)} and made.occlusions.count() == 4


def test_a_second_run_decodes_what_is_new_or_has_changed(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def put(k, seed):
        rgb, mask = picture(32, 32, seed)
        (folder / f"{k}_sat.png").write_bytes(images.png(rgb))
        (folder / f"{k}_mask.png").write_bytes(images.png(mask))
        return rgb

    def run(ids, how=SMALL, resume=True):
        rows = spark.createDataFrame([(str(k), "train", f"{folder}/{k}_sat.png", f"{folder}/{k}_mask.png") for k in ids], manifests.MANIFEST)
        made = dataset.build(spark, rows, str(folder), how, out=out, resume=resume)
        tiles = {(r["source_image_id"], r["row"], r["col"]): r["rgb"] for r in made.tiles.collect()}
        state = spark.read.parquet(f"{out}/_state")
        last = state.agg(F.max("run")).first()[0]
        return made, tiles, {r["image_id"] for r in state.filter(F.col("run") == last).collect()}, last

    pictures = {k: put(k, k) for k in range(50)}
    _, tiles, done, last = run(range(50), resume=False)
    assert len(done) == 50 and last == 1 and {k: tiles[str(k), 0, 0] for k in pictures} == {k: p.tobytes() for k, p in pictures.items()}
    pictures[7], pictures[50] = put(7, 107), put(50, 50)
    made, tiles, done, last = run(range(51))
    assert done == {"7", "50"} and last == 2 and {r["image_id"] for r in spark.read.parquet(f"{out}/run=2").select("image_id").distinct().collect()} == {"7", "50"}
    assert {k: tiles[str(k), 0, 0] for k in pictures} == {k: p.tobytes() for k, p in pictures.items()} and len(tiles) == 51
    assert made.records.count() == 51 and made.master.count() == 51
    made, tiles, done, last = run(range(1, 51))  # nothing new, one image no longer named
    assert {int(i) for i, _, _ in tiles} == set(range(1, 51)) and made.records.count() == 50 and made.failures.count() == 0
    pictures[7] = put(7, 7)  # as it was at first
    _, tiles, done, last = run(range(1, 51))
    assert done == {"7"} and tiles["7", 0, 0] == pictures[7].tobytes() and len(tiles) == 50
    _, tiles, done, last = run(range(1, 51), config.Config(tile_size=16, stride=16, max_tiles_per_image=4, occlusion_samples=5))
    assert len(done) == 50 and all(len(x) == 16 * 16 * 3 for x in tiles.values())  # other settings: all anew
    (tmp_path / "out/run=5").mkdir()
    (tmp_path / "out/run=5/part-0.parquet").write_bytes(b"cut short")  # of a run that failed
    put(5, 500)
    _, tiles, done, last = run(range(1, 51), config.Config(tile_size=16, stride=16, max_tiles_per_image=4, occlusion_samples=5))
    assert done == {"5"} and last == 5
    _, tiles, done, last = run(range(3), resume=False)
    assert last == 1 and len(done) == 3
