"""Sources, sinks, streams and the plan from files to the master table."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens import config
from roadlens.errors import ConfigError, SourceError
from roadlens.operators import augment, inference, kernels, tiling
from roadlens.sources import geotiff, images, manifests, tables, vector_files
from roadlens.streaming import ingest


def picture(h, w, seed, road=True):
    rng = np.random.default_rng(seed)
    mask = np.zeros((h, w), np.uint8)
    if road:
        mask[h // 2 - 4 : h // 2 + 4] = 255
    return rng.integers(0, 256, (h, w, 3), dtype=np.uint8), mask


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("images") / "train"
    top.mkdir()
    for k, (h, w) in enumerate([(64, 64), (80, 100), (30, 40), (64, 64)]):
        rgb, mask = picture(h, w, k, road=k != 3)
        (top / f"{k}_sat.png").write_bytes(images.png(rgb))
        if k != 2:
            (top / f"{k}_mask.png").write_bytes(images.png(mask))
    (top / "note.txt").write_text("no image")
    return top.parent


def manifest(spark, folder):
    rows = [(str(k), "train", f"{folder}/train/{k}_sat.png", f"{folder}/train/{k}_mask.png") for k in range(5)]
    return spark.createDataFrame(rows, manifests.MANIFEST)


def test_pixels_survive(spark, folder):
    read = images.masks(images.standardised(images.images(spark, str(folder / "train")))).collect()
    by = {r["path"].rsplit("/", 1)[1]: r for r in read}
    rgb, mask = picture(80, 100, 1)
    assert by["1_sat.png"]["rgb"] == rgb.tobytes()
    assert (by["1_mask.png"]["mask"], by["1_mask.png"]["road_pixel_count"], by["1_mask.png"]["channels"]) == (mask.tobytes(), 800, 1)


def test_listing_pairing_and_discovery(spark, folder, caplog):
    found = manifests.listing(spark, str(folder)).collect()
    assert len(found) == 7 and all(r["size_bytes"] > 0 for r in found)
    sources = {"a": {"enabled": True, "images": str(folder)}, "b": {}, "c": {"enabled": True, "adapter": "Manifest", "path": str(folder / "none.csv")}, "d": {"enabled": True, "adapter": "unknown", "images": str(folder), "masks": str(folder)}}
    out = manifests.scan(spark, sources)
    assert "PATH_NOT_FOUND" in "".join(r["reason"] for r in manifests.failures(spark, sources).collect()) and [r["source_dataset"] for r in manifests.failures(spark, sources).collect()] == ["c"]
    assert "source c cannot be read" in caplog.text
    assert {r["source_dataset"] for r in out.collect()} == {"a", "d"}
    pairs = {r["image_id"]: r["mask_path"] for r in out.filter("source_dataset = 'd' and sat_image_path like '%sat%'").collect()}
    assert pairs["0"].endswith("0_mask.png") and pairs["2"] is None
    with pytest.raises(SourceError):
        manifests.scan(spark, {"x": {"enabled": True, "images": str(folder / "nowhere")}})
    with pytest.raises(SourceError):
        manifests.scan(spark, {"x": {"images": str(folder)}})


def test_manifest_is_trimmed(spark, tmp_path):
    (tmp_path / "m.csv").write_text("image_id,split,sat_image_path,mask_path\n 1 , Valid ,a.png, b.png\n2,train,c.png,\n3,,d.png,\n")
    rows = {r["image_id"]: r for r in manifests.manifest(spark, str(tmp_path / "m.csv")).collect()}
    assert (rows["1"]["split"], rows["1"]["mask_path"], rows["2"]["mask_path"], rows["3"]["split"]) == ("val", "b.png", None, "train")


def tile_rows(spark):
    rows = []
    for k in range(3):
        rgb, mask = picture(32, 32, k)
        rows.append((f"t{k}", 32, 32, bytearray(rgb.tobytes()), bytearray(mask.tobytes())))
    return spark.createDataFrame(rows, "tile_id string, height int, width int, rgb binary, mask binary")


def test_augmentation_is_repeatable_and_moves_both_alike(spark):
    df = tile_rows(spark)
    a, b, c = ({r["tile_id"]: (r["rgb"], r["mask"]) for r in augment.augment(d, epoch=e).collect()} for d, e in ((df, 0), (df.repartition(2), 0), (df, 1)))
    assert a == b != c
    rgb, mask = picture(32, 32, 5)
    rgb = np.where(mask[..., None] > 0, 255, 0).repeat(3, 2).astype(np.uint8) if rgb.ndim == 2 else np.repeat(np.where(mask > 0, 255, 0)[..., None], 3, 2).astype(np.uint8)
    moves = {k: {"p": 1.0} for k in ("horizontal_flip", "vertical_flip", "random_rotate_90")}
    out, m = augment.augmented(rgb, mask, moves, np.random.default_rng(1))
    assert np.array_equal(out[..., 0] > 0, m > 0) and m.sum() == mask.sum()
    twice = augment.augmented(*augment.augmented(rgb, mask, {"horizontal_flip": {"p": 1}}, np.random.default_rng(0)), {"horizontal_flip": {"p": 1}}, np.random.default_rng(0))
    assert np.array_equal(twice[0], rgb) and np.array_equal(twice[1], mask)
    still = augment.warped(rgb, 0.0, 1.0, 0.0, 0.0, True)
    assert np.array_equal(still, rgb)
    with pytest.raises(ValueError):
        augment.augment(df, {"spin": {}})
    assert '"step": "clahe"' in augment.as_json({"clahe": {}})


def test_normalisation_inverts():
    rgb = picture(8, 8, 1)[0]
    assert np.array_equal(augment.denormalised(augment.normalised(rgb)), rgb)


def test_predictions_and_overlays(spark):
    df = tile_rows(spark)
    out = inference.predict(df, " Brightness ", batch=2).collect()
    assert len(out) == 3 and all(len(r["logits"]) == 1024 and set(r["predicted"]) <= {0, 255} for r in out)
    with pytest.raises(KeyError, match="brightness"):
        inference.predict(df, "none")
    shown = inference.overlay(df, "mask").first()
    x, m = np.frombuffer(shown["overlay"], np.uint8).reshape(-1, 3), np.frombuffer(shown["mask"], np.uint8)
    assert np.array_equal(x[m == 0], np.frombuffer(shown["rgb"], np.uint8).reshape(-1, 3)[m == 0])


def tiff(order, entries, w=40, h=30):
    """A TIFF of tags alone."""
    kinds = {"H": 3, "I": 4, "d": 12, "c": 2}
    fields = [(256, "H", [w]), (257, "H", [h]), (258, "H", [8]), (277, "H", [3]), *entries]
    body, place = b"", 8 + 2 + 12 * len(fields) + 4
    heads = b""
    for tag, kind, values in fields:
        raw = struct.pack(f"{order}{len(values)}{kind}", *values)
        if len(raw) <= 4:
            heads += struct.pack(order + "HHI", tag, kinds[kind], len(values)) + raw.ljust(4, b"\0")
        else:
            heads += struct.pack(order + "HHII", tag, kinds[kind], len(values), place + len(body))
            body += raw
    mark = b"II*\0" if order == "<" else b"MM\0*"
    return mark + struct.pack(order + "I", 8) + struct.pack(order + "H", len(fields)) + heads + b"\0" * 4 + body


def test_masks_count_by_their_grey_value(spark, tmp_path):
    colours = np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [128, 128, 128], [127, 127, 127], [255, 255, 0]]], np.uint8)
    (tmp_path / "m.png").write_bytes(images.png(colours))
    read = images.images(spark, str(tmp_path))
    assert list(images.masks(read).first()["mask"]) == [0, 255, 0, 255, 0, 255]
    assert list(images.masks(read, any_channel=True).first()["mask"]) == [255, 255, 255, 255, 0, 255]
    assert list(images.masks(read.withColumn("path", F.lit("m.TIF"))).first()["mask"]) == [255] * 6


def test_files_are_written_and_read_back(spark, tmp_path):
    images.write_tiles(tile_rows(spark).withColumns({"split": F.lit("val"), "mask": F.when(F.col("tile_id") != "t1", F.col("mask"))}), str(tmp_path))
    back = {r["path"].rsplit("/", 3)[-3:][1] + "/" + r["path"].rsplit("/", 1)[1]: r for r in images.standardised(images.images(spark, str(tmp_path))).collect()}
    assert sorted(back) == ["images/t0.png", "images/t1.png", "images/t2.png", "masks/t0.png", "masks/t2.png"]
    assert back["images/t2.png"]["rgb"] == picture(32, 32, 2)[0].tobytes() and back["masks/t0.png"]["channels"] == 1


def test_geographic_metadata(spark, tmp_path):
    scale, tie = (33550, "d", [2.0, 3.0, 0.0]), (33922, "d", [0.0, 0.0, 0.0, 100.0, 200.0, 0.0])
    keys = lambda code, point: (34735, "H", [1, 1, 0, 2, 1025, 0, 1, point, 3072, 0, 1, code])
    files = {
        "a.tif": tiff("<", [scale, tie, keys(3857, 1), (42113, "c", [b"-", b"1", b"\0", b"\0", b"\0"])]), "b.tif": tiff(">", [scale, tie, keys(3857, 2)]), "c.tif": tiff("<", []),
        "d.tif": b"II*\0\xff\xff\xff\xff", "e.png": images.png(picture(8, 8, 1)[0]), "f.tif": tiff("<", [(34264, "d", [2.0, 0, 0, 10, 0, -2.0, 0, 50, 0, 0, 0, 0, 0, 0, 0, 1]), keys(32767, 1)]),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    out = {r["path"].rsplit("/", 1)[1]: r.asDict(True) for r in geotiff.metadata(spark, str(tmp_path)).collect()}
    a = out["a.tif"]
    assert (a["width"], a["height"], a["band_count"], a["dtype"], a["is_georeferenced"], a["crs"], a["nodata"]) == (40, 30, 3, "uint8", True, "EPSG:3857", -1.0)
    assert a["bounds"] == {"left": 100.0, "bottom": 110.0, "right": 180.0, "top": 200.0} and a["resolution_y"] == 3.0
    assert out["b.tif"]["transform"]["c"] == 99.0 and out["b.tif"]["transform"]["f"] == 201.5
    assert out["c.tif"]["width"] == 40 and not out["c.tif"]["is_georeferenced"] and out["c.tif"]["transform"] is None
    assert [out[n]["width"] for n in ("d.tif", "e.png")] == [None, None]
    assert out["f.tif"]["bounds"]["right"] == 90.0 and out["f.tif"]["crs"] is None


def test_large_images_are_scaled(spark):
    flat = np.full((50, 100, 3), 77, np.uint8)
    df = spark.createDataFrame([(50, 100, bytearray(flat.tobytes())), (8, 8, bytearray(flat[:8, :8].tobytes()))], "height int, width int, rgb binary")
    out = images.limited(df, 40).collect()
    assert [(r["height"], r["width"]) for r in out] == [(20, 40), (8, 8)] and all(set(r["rgb"]) == {77} for r in out)
    wave = np.repeat((128 + 100 * np.sin(np.arange(200) / 20))[None, :, None], 200, 0).repeat(3, 2)
    small = kernels.lanczos(wave.astype(np.uint8), 100)
    assert np.abs(small[50, 5:-5, 0] - (wave[0, ::2, 0] + wave[0, 1::2, 0])[5:-5] / 2).max() < 2


def test_presence(spark, folder, tmp_path):
    assert manifests.present(spark, {"a": str(folder), "b": str(tmp_path), "c": str(tmp_path / "none")}) == {"a": True, "b": False, "c": False}


def shp(*records):
    body = b""
    for k, parts in enumerate(records):
        points = [p for part in parts for p in part]
        begins = [sum(map(len, parts[:i])) for i in range(len(parts))]
        content = struct.pack("<i4d2i", 3, 0, 0, 0, 0, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *begins) + b"".join(struct.pack("<2d", *p) for p in points) if parts else struct.pack("<i", 0)
        body += struct.pack(">2i", k + 1, len(content) // 2) + content
    return struct.pack(">i", 9994) + b"\0" * 28 + struct.pack("<i", 3) + b"\0" * 64 + body


def test_vector_files(spark, tmp_path):
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection","crs":{"properties":{"name":"EPSG:3857"}},"features":[{"type":"Feature","properties":{"highway":"road"},"geometry":{"type":"LineString","coordinates":[[0,1],[2,3]]}},\n{"geometry":{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[5,5]]]}},{"geometry":{"type":"Point","coordinates":[1,2]}},{"geometry":null}]}')
    (tmp_path / "b.json").write_text("[1, 2]")
    (tmp_path / "c.SHP").write_bytes(shp([[(0.0, 0.0), (1.0, 2.0)], [(3.0, 3.0), (4.0, 4.0), (5.0, 5.0)]], [], [[(9.0, 9.0)]]))
    (tmp_path / "d.shp").write_bytes(b"no shapes")
    points = lambda r: [(p["x"], p["y"]) for p in r["points"]]
    lines = {(r["feature"], r["part"]): points(r) for r in vector_files.geojson(spark, str(tmp_path / "*json")).collect()}
    assert lines == {(0, 0): [(0.0, 1.0), (2.0, 3.0)], (1, 0): [(0.0, 0.0), (1.0, 1.0)]}
    shapes = {(r["feature"], r["part"]): points(r) for r in vector_files.shapefile(spark, str(tmp_path)).collect()}
    assert shapes == {(0, 0): [(0.0, 0.0), (1.0, 2.0)], (0, 1): [(3.0, 3.0), (4.0, 4.0), (5.0, 5.0)]}
    every = vector_files.all_lines(spark, str(tmp_path)).collect()
    assert len(every) == 4 and {r["crs"] for r in every} == {"EPSG:3857"}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.json").write_text("{}")
    with pytest.raises(SourceError):
        vector_files.all_lines(spark, str(tmp_path / "none"))


def test_configuration(tmp_path):
    (tmp_path / "c.yaml").write_text("tiling:\n  tile_size: 256\n  other: 1\nsplits:\n  active_splits: [train, val]\n")
    got = config.load(tmp_path / "c.yaml")
    assert (got.tile_size, got.stride, got.active_splits) == (256, 256, ("train", "val"))
    (tmp_path / "bad.yaml").write_text("- 1\n")
    for name in ("bad.yaml", "none.yaml"):
        with pytest.raises(ConfigError):
            config.load(tmp_path / name)


def test_images_arrive(spark, folder, tmp_path):
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    for expected in (7, 7, 8):
        if expected == 8:
            (folder / "train" / "9_sat.png").write_bytes(images.png(picture(8, 8, 9)[0]))
        ingest.keep_up(ingest.new_images(spark, str(folder / "train" / "*.png")), target, state).awaitTermination(60)
        rows = spark.read.parquet(target).collect()
        assert len(rows) == expected and len({r["md5"] for r in rows}) >= 6
    (folder / "train" / "9_sat.png").unlink()


def test_windows_of_a_stream_drop_late_rows(spark, tmp_path):
    schema = "ts timestamp, event_type string, value double"
    source = tmp_path / "events"
    query = None
    for k, rows in enumerate([[("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 03:00:00", "a", 2.0)], [("2024-01-01 00:20:00", "a", 4.0), ("2024-01-01 09:00:00", "b", 8.0)]]):
        spark.createDataFrame(rows, "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value").coalesce(1).write.mode("append").parquet(str(source))
        query = ingest.windowed(spark.readStream.schema(schema).parquet(str(source))).writeStream.format("parquet").option("path", str(tmp_path / "w")).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
        query.awaitTermination(60)
    out = {(str(r["start"]), r["event_type"]): r["total"] for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    assert out == {("2024-01-01 00:00:00", "a"): 1.0, ("2024-01-01 03:00:00", "a"): 2.0}
