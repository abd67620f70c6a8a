"""From image files to the master table and its report (OP1-2, OP6, RAS10, SRC13, D1-D6, §3 of the survey).

Files are chosen by the manifest before any is opened, PASS_FILES at a time; each is decoded once, as what its manifest row
says it is, and its content is hashed and read for tags in one other pass. An image and its mask meet in one task, where
they are cut into tiles; what comes out is written as one table of columns, whose pixels only those read that ask for them.
All other steps are functions from DataFrames to DataFrames of narrow rows, or work on a tile in its own row: no join
carries pixels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlens.config import Config
from roadlens.functions import text
from roadlens.operators import kernels, master, occlusion, splits, stats
from roadlens.session import cut, drop_path, new_path, path_exists, small
from roadlens.sources import geotiff, images, manifests

KEY = ["image_id", "source_dataset", "split", "sat_image_path", "mask_path"]
RECORD = "height int, width int, channels int, mask_height int, mask_width int, road_pixel_count long, windows int, kept int"
TILE = "tile_id string, row long, col long, x_start long, y_start long, x_end long, y_end long, tile_height int, tile_width int, road_pixel_pct double, image_std double, rgb binary, mask binary"
MADE = ", ".join(f"{k} string" for k in KEY) + f", {RECORD}, {TILE}"
NAMES = [c.split()[0] for c in MADE.split(", ")]
#: Files that one pass opens, about: their names are broadcast, and the hashes of their paths are part of the plan.
PASS_FILES = 50_000


def _local(path: Column) -> Column:
    """A path without its scheme, as one file is named in several ways."""
    return F.regexp_replace(path, "^[a-z]+:/+", "/")


def roles(manifest: DataFrame) -> DataFrame:
    """path, role (image or mask) and the manifest row's columns: a row for each file that a manifest names."""
    named = manifest.withColumns({"sat_image_path": _local(F.col("sat_image_path")), "mask_path": _local(F.col("mask_path"))})
    return named.select(*KEY, F.inline(F.array(*[F.struct(F.col(c).alias("path"), F.lit(r).alias("role")) for c, r in (("sat_image_path", "image"), ("mask_path", "mask"))]))).filter("path is not null")


def windows(h: int, w: int, size: int, step: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """How much an image is to grow on its far sides, and where its windows begin (y, x)."""
    grow = [(0, max(0, size - n) if n <= size else -(n - size) % step) for n in (h, w)]
    return grow, [(y, x) for y in range(0, h + grow[0][1] - size + 1, step) for x in range(0, w + grow[1][1] - size + 1, step)]


def _shrunk(mask: np.ndarray, h: int, w: int) -> np.ndarray:
    """A mask at the size of its image when that was scaled: each pixel is the nearest one's."""
    pick = lambda n, m: np.minimum(((np.arange(m) + 0.5) * n / m).astype(int), n - 1)
    return mask[np.ix_(pick(mask.shape[0], h), pick(mask.shape[1], w))]


def _cut(config: Config):
    """For one image's rows (itself and its mask): a row of what is known of it, then its best tiles."""
    size, step = config.tile_size, config.stride

    def made(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        read = {r.role: r for r in rows.itertuples() if r.height > 0}
        about = dict(zip(KEY, key))
        picture, other = read.get("image"), read.get("mask")
        mask = None
        if other is not None:
            over = 0 if other.path.lower().endswith(images.TIFF) else 127
            mask = images.mask_of(other.pixels, other.channels, over).reshape(other.height, other.width)
            about |= {"mask_height": other.height, "mask_width": other.width, "road_pixel_count": int(mask.sum())}
        if picture is None:
            return pd.DataFrame([about], columns=NAMES, dtype=object)
        about |= {"height": picture.height, "width": picture.width, "channels": picture.channels, "windows": 0, "kept": 0}
        if mask is not None and mask.shape != (picture.height, picture.width):
            return pd.DataFrame([about], columns=NAMES, dtype=object)
        rgb = images.rgb_of(picture.pixels, picture.channels).reshape(picture.height, picture.width, 3)
        if config.max_dimension and max(rgb.shape) > config.max_dimension:
            rgb = kernels.lanczos(rgb, config.max_dimension)
            mask = None if mask is None else _shrunk(mask, *rgb.shape[:2])
        grow, places = windows(*rgb.shape[:2], size, step)
        rgb = np.pad(rgb, [*grow, (0, 0)], mode="reflect")
        mask = None if mask is None else np.pad(mask * np.uint8(255), grow, mode="reflect")
        found = []
        for y, x in places:
            box = np.s_[y : y + size, x : x + size]
            road, spread = 0.0 if mask is None else 100 * float((mask[box] > 0).mean()), float(rgb[box].std())
            if road >= config.min_road_pixel_pct and spread >= config.min_image_std:
                found.append((-road, y, x, spread))
        about |= {"windows": len(places), "kept": len(found)}
        out = [about]
        for road, y, x, spread in sorted(found)[: config.max_tiles_per_image]:
            box = np.s_[y : y + size, x : x + size]
            out.append({k: about[k] for k in KEY} | {
                "tile_id": f"{about['split']}_{about['image_id']}_r{y // step:03d}_c{x // step:03d}", "row": y // step, "col": x // step, "x_start": x, "y_start": y, "x_end": x + size, "y_end": y + size,
                "tile_height": size, "tile_width": size, "road_pixel_pct": -road + 0.0, "image_std": spread, "rgb": rgb[box].tobytes(), "mask": None if mask is None else mask[box].tobytes(),
            })
        return pd.DataFrame(out, columns=NAMES, dtype=object)

    return made


def made(spark: SparkSession, named: DataFrame, folder: str, config: Config) -> DataFrame:
    """MADE: for each manifest row of which a file can be read a row about the image (no tile_id), and rows of its tiles.

    named: roles of at most 100,000 files, as a cut table. Only these files are opened: their paths choose them in the
    listing. They meet their names by broadcast; pixels are dealt out once, to bring an image and its mask together: a
    picture file is one row, and only Spark's image source decodes it.
    """
    chosen = images.among([r[0] for r in named.select(F.xxhash64("path")).distinct().collect()])
    names = small(named)
    pictures = images.images(spark, folder, broken=True, named=chosen).join(names, "path")
    scenes = images.decoded_tiffs(images.tiff_contents(spark, folder, chosen).join(names, "path"), F.col("role") == "mask")
    return pictures.unionByName(scenes).groupBy(*KEY).applyInPandas(_cut(config), MADE)


def passes(named: DataFrame, most: int = PASS_FILES) -> Iterator[DataFrame]:
    """named (a cut table) in parts of about `most` files, each with both files of its manifest rows."""
    n = max(1, -(-named.count() // most))
    for k in range(n):
        yield named if n == 1 else named.filter(F.pmod(F.xxhash64(*KEY), F.lit(n)) == k)


def facts(spark: SparkSession, named: DataFrame, folder: str) -> DataFrame:
    """KEY with size_bytes, md5_image, md5_mask, listed, and the image's geographic tags: one pass over the files' contents."""
    is_tiff = text.extension(F.col("path")).isin(*images.TIFF)
    content = images.hashes(spark, folder, geotiff.tags_of(F.when(is_tiff, F.col("content"))).alias("geo"))
    of = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
    return named.join(content, "path", "left").groupBy(*KEY).agg(
        of("image", "size_bytes").alias("size_bytes"), of("image", "md5").alias("md5_image"), of("mask", "md5").alias("md5_mask"), of("image", "md5").isNotNull().alias("listed"),
        *[F.first(F.when((F.col("role") == "image") & F.col("geo.is_georeferenced"), F.col(f"geo.{c}")), ignorenulls=True).alias(c) for c in ("crs", "transform", "bounds", "resolution_x", "resolution_y")],
    ).withColumn("is_georeferenced", F.col("crs").isNotNull())


def records(made_rows: DataFrame, facts_: DataFrame) -> DataFrame:
    """What is known of each image that can be read, without pixels."""
    known = made_rows.filter("tile_id is null").select(*KEY, *[c.split()[0] for c in RECORD.split(", ")])
    joined = facts_.join(known, [facts_[k].eqNullSafe(known[k]) for k in KEY]).select(facts_["*"], *[known[c.split()[0]] for c in RECORD.split(", ")])
    return manifests.validated(joined).withColumn("invalid", F.size("validation_errors") > 0)


def failures(facts_: DataFrame, known: DataFrame) -> DataFrame:
    """image_id, source_dataset, sat_image_path, reason of the manifest rows whose image is missing or cannot be read (OP6)."""
    lost = facts_.join(known.select("image_id", "source_dataset", "sat_image_path"), ["image_id", "source_dataset", "sat_image_path"], "left_anti")
    return lost.select("image_id", "source_dataset", "sat_image_path", F.when(F.col("listed"), "image_unreadable").otherwise("image_missing").alias("reason"))


def tiles(made_rows: DataFrame) -> DataFrame:
    """The best tiles of each image with their pixels; mask is null where the image has none."""
    return made_rows.filter("tile_id is not null").select(
        "tile_id", F.col("image_id").alias("source_image_id"), "source_dataset", "split", "row", "col", "x_start", "y_start", "x_end", "y_end",
        F.col("tile_height").alias("height"), F.col("tile_width").alias("width"), "road_pixel_pct", "image_std", "rgb", "mask",
    )


#: What a run has written: the images and the hashes of their files, by the number of the run and the settings that tiles depend on.
STATE = ", ".join(f"{k} string" for k in KEY) + ", md5_image string, md5_mask string, settings string, run int"


def settings_of(config: Config) -> str:
    return repr((config.tile_size, config.stride, config.min_road_pixel_pct, config.min_image_std, config.max_tiles_per_image, config.max_dimension))


def written(spark: SparkSession, named: DataFrame, about: DataFrame, folder: str, config: Config, path: str, resume: bool) -> DataFrame:
    """MADE rows of all of named, as the folder `path` has them after this run.

    With resume only images are opened that no earlier run has written with the same contents of their files and the same
    settings. Rows are appended, a subfolder a run; of an image that was written again, or is no longer named, the earlier
    rows are left out. A run that fails before its end is repeated by the next, as its images are noted at the end.
    """
    keys = lambda df: [F.col(k).eqNullSafe(df[f"__{k}"]) for k in KEY]
    renamed = lambda df: df.select(*[F.col(k).alias(f"__{k}") for k in KEY], *[c for c in df.columns if c not in KEY])
    state_path = f"{path}/_state"
    before = spark.createDataFrame([], STATE)
    if resume and path_exists(spark, state_path):
        before = cut(spark.read.schema(STATE).parquet(state_path))
    elif path_exists(spark, path):
        drop_path(spark, path)
    run = 1 + (before.agg(F.max("run")).first()[0] or 0)
    last = before.withColumn("__r", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("run")))).filter("__r = 1").drop("__r")
    same = renamed(last.filter(F.col("settings") == settings_of(config)).withColumnsRenamed({"md5_image": "__i", "md5_mask": "__m"}))
    now = about.select(*KEY, "md5_image", "md5_mask")
    todo = cut(now.join(same, [*keys(same), F.col("md5_image").eqNullSafe(F.col("__i")), F.col("md5_mask").eqNullSafe(F.col("__m"))], "left_anti"))
    wanted = renamed(todo)
    if path_exists(spark, f"{path}/run={run}"):  # what a run that failed has left
        drop_path(spark, f"{path}/run={run}")
    fresh = cut(named.join(wanted, keys(wanted), "left_semi")) if run > 1 else named
    for part in passes(fresh) if fresh.limit(1).count() else ():
        made(spark, part, folder, config).write.mode("append").parquet(f"{path}/run={run}")
    todo.select(*KEY, "md5_image", "md5_mask", F.lit(settings_of(config)).alias("settings"), F.lit(run).alias("run")).write.mode("append").parquet(state_path)
    # an image's rows of this run are its own; earlier ones go if it was written again, or is not named
    rows = spark.read.schema(f"{MADE}, run int").option("basePath", path).parquet(path)
    current = renamed(now)
    stale = before.join(wanted, keys(wanted), "left_semi").union(before.join(current, keys(current), "left_anti"))
    old = before.join(last.select(*[F.col(k).alias(f"__{k}") for k in KEY], F.col("run").alias("__run")), [*[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEY], F.col("run") < F.col("__run")], "left_semi")
    gone = renamed(cut(stale.union(old).select(*KEY, "run").distinct())).withColumnRenamed("run", "__run")
    return rows.join(small(gone), [*keys(gone), rows["run"] == gone["__run"]], "left_anti").drop("run") if run > 1 else rows.drop("run")


@dataclass(frozen=True)
class Dataset:
    records: DataFrame
    failures: DataFrame
    tiles: DataFrame
    occlusions: DataFrame
    master: DataFrame
    report: DataFrame


def build(spark: SparkSession, manifest: DataFrame, folder: str, config: Config = Config(), source: str = "images", out: str | None = None, resume: bool = False) -> Dataset:
    """All tables of a dataset. Files are read and tiles cut and written here, to `out` or the shared folder; the tables read that.

    resume: only what is new or has changed since earlier runs to the same `out` is decoded and cut (OP2).
    """
    named = cut(roles(manifests.in_splits(manifest, config.active_splits).withColumn("source_dataset", F.lit(source))))
    path, about = out or new_path(spark, "dataset"), cut(facts(spark, named, folder))
    rows = written(spark, named, about, folder, config, path, resume)
    known, best = records(rows, about), tiles(rows)
    ready = best.drop("rgb", "mask").withColumns({"image_path": F.col("tile_id"), "mask_path": F.col("tile_id")})
    with_mask = ready.filter(best["mask"].isNotNull())
    plan = splits.occlusion_plan(with_mask, occlusion.TYPES, occlusion.SEVERITIES, config.occlusion_samples, seed=config.seed).select("tile_id", "occlusion_type", "severity")
    # the plan has as many rows as the configuration says; tiles stay where they are
    done = occlusion.simulate(best.join(small(cut(plan)), "tile_id"), config.seed)
    measured = occlusion.road_width(best, *[c for c in best.columns if c not in ("rgb", "mask")], data="mask")
    paths = {"image_tile_path": F.concat("split", F.lit("/images/"), "tile_id", F.lit(".png")), "mask_tile_path": F.concat("split", F.lit("/masks/"), "tile_id", F.lit(".png"))}
    described = measured.withColumns({"tile_width": F.col("width"), "tile_height": F.col("height"), **paths})
    references = known.filter("is_georeferenced").select(F.col("image_id").alias("source_image_id"), F.col("sat_image_path").alias("reference"))
    table = master.master(described, done.withColumn("ordinal", F.lit(0)), references)
    return Dataset(known, failures(about, known), best, done, table, stats.dataset_report_with_total(known, "source_dataset"))
