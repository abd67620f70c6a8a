"""Tables of images and masks from manifests, listings and other tables (SRC1-10, SRC20, SRC22-23, JN3, FIL1)."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.errors import SourceError
from roadlens.functions import numbers, text

#: Fixed values, best first.
IMAGE_EXTENSIONS = (".tif", ".tiff", ".png", ".jpg", ".jpeg")
MASK_EXTENSIONS = (".png", ".tif", ".tiff", ".jpg", ".jpeg")
MANIFEST = "image_id string, split string, sat_image_path string, mask_path string"

log = logging.getLogger(__name__)
_SCANNERS: dict[str, Callable[..., DataFrame]] = {}


def scanner(name: str):
    """Registers a function (spark, settings) -> DataFrame under an adapter's name."""

    def put(f):
        _SCANNERS[name.strip().lower()] = f
        return f

    return put


def scan(spark: SparkSession, sources: dict[str, dict]) -> DataFrame:
    """The records of all sources with enabled: true, one under another; unknown adapters are scanned as plain folders.

    Sources that fail when they are set up are left out, and each is logged as an error; `failures` names them. If none is
    left, SourceError names the reasons.
    """
    parts, failed = _scanned(spark, sources)
    for name, reason in failed.items():
        log.error("source %s cannot be read: %s", name, reason)
    if not parts:
        raise SourceError("no source can be read: " + ("; ".join(f"{k}: {v}" for k, v in failed.items()) or "none is enabled"))
    return combined(parts)


def failures(spark: SparkSession, sources: dict[str, dict]) -> DataFrame:
    """source_dataset, reason of the enabled sources that cannot be set up."""
    return spark.createDataFrame(list(_scanned(spark, sources)[1].items()), "source_dataset string, reason string")


def _scanned(spark: SparkSession, sources: dict[str, dict]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    parts, failed = {}, {}
    for name, settings in sources.items():
        if not settings.get("enabled", False):
            continue
        try:
            parts[name] = _SCANNERS.get(str(settings.get("adapter", "folder")).strip().lower(), _SCANNERS["folder"])(spark, settings)
        except Exception as e:  # whatever is wrong with one source, the others go on
            failed[name] = str(e).splitlines()[0]
    return parts, failed


def combined(parts: dict[str, DataFrame]) -> DataFrame:
    """The rows of named sources, one under another, with source_dataset; what a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("source_dataset", F.lit(name)) for name, df in parts.items()])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV manifest with its four columns trimmed and splits by their usual names."""
    return cleaned(spark.read.schema(MANIFEST).csv(path, header=True))


def cleaned(rows: DataFrame) -> DataFrame:
    """Manifest rows with their texts trimmed and their splits by the usual names."""
    return rows.withColumns({c: F.trim(c) for c, kind in rows.dtypes if kind == "string"}).withColumn("split", text.split_name(F.col("split")))


def in_splits(records: DataFrame, splits: tuple[str, ...] = ("train",)) -> DataFrame:
    """Records of the splits asked for; on a partitioned table only their folders are read."""
    return records.filter(F.col("split").isin(*splits))


def listing(spark: SparkSession, folder: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> DataFrame:
    """path, size_bytes of the files below a folder with one of the extensions, in any case. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("size_bytes")).filter(text.extension(F.col("path")).isin(*extensions))


def present(spark: SparkSession, folders: dict[str, str]) -> dict[str, bool]:
    """Whether each named folder holds any image; a folder that is not there does not."""
    out = {}
    for name, folder in folders.items():
        try:
            out[name] = listing(spark, folder).limit(1).count() > 0
        except AnalysisException:
            out[name] = False
    return out


def discovered(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest of the pairs {id}_sat.jpg and {id}_mask.png below {folder}/{split}."""
    files = listing(spark, folder).withColumns({"split": F.element_at(F.split("path", "/"), -2), "__name": text.basename(F.col("path"))})
    part = lambda ending: F.regexp_extract("__name", f"^(.+){ending}$", 1)
    images = files.withColumn("image_id", part(r"_sat\.jpg")).filter("image_id <> ''").select("image_id", "split", F.col("path").alias("sat_image_path"))
    masks = files.withColumn("image_id", part(r"_mask\.png")).filter("image_id <> ''").select("image_id", "split", F.col("path").alias("mask_path"))
    return images.join(masks, ["image_id", "split"], "left").withColumn("split", text.split_name(F.col("split")))


def paired(images: DataFrame, masks: DataFrame, key: str = "image_id", order: tuple[str, ...] = MASK_EXTENSIONS) -> DataFrame:
    """images with mask_path: of the masks of the same stem the one whose extension comes first, null if there is none.

    The choice is an aggregate over masks, so a stem with very many of them is merged where they lie.
    """
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), text.extension(F.col("path"))), F.lit(0)), F.lit(len(order) + 1))
    chosen = masks.groupBy(key).agg(F.min(F.struct(rank.alias("r"), "path"))["path"].alias("mask_path"))
    return images.join(chosen, key, "left")


def errors(**checks: Column) -> Column:
    """The names of the checks that hold, in order; a check that is null doesn't."""
    return F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in checks.items()]))


def validated(records: DataFrame) -> DataFrame:
    """Adds has_mask, road_pixel_pct and validation_errors.

    records: width, height, mask_width, mask_height, road_pixel_count, size_bytes; rows without an image (null width)
    go. A mask that cannot be read has null sizes.
    """
    there = records.filter(F.col("width").isNotNull())
    listed, read = F.col("mask_path").isNotNull(), F.col("mask_width").isNotNull()
    total = F.col("width").cast("long") * F.col("height")
    found = errors(
        mask_unreadable=listed & ~read,
        size_mismatch=read & ((F.col("mask_width") != F.col("width")) | (F.col("mask_height") != F.col("height"))),
        empty_file=F.col("size_bytes") == 0,
    )
    return there.withColumns({"has_mask": read, "total_pixel_count": total, "road_pixel_pct": F.when(read, numbers.percentage(F.col("road_pixel_count"), total)).otherwise(0.0), "validation_errors": found})


def resolved(rows: DataFrame, existing: DataFrame, candidates: list[Column], key: str) -> DataFrame:
    """Adds path: the first candidate that is listed in existing (path), else the first candidate.

    One join on exploded candidates instead of one for each.
    """
    tried = rows.select(key, F.posexplode(F.array(*candidates)).alias("__k", "__path"))
    there = tried.join(existing.select(F.col("path").alias("__path")).distinct(), "__path", "left_semi")
    best = there.groupBy(key).agg(F.min_by("__path", "__k").alias("__found"))
    return rows.join(best, key, "left").withColumn("path", F.coalesce("__found", candidates[0])).drop("__found")


@scanner("folder")
def _folder(spark: SparkSession, settings: dict) -> DataFrame:
    images = listing(spark, settings["images"]).withColumn("image_id", text.image_id(F.col("path"))).withColumnRenamed("path", "sat_image_path")
    masks = listing(spark, settings["masks"], MASK_EXTENSIONS).withColumn("image_id", F.regexp_replace(text.stem(F.col("path")), "_mask$", "")) if settings.get("masks") else None
    out = paired(images, masks) if masks is not None else images.withColumn("mask_path", F.lit(None).cast("string"))
    return out.withColumn("split", F.lit(settings.get("split", "train")))


@scanner("manifest")
def _manifest(spark: SparkSession, settings: dict) -> DataFrame:
    rows = manifest(spark, settings["path"]) if settings.get("path") else discovered(spark, settings["folder"])
    return in_splits(rows, tuple(settings.get("splits", ("train",))))
