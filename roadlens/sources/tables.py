"""Reading and writing the library's tables (SNK1, SNK4-5, SNK7, SRC14, D6-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASTER = (
    "image_id string, source_dataset string, source_image_id string, image_dimensions string, road_density double, avg_road_width_px double, max_road_width_px double, road_pixel_pct double, "
    "background_pixel_pct double, occlusion_type string, occlusion_severity string, occlusion_coverage_pct double, occlusion_road_coverage_pct double, split string, image_tile_path string, mask_tile_path string, geospatial_metadata_reference string"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_master(master: DataFrame, path: str) -> None:
    """Parquet for work, partitioned by split, and CSV for people."""
    master.write.mode("overwrite").partitionBy("split").parquet(f"{path}/parquet")
    master.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """From CSV by its schema: no pass over the data to guess types."""
    return spark.read.schema(MASTER).csv(path, header=True)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row, or a few, as JSON lines."""
    report.select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


SPLIT = "tile_id source_dataset source_image_id image_tile_path mask_tile_path road_pixel_pct image_std row col split".split()


def split_metadata(tiles: DataFrame, seed: int, ratios: tuple[float, float, float], stratified: bool = True) -> DataFrame:
    """One row: seed, ratios, tiles of each split and in all, and a map of sources to their tiles for each split."""
    names = ("train", "val", "test")
    per = tiles.groupBy("split", "source_dataset").count()
    of = lambda s: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("split") == s, F.struct("source_dataset", "count")))))  # noqa: E731  # a row for each source
    number = lambda s: F.coalesce(F.sum(F.when(F.col("split") == s, F.col("count"))), F.lit(0))
    counts = F.struct(*[number(s).alias(s) for s in names], F.coalesce(F.sum("count"), F.lit(0)).alias("total")).alias("counts")
    return per.agg(counts, F.struct(*[of(s).alias(s) for s in names]).alias("source_distribution")).select(
        F.lit(seed).alias("random_seed"), *[F.lit(r).alias(f"{n}_ratio") for n, r in zip(names, ratios)], F.lit(stratified).alias("stratified"), "counts", "source_distribution"
    )


def write_splits(tiles: DataFrame, path: str, seed: int = 42, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), stratified: bool = True) -> None:
    """The ten columns of a split table as CSV in a folder for each split, and the split metadata as JSON (SNK5)."""
    rounded = tiles.select(*[F.round(c, 4).alias(c) if c in ("road_pixel_pct", "image_std") else F.coalesce(c, F.lit("")).alias(c) if c == "mask_tile_path" else F.col(c) for c in SPLIT])
    rounded.write.mode("overwrite").partitionBy("split").option("header", True).csv(f"{path}/tiles")
    write_report(split_metadata(tiles, seed, ratios, stratified), f"{path}/split_metadata")


HISTORY = "epoch int, train_loss double, val_loss double, val_dice double, val_iou double, val_precision double, val_recall double, learning_rate double"


def append_history(spark: SparkSession, rows: list[dict], path: str) -> None:
    """Appends epochs to a training history; an epoch written again stands beside its first writing (SNK8)."""
    spark.createDataFrame(rows, HISTORY).write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path)


def next_experiment(names: DataFrame, column: str = "name") -> DataFrame:
    """name: experiment_NNN with the number after the highest of such names, 001 if there is none (ML9); one row."""
    number = F.regexp_extract(column, "^experiment_([0-9]+)", 1).try_cast("int")
    return names.agg(F.format_string("experiment_%03d", F.coalesce(F.max(number), F.lit(0)) + 1).alias("name"))


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def property_of(column: str, key: str, default: float, kind: str = "double"):
    """A field of a JSON text, or a default where it lacks it."""
    return F.coalesce(F.get_json_object(column, f"$.{key}").try_cast(kind), F.lit(default).cast(kind))
