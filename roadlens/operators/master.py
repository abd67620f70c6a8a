"""The master table: tiles with their latest occlusion and geographic reference (JN1-2, PRJ2, PRJ4, D6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions import text

COLUMNS = (
    "image_id source_dataset source_image_id image_dimensions road_density avg_road_width_px max_road_width_px road_pixel_pct background_pixel_pct "
    "occlusion_type occlusion_severity occlusion_coverage_pct occlusion_road_coverage_pct split image_tile_path mask_tile_path geospatial_metadata_reference"
).split()


def latest(occlusions: DataFrame, id_col: str = "image_id", ordinal: str = "ordinal") -> DataFrame:
    """The last occlusion of each tile: an aggregate with map-side combine, not a sort of each tile's rows."""
    rest = [c for c in occlusions.columns if c != id_col]
    return occlusions.groupBy(id_col).agg(F.max_by(F.struct(*rest), ordinal).alias("__last")).select(id_col, *[F.col(f"__last.{c}").alias(c) for c in rest])


def master(tiles: DataFrame, occlusions: DataFrame, geo: DataFrame) -> DataFrame:
    """The 17 columns of the master table, one row for each tile.

    occlusions (image_id = the tile's id, ordinal, ...) and geo (source_image_id, reference; one row each) may be of any
    size: Spark broadcasts what its statistics show to be small and shuffles the rest.
    """
    occluded = latest(occlusions).select(F.col("image_id").alias("tile_id"), "occlusion_type", F.col("severity").alias("occlusion_severity"), F.col("coverage_pct").alias("occlusion_coverage_pct"), F.col("road_coverage_pct").alias("occlusion_road_coverage_pct"))
    refs = geo.groupBy("source_image_id").agg(F.max("reference").alias("__ref"))
    out = tiles.join(occluded, "tile_id", "left").join(refs, "source_image_id", "left")
    return out.select(
        F.col("tile_id").alias("image_id"), "source_dataset", "source_image_id",
        text.dimensions(F.col("tile_width"), F.col("tile_height")).alias("image_dimensions"),
        "road_density", "avg_road_width_px", "max_road_width_px",
        F.bround("road_pixel_pct", 4).alias("road_pixel_pct"), F.bround(100.0 - F.col("road_pixel_pct"), 4).alias("background_pixel_pct"),
        "occlusion_type", "occlusion_severity", "occlusion_coverage_pct", "occlusion_road_coverage_pct",
        text.split_name(F.col("split")).alias("split"), "image_tile_path", F.coalesce("mask_tile_path", F.lit("")).alias("mask_tile_path"),
        F.coalesce("__ref", F.lit("")).alias("geospatial_metadata_reference"),
    )


def legacy_csv(master_table: DataFrame) -> DataFrame:
    """The table as text the old way: nulls and zero measures are empty."""
    blank = {"road_density", "avg_road_width_px", "max_road_width_px", "occlusion_coverage_pct", "occlusion_road_coverage_pct"}
    kept = lambda c: F.when(F.col(c) == 0, F.lit("")).otherwise(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in blank else F.coalesce(F.col(c).cast("string"), F.lit(""))
    return master_table.select(*[kept(c).alias(c) for c in master_table.columns])


def occlusion_summary(plan: DataFrame) -> DataFrame:
    """kind, name, n, means and deviation: of each type and each severity, in one pass."""
    sets = plan.groupingSets([["occlusion_type"], ["severity"]], "occlusion_type", "severity").agg(
        F.grouping("occlusion_type").alias("__g"),
        F.count("*").alias("n"),
        F.avg("coverage_pct").alias("coverage_mean"),
        F.stddev_pop("coverage_pct").alias("coverage_std"),
        F.avg("road_coverage_pct").alias("road_coverage_mean"),
    )
    by_type = F.col("__g") == 0
    return sets.select(F.when(by_type, "type").otherwise("severity").alias("kind"), F.when(by_type, F.col("occlusion_type")).otherwise(F.col("severity")).alias("name"), "n", "coverage_mean", "coverage_std", "road_coverage_mean")


def by_severity(rows: DataFrame) -> DataFrame:
    """Count and mean road coverage; a missing coverage counts as 0."""
    return rows.filter(F.col("severity").isNotNull() & (F.col("severity") != "")).groupBy("severity").agg(F.count("*").alias("n"), F.avg(F.coalesce("road_coverage_pct", F.lit(0.0))).alias("road_coverage_mean"))
