"""Tiles of images: windows, keep rules, the best of each image and their statistics (RAS8-10, FIL2, TOP1-2, AGG10, SRC19, JN4-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions import raster, text

TILE, STRIDE, MIN_ROAD, MIN_SPREAD, CAP = 512, 256, 0.01, 5.0, 6


def windows(rasters: DataFrame, height: int, width: int, tile: int, stride: int, data: str = "data") -> DataFrame:
    """One row per window of each raster, row by row: row, col, x_start, y_start, x_end, y_end, window.

    Rasters are padded by reflection to whole windows first. A raster's windows are made where it lies; nothing is
    shuffled.
    """
    full = lambda n: n if n == tile else tile if n < tile else tile + -(-(n - tile) // stride) * stride
    h, w = full(height), full(width)
    padded = F.col(data) if (h, w) == (height, width) else raster.padded(F.col(data), height, width, h, w)
    spots = F.array(*[F.struct(*[F.lit(v).cast("long").alias(k) for k, v in (("row", y // stride), ("col", x // stride), ("x_start", x), ("y_start", y), ("x_end", x + tile), ("y_end", y + tile))]) for y in range(0, h - tile + 1, stride) for x in range(0, w - tile + 1, stride)])
    cut = rasters.withColumn("__padded", padded).select("*", F.inline(spots))
    return cut.withColumn("window", raster.window(F.col("__padded"), w, F.col("y_start"), F.col("x_start"), tile)).drop("__padded")


def discard_reason(road_pct: Column, spread: Column, min_road: float = MIN_ROAD, min_spread: float = MIN_SPREAD) -> Column:
    """Null for tiles that stay; the limits themselves are enough to stay."""
    return F.when(road_pct < min_road, "low_road").when(spread < min_spread, "low_std")


def judged(tiles: DataFrame, min_road: float = MIN_ROAD, min_spread: float = MIN_SPREAD) -> DataFrame:
    reason = discard_reason(F.col("road_pixel_pct"), F.col("image_std"), min_road, min_spread)
    return tiles.withColumns({"discard_reason": reason, "valid": reason.isNull()})


def ranked(tiles: DataFrame, order: list[str], image: str = "image_id") -> DataFrame:
    """Adds place: 1 for the tile of an image with most road; ties go by the order of the windows."""
    by = Window.partitionBy(image).orderBy(F.desc("road_pixel_pct"), *order)
    return tiles.withColumn("place", F.row_number().over(by).cast("long"))


def best(tiles: DataFrame, order: list[str], cap: int = CAP, min_road: float = MIN_ROAD, min_spread: float = MIN_SPREAD) -> DataFrame:
    """The tiles that pass the keep rule, at most cap to an image."""
    good = tiles.filter((F.col("road_pixel_pct") >= min_road) & (F.col("image_std") >= min_spread))
    return ranked(good, order).filter(F.col("place") <= cap)


def statistics(tiles: DataFrame, order: list[str], cap: int = CAP, min_road: float = MIN_ROAD, min_spread: float = MIN_SPREAD, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and road statistics of one tiling.

    windows_total counts every window; windows that an image's cap cuts are in tiles_capped and not in generated.
    """
    judged_ = judged(tiles, min_road, min_spread)
    # ranking within (image, valid) leaves the ranks of valid tiles as they are without a second pass
    place = F.row_number().over(Window.partitionBy("image_id", "valid").orderBy(F.desc("road_pixel_pct"), *order))
    kept = F.col("valid") & (F.col("place") <= cap)
    road = F.when(kept, F.col("road_pixel_pct"))
    out = judged_.withColumn("place", place).groupBy(*by).agg(
        F.count("*").alias("windows_total"),
        F.count_if("valid").alias("valid"),
        F.count_if(kept).alias("kept"),
        F.count_if(~F.col("valid")).alias("discarded"),
        *[F.coalesce(f(road), F.lit(0.0)).alias(n) for n, f in (("road_mean", F.avg), ("road_std", F.stddev_pop), ("road_min", F.min), ("road_max", F.max))],
    )
    generated = F.col("kept") + F.col("discarded")
    return out.withColumns({"tiles_capped": F.col("valid") - F.col("kept"), "generated": generated, "keep_rate": F.when(generated > 0, F.col("kept") / generated * 100.0).otherwise(0.0)})


def first_images(tiles: DataFrame, n: int, ordinal: str) -> DataFrame:
    """The ids of the first n images in the order in which their tiles come."""
    return tiles.groupBy("image_id").agg(F.min(ordinal).alias("first")).orderBy("first", "image_id").limit(n)


def of_images(tiles: DataFrame, images: DataFrame) -> DataFrame:
    return tiles.join(images.select("image_id"), "image_id", "left_semi")


def rehydrated(tiles: DataFrame, dimensions: str = "image_dimensions", tile: str = "tile_id", stride: int = STRIDE, spread: float = 15.0) -> DataFrame:
    """Tiles read back from the master table: size from its text, row and column from the id, places from those."""
    size = F.split(dimensions, "x")
    side = lambda k: F.coalesce(F.try_element_at(size, F.lit(k)).try_cast("bigint"), F.lit(TILE).cast("bigint"))
    row, col = text.index_in(F.col(tile), "r", 2), text.index_in(F.col(tile), "c", 1)
    return tiles.withColumns({"tile_width": side(1), "tile_height": side(2), "row": row, "col": col, "x_start": col * stride, "y_start": row * stride, "x_end": col * stride + side(1), "y_end": row * stride + side(2), "image_std": F.lit(spread), "kept": F.lit(True)})
