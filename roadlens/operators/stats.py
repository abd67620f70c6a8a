"""Statistics of records, tiles and groups (AGG1-13, AGG17-18, AGG20, FIL4-7, VIS1-6, JN7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions import numbers, raster


def four(x: Column, name: str, digits: int | None = None) -> list[Column]:
    """Mean, population deviation, least and greatest of the values that are not null; 0 if there are none."""
    put = (lambda c: F.bround(c, digits)) if digits is not None else (lambda c: c)
    return [F.coalesce(put(f(x).cast("double")), F.lit(0.0)).alias(f"{name}_{n}") for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]


def report_columns(positive_only: bool = False) -> list[Column]:
    """What a dataset report tells of each source or split, over has_mask, invalid, size_bytes and road_pixel_pct."""
    shown = F.col("has_mask") & (F.col("road_pixel_pct") > 0) if positive_only else F.col("has_mask")
    return [
        F.count("*").alias("total_images"),
        F.count_if("has_mask").alias("total_masks"),
        F.count_if(~F.col("has_mask")).alias("missing_masks"),
        F.count_if("invalid").alias("invalid_images"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("total_bytes"),
        *four(F.when(shown, F.col("road_pixel_pct")), "road"),
    ]


def dataset_report(records: DataFrame, by: str) -> DataFrame:
    return records.groupBy(by).agg(*report_columns())


def dataset_report_with_total(records: DataFrame, by: str) -> DataFrame:
    """Each source and, where it is null, all of them: one pass over the records."""
    return records.groupingSets([[by], []], by).agg(*report_columns())


def split_report(records: DataFrame, by: str = "split") -> DataFrame:
    return records.groupBy(by).agg(*report_columns(positive_only=True))


def pair_audit(images: DataFrame, masks: DataFrame, by: str, key: str = "image_id") -> DataFrame:
    """Images, those with and without a mask, surplus copies by content hash, and sizes."""
    marked = images.join(masks.select(key).distinct().withColumn("__m", F.lit(True)), key, "left")
    totals = marked.groupBy(by).agg(F.count("*").alias("total"), F.count("__m").alias("paired"), (F.count("*") - F.count("__m")).alias("unpaired"), F.avg("size_bytes").alias("size_mean"), F.min("size_bytes").alias("size_min"), F.max("size_bytes").alias("size_max"), F.sum("size_bytes").alias("size_total"))
    # two steps, so that a hash that very many rows share is counted where they lie
    copies = images.groupBy(by, "content_hash").count().groupBy(by).agg(F.sum(F.col("count") - 1).alias("duplicates"))
    return totals.join(copies, by)


def histogram(values: DataFrame, column: str, bins: int) -> DataFrame:
    """bin (0 first), low, high, n: equal steps between the least and the greatest value, which is in the last bin.

    The range is one row, so it joins by broadcast; counting is a partial aggregate over at most that many bins.
    """
    x = F.col(column).cast("double")
    known = values.filter(x.isNotNull())
    ends = known.agg(F.min(x).alias("__a"), F.max(x).alias("__b"))
    width = F.when(F.col("__b") > F.col("__a"), (F.col("__b") - F.col("__a")) / bins).otherwise(1.0)
    placed = known.join(F.broadcast(ends)).select(F.least(F.floor((x - F.col("__a")) / width), F.lit(bins - 1)).cast("long").alias("bin"), "__a", width.alias("__w"))
    return placed.groupBy("bin").agg(F.min("__a").alias("a"), F.min("__w").alias("w"), F.count("*").alias("n")).select("bin", (F.col("a") + F.col("bin") * F.col("w")).alias("low"), (F.col("a") + (F.col("bin") + 1) * F.col("w")).alias("high"), "n")


#: Bins of a histogram between a group's least and greatest value.
BINS = 1 << 16


def quantiles(counted: DataFrame, by: list[str], value: str, n: str, qs: list[float]) -> DataFrame:
    """by, quantiles array<double>: exact, with linear interpolation, of values that stand n times each (a row for each by and value).

    A group's values fall into BINS equal bins; running counts over the bins tell in which of them the wanted ranks lie, and
    only the values of these are put in order. So no task holds a group's distinct values; null values do not count.
    """
    x = F.col(value).cast("double")
    known = counted.filter(F.col(value).isNotNull()).select(*by, x.alias("__v"), F.col(n).cast("long").alias("__n"))
    ends = known.groupBy(*by).agg(F.min("__v").alias("__a"), F.max("__v").alias("__b"), F.sum("__n").alias("__all"))
    at = F.when(F.col("__b") > F.col("__a"), F.floor((F.col("__v") - F.col("__a")) / (F.col("__b") - F.col("__a")) * (BINS - 1))).otherwise(0).cast("long")
    placed = known.join(ends, by).select(*by, "__v", "__n", at.alias("__bin"))
    before = lambda keys, order: F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = placed.groupBy(*by, "__bin").agg(F.sum("__n").alias("__n")).withColumn("__before", before(by, "__bin"))
    ranks = F.array(*[F.struct(F.lit(k).alias("__k"), (r := (F.col("__all") - 1) * F.lit(q)).alias("__at"), (F.floor(r) if down else F.ceil(r)).alias("__rank"), F.lit(down).alias("__down")) for k, q in enumerate(qs) for down in (True, False)])
    wanted = ends.select(*by, F.inline(ranks))
    hit = (F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n"))
    in_bins = wanted.join(bins, by).filter(hit).select(*by, "__k", "__at", "__rank", "__down", "__bin", "__before")
    opened = placed.join(in_bins.select(*by, "__bin", "__before").distinct(), [*by, "__bin"])
    opened = opened.withColumn("__before", F.col("__before") + before([*by, "__bin"], "__v"))
    found = in_bins.drop("__before").join(opened, [*by, "__bin"]).filter(hit)
    side = lambda down: F.max(F.when(F.col("__down") == down, F.col("__v")))
    low, high, rank = side(True), side(False), F.max("__at")
    # from the nearer end; equal ends stay what they are
    mixed = F.when(F.floor(rank) == F.ceil(rank), low).otherwise((F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high)
    each = found.groupBy(*by, "__k").agg(mixed.alias("__q"))
    return each.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__q"))), lambda s: s["__q"]).alias("quantiles"))


def percentile_stretch(values: DataFrame, by: str, column: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """by, level, n: how many values of a band fall on each level from 0 to 255 between its two percentiles.

    Percentiles are exact, with linear interpolation, of values counted before.
    """
    counted = values.filter(F.col(column).isNotNull()).groupBy(by, column).agg(F.count("*").alias("__n"))
    ends = quantiles(counted, [by], column, "__n", [low, high])
    level = raster.stretched(F.col(column), F.element_at("quantiles", 1), F.element_at("quantiles", 2))
    return counted.join(ends, by).groupBy(by, level.alias("level")).agg(F.sum("__n").alias("n"))


def quality(tiles: DataFrame) -> DataFrame:
    """Statistics of tiles' road share, density and widths. Nulls never count; a greatest width of 0 doesn't either."""
    widest = F.when(F.col("max_road_width_px") != 0, F.col("max_road_width_px"))
    return tiles.agg(F.count("*").alias("tiles"), *four(F.col("road_pixel_pct"), "road"), *four(F.col("avg_road_width_px"), "width"), *four(widest, "widest"), *four(F.col("road_density"), "density"))


def class_imbalance(tiles: DataFrame, *by: str) -> DataFrame:
    road = F.coalesce(F.avg("road_pixel_pct"), F.lit(0.0))
    rest = F.coalesce(F.avg(100.0 - F.col("road_pixel_pct")), F.lit(100.0))
    out = tiles.groupBy(*by).agg(road.alias("road_mean"), rest.alias("background_mean"))
    ratio = numbers.imbalance(F.col("background_mean"), F.col("road_mean"))
    return out.withColumns({"ratio": ratio, "recommendation": numbers.advice(ratio)})


def split_counts(tiles: DataFrame, names: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """One row: the number of tiles of each named split, 0 for those without any."""
    return tiles.agg(*[F.count_if(F.col("split") == n).alias(n) for n in names])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def source_matrix(tiles: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Tiles of each source in each split, 0 where there are none."""
    return tiles.groupBy("source_dataset").agg(*[F.count_if(F.col("split") == s).alias(s) for s in splits])


def missing_masks(images: DataFrame, masks: DataFrame, key: str = "image_id") -> DataFrame:
    return images.join(masks.select(key), key, "left_anti")


def coverage(rasters: DataFrame, occluded: Column, road: Column, *by: str) -> DataFrame:
    """Share of pixels occluded, and share of road pixels occluded (0 without road), of rasters in their rows."""
    both = F.zip_with(occluded, road, lambda o, r: F.when((o > 0) & (r > 0), 1).otherwise(0))
    return rasters.select(*by, numbers.percentage(raster.positives(occluded), F.size(occluded)).alias("coverage_pct"), numbers.percentage(raster.positives(both), raster.positives(road)).alias("road_coverage_pct"))


def scatter(tiles: DataFrame, x: str = "road_density", y: str = "road_pixel_pct") -> DataFrame:
    """x and y of the tiles that have both (VIS5)."""
    return tiles.select(x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())


def panel(rows: DataFrame, by: list[str], order: list, n: int = 1) -> DataFrame:
    """The first n rows of each group: what a panel of examples shows (VIS8-9). Each task keeps n rows of a group."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("__place", place).filter(F.col("__place") <= n).drop("__place")
