"""Queries on tiles, splits, sampling and the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import raster, text
from roadlens.operators import master, occlusion, splits, stats, tiling
from roadlens.sources import tables
from roadlens.sources.tables import table

from .registry import IMAGES, ORDER, TILES, four_sql, images, query, rounded, tiles

MIN_ROAD, MIN_SPREAD, CAP = 2000.0, 5.0, 6
GOOD = f"road_pixel_pct >= {MIN_ROAD} AND image_std >= {MIN_SPREAD}"
ORDER_SQL = '"row", col, part, supp'
STATS_SQL = f"""count(*) AS windows_total, count(*) FILTER (good) AS valid, count(*) FILTER (good AND place <= {CAP}) AS kept, count(*) FILTER (NOT good) AS discarded,
  {four_sql(f"CASE WHEN good AND place <= {CAP} THEN road_pixel_pct END", "road", 4)}, count(*) FILTER (good) - count(*) FILTER (good AND place <= {CAP}) AS tiles_capped,
  count(*) FILTER (good AND place <= {CAP}) + count(*) FILTER (NOT good) AS "generated", round(count(*) FILTER (good AND place <= {CAP}) * 100.0::DOUBLE / (count(*) FILTER (good AND place <= {CAP}) + count(*) FILTER (NOT good)), 4) AS keep_rate"""
PLACED = f"""g AS (SELECT *, {GOOD} AS good FROM tiles), r AS (SELECT *, row_number() OVER (PARTITION BY image_id, good ORDER BY road_pixel_pct DESC, {ORDER_SQL}) AS place FROM g)"""


@query(f"""WITH {TILES} SELECT image_id, tile_id, road_pixel_pct, place FROM
  (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY road_pixel_pct DESC, {ORDER_SQL}) AS place FROM tiles WHERE {GOOD}) WHERE place <= {CAP}""")
def q_tile_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP1, FIL2, RAS10: the tiles with most road of every image."""
    return tiling.best(tiles(spark, sf_dir), ORDER, CAP, MIN_ROAD, MIN_SPREAD).select("image_id", "tile_id", "road_pixel_pct", "place")


@query(f"""WITH {TILES} SELECT coalesce(CASE WHEN road_pixel_pct < {MIN_ROAD} THEN 'low_road' WHEN image_std < {MIN_SPREAD} THEN 'low_std' END, 'kept') AS reason, count(*) AS n FROM tiles GROUP BY 1""")
def q_tile_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL2: how many tiles stay, and why others go."""
    return tiling.judged(tiles(spark, sf_dir), MIN_ROAD, MIN_SPREAD).groupBy(F.coalesce("discard_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {TILES}, {PLACED} SELECT {STATS_SQL} FROM r")
def q_tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10, PRJ6: statistics of one tiling, with the windows that the cap cuts."""
    return rounded(tiling.statistics(tiles(spark, sf_dir), ORDER, CAP, MIN_ROAD, MIN_SPREAD), 4)


@query(f"WITH {TILES}, {IMAGES}, {PLACED} SELECT split, {STATS_SQL} FROM r JOIN (SELECT image_id, split FROM images) i USING (image_id) GROUP BY split")
def q_tile_stats_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG10: the same by split."""
    both = tiles(spark, sf_dir).join(images(spark, sf_dir).select("image_id", "split"), "image_id")
    return rounded(tiling.statistics(both, ORDER, CAP, MIN_ROAD, MIN_SPREAD, by=("split",)), 4)


@query("""SELECT doc_id, CASE WHEN n_chars <= 512 THEN 512 ELSE 512 + ceil((n_chars - 512) / 256.0)::BIGINT * 256 END::BIGINT AS padded,
  (CASE WHEN n_chars <= 512 THEN 512 ELSE 512 + ceil((n_chars - 512) / 256.0)::BIGINT * 256 END - 512)::BIGINT // 256 + 1 AS windows FROM documents""")
def q_pad_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS6: the padded size and number of windows of a dimension."""
    size = raster.padded_size(F.col("n_chars"), 512, 256)
    return table(spark, sf_dir, "documents").select("doc_id", size.alias("padded"), raster.window_count(size, 512, 256).alias("windows"))


@query(f"WITH {TILES} SELECT image_id, part, supp, printf('%s_%s_r%03d_c%03d', 'train', image_id::VARCHAR, \"row\", col) AS tile FROM tiles")
def q_tile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ3: the ids of tiles."""
    return tiles(spark, sf_dir).select("image_id", "part", "supp", text.tile_id(F.lit("train"), F.col("image_id"), F.col("row"), F.col("col")).alias("tile"))


@query(f"""WITH {TILES} SELECT tile_id, CASE WHEN image_id % 10 = 0 THEN 0 ELSE "row" END AS "row", col, CASE WHEN image_id % 10 = 0 THEN 0 ELSE "row" END * 256 AS y_start, col * 256 AS x_start,
  CASE WHEN image_id % 7 = 0 THEN 512 ELSE 256 END::BIGINT AS tile_width, 512::BIGINT AS tile_height, col * 256 + CASE WHEN image_id % 7 = 0 THEN 512 ELSE 256 END AS x_end, 15.0::DOUBLE AS image_std FROM tiles""")
def q_rehydrate_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC19, FN2: tiles read back from ids and sizes as text; parts that are no number count as 0, sizes as 512."""
    src = tiles(spark, sf_dir)
    name = text.tile_id(F.lit("train"), F.col("image_id"), F.col("row"), F.col("col"))
    name = F.when(F.col("image_id") % 10 == 0, F.regexp_replace(name, "_r0", "_rz")).otherwise(name)
    size = F.when(F.col("image_id") % 7 == 0, F.lit("?x")).otherwise(F.lit("256x512"))
    written = src.select(F.col("tile_id").alias("id"), name.alias("tile_id"), size.alias("image_dimensions"))
    return tiling.rehydrated(written).select(F.col("id").alias("tile_id"), "row", "col", "y_start", "x_start", "tile_width", "tile_height", "x_end", "image_std")


@query(f"""WITH {TILES}, f AS (SELECT image_id FROM tiles GROUP BY 1 ORDER BY min(road_pixel_pct), image_id LIMIT 3) SELECT image_id, tile_id FROM tiles WHERE image_id IN (SELECT image_id FROM f)""")
def q_tiles_of_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP2, JN4-5, VIS7: the tiles of the first three images."""
    src = tiles(spark, sf_dir)
    return tiling.of_images(src, tiling.first_images(src, 3, "road_pixel_pct")).select("image_id", "tile_id")


KEYED = f"{TILES}, k AS (SELECT *, md5('42:' || tile_id) AS h FROM tiles)"
PLAN = f"""{KEYED}, s AS (SELECT *, row_number() OVER (ORDER BY h, tile_id) - 1 AS i FROM k ORDER BY h, tile_id LIMIT 20),
  plan AS (SELECT tile_id, i, (['tree_canopy', 'building_shadow', 'vehicle', 'cloud_cover'])[i % 4 + 1] AS occlusion_type, (['light', 'medium', 'heavy'])[i % 3 + 1] AS severity, image_std AS coverage_pct, share * 100 AS road_coverage_pct FROM s)"""


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = tiles(spark, sf_dir).withColumns({"image_path": F.lit("i"), "mask_path": F.lit("m")})
    return splits.occlusion_plan(ready, occlusion.TYPES, occlusion.SEVERITIES).withColumns({"coverage_pct": F.col("image_std"), "road_coverage_pct": F.col("share") * 100})


@query(f"WITH {PLAN} SELECT tile_id, i, occlusion_type, severity FROM plan")
def q_occlusion_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SMP1-2, FIL3: twenty tiles by hash order; types and severities take turns."""
    return planned(spark, sf_dir).select("tile_id", "i", "occlusion_type", "severity")


@query(f"WITH {PLAN} SELECT 'type' AS kind, occlusion_type AS name, count(*) AS n, round(avg(coverage_pct), 4) AS coverage_mean, round(stddev_pop(coverage_pct), 4) AS coverage_std, round(avg(road_coverage_pct), 4) AS road_coverage_mean FROM plan GROUP BY 2 UNION ALL SELECT 'severity', severity, count(*), round(avg(coverage_pct), 4), round(stddev_pop(coverage_pct), 4), round(avg(road_coverage_pct), 4) FROM plan GROUP BY 2")
def q_occlusion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: summaries by type and by severity in one pass."""
    return rounded(master.occlusion_summary(planned(spark, sf_dir)), 4)


@query(f"WITH {PLAN} SELECT severity, count(*) AS n, round(avg(coalesce(road_coverage_pct, 0)), 4) AS road_coverage_mean FROM plan GROUP BY 1")
def q_occlusion_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7, VIS6."""
    return rounded(master.by_severity(planned(spark, sf_dir)), 4)


@query(f"WITH {PLAN} SELECT occlusion_type, severity, round(avg(coverage_pct), 2) AS coverage_mean FROM plan GROUP BY 1, 2")
def q_occlusion_2key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG9."""
    return rounded(planned(spark, sf_dir).groupBy("occlusion_type", "severity").agg(F.avg("coverage_pct").alias("coverage_mean")), 2)


def _u(k: int) -> str:
    return f"('0x' || substr(md5('42:' || tile_id || ':{k}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


@query(f"""WITH {TILES} SELECT tile_id, {_u(0)} <= 0.5 AS occluded, CASE WHEN {_u(0)} <= 0.5 THEN (['tree_canopy', 'building_shadow', 'vehicle', 'cloud_cover'])[floor({_u(1)} * 4)::INT + 1] END AS occlusion_type,
  CASE WHEN {_u(0)} <= 0.5 THEN (['light', 'medium', 'heavy'])[floor({_u(2)} * 3)::INT + 1] END AS severity FROM tiles""")
def q_occlusion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SMP3: which tiles are occluded while training, and how."""
    return splits.occlusion_gate(tiles(spark, sf_dir), occlusion.TYPES, occlusion.SEVERITIES).select("tile_id", "occluded", "occlusion_type", "severity")


@query(f"""WITH {IMAGES}, r AS (SELECT image_id, source_dataset, row_number() OVER (PARTITION BY source_dataset ORDER BY md5('42:' || image_id), image_id) - 1 AS place, count(*) OVER (PARTITION BY source_dataset) AS n FROM images),
  s AS (SELECT *, greatest(1, floor(n * 0.7::DOUBLE)::BIGINT) AS a, greatest(1, floor(n * 0.15::DOUBLE)::BIGINT) AS b0 FROM r), t AS (SELECT *, CASE WHEN n - a - b0 < 0 THEN greatest(0, n - a) ELSE b0 END AS b FROM s)
  SELECT image_id, source_dataset, CASE WHEN place < a THEN 'train' WHEN place < a + b THEN 'val' ELSE 'test' END AS split FROM t""")
def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SPL1, SPL4: images of every source dealt to splits."""
    return splits.stratified(images(spark, sf_dir).select("image_id", "source_dataset"), "source_dataset", "image_id")


SIMPLE = f"""{TILES}, p AS (SELECT image_id, tile_id, row_number() OVER (ORDER BY md5('42:' || tile_id), tile_id) - 1 AS place, count(*) OVER () AS n FROM tiles),
  simple AS (SELECT image_id, tile_id, CASE WHEN place < floor(n * 0.7::DOUBLE) THEN 'train' WHEN place < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM p)"""


def simply_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.simple(tiles(spark, sf_dir).select("image_id", "tile_id"), "tile_id")


@query(f"WITH {SIMPLE} SELECT image_id, tile_id, split FROM simple")
def q_simple_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SPL2: all tiles in one shuffled order, without sorting them in one place."""
    return simply_split(spark, sf_dir)


@query(f"""WITH {SIMPLE}, x AS (SELECT 'tile' AS level, tile_id AS k, split FROM simple UNION ALL SELECT 'image', image_id::VARCHAR, split FROM simple),
  s AS (SELECT level, k, max((split = 'train')::INT) AS a, max((split = 'val')::INT) AS b, max((split = 'test')::INT) AS c FROM x GROUP BY 1, 2)
  SELECT level, 'train_val' AS pair, sum(a * b)::BIGINT AS shared FROM s GROUP BY 1 UNION ALL SELECT level, 'train_test', sum(a * c)::BIGINT FROM s GROUP BY 1 UNION ALL SELECT level, 'val_test', sum(b * c)::BIGINT FROM s GROUP BY 1""")
def q_leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET2: splits by tile share no tiles, but images."""
    level = lambda name, key: F.struct(F.lit(name).alias("level"), F.col(key).cast("string").alias("key"))
    rows = simply_split(spark, sf_dir).select("split", F.inline(F.array(level("tile", "tile_id"), level("image", "image_id"))))
    return splits.leakage(rows, "key", by=("level",))


@query(f"""WITH {TILES}, i AS (SELECT DISTINCT image_id FROM tiles), p AS (SELECT image_id, row_number() OVER (ORDER BY md5('42:' || image_id), image_id) - 1 AS place, count(*) OVER () AS n FROM i)
  SELECT tile_id, image_id, CASE WHEN place < floor(n * 0.85::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM tiles JOIN p USING (image_id)""")
def q_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SPL3-4, JN6, SET4, AGG13: tiles of an image stay together."""
    return splits.by_group(tiles(spark, sf_dir).select("tile_id", "image_id"), "image_id").select("tile_id", "image_id", "split")


@query(f"WITH {TILES} SELECT tile_id, road_pixel_pct FROM tiles ORDER BY road_pixel_pct DESC, tile_id LIMIT 10")
def q_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP3, VIS8-9: the ten tiles that a panel shows."""
    return tiles(spark, sf_dir).select("tile_id", "road_pixel_pct").orderBy(F.desc("road_pixel_pct"), "tile_id").limit(10)


@query(f"WITH {TILES} SELECT share AS road_density, road_pixel_pct FROM tiles WHERE share <> 0")
def q_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIS5: density against share, where there is a density."""
    return stats.scatter(tiles(spark, sf_dir).withColumn("road_density", F.nullif("share", F.lit(0.0))))


@query(f"WITH {TILES} SELECT flag, status, tile_id, road_pixel_pct FROM (SELECT *, row_number() OVER (PARTITION BY flag, status ORDER BY road_pixel_pct DESC, tile_id) AS k FROM tiles) WHERE k <= 3")
def q_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VIS8-9: three examples of each type and severity."""
    return stats.panel(tiles(spark, sf_dir).select("flag", "status", "tile_id", "road_pixel_pct"), ["flag", "status"], [F.desc("road_pixel_pct"), "tile_id"], 3)


@query(f"""WITH {IMAGES} SELECT 42::BIGINT AS random_seed, count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test,
  count(*) FILTER (split = 'val' AND source_dataset = '1-URGENT') AS urgent_val FROM images""")
def q_split_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5: the metadata of a split, as it is written beside the tables."""
    out = tables.split_metadata(images(spark, sf_dir), 42, (0.7, 0.15, 0.15))
    return rounded(out.select("random_seed", "counts.total", "counts.train", "counts.val", "counts.test", F.element_at("source_distribution.val", F.lit("1-URGENT")).alias("urgent_val")))


@query(f"""WITH {TILES} SELECT count(*) AS tiles, {four_sql("road_pixel_pct", "road", 4)}, {four_sql("nullif(tax, 0)", "width")}, {four_sql("nullif(share, 0)", "widest")}, {four_sql("image_std", "density")} FROM tiles""")
def q_quality_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5, FIL5-6: nulls never count, a greatest width of 0 doesn't either."""
    src = tiles(spark, sf_dir).select("road_pixel_pct", F.nullif("tax", F.lit(0.0)).alias("avg_road_width_px"), F.col("share").alias("max_road_width_px"), F.col("image_std").alias("road_density"))
    out = rounded(stats.quality(src), 6)
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.startswith("road_")})


@query(f"""WITH {TILES} SELECT flag, status, round(avg(share * 100), 6) AS road_mean, round(avg(100 - share * 100), 6) AS background_mean, round(avg(100 - share * 100) / greatest(avg(share * 100), 1e-6), 6) AS ratio,
  CASE WHEN avg(100 - share * 100) / greatest(avg(share * 100), 1e-6) > 10 THEN 'severe' WHEN avg(100 - share * 100) / greatest(avg(share * 100), 1e-6) > 5 THEN 'moderate' ELSE 'acceptable' END AS recommendation FROM tiles GROUP BY 1, 2""")
def q_class_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ7, VIS2."""
    return rounded(stats.class_imbalance(tiles(spark, sf_dir).withColumn("road_pixel_pct", F.col("share") * 100), "flag", "status"))


@query(f"""WITH {IMAGES}, o AS (SELECT l_orderkey AS k, arg_max(l_returnflag, l_extendedprice) AS t, arg_max(l_linestatus, l_extendedprice) AS s, arg_max(l_quantity, l_extendedprice) AS c, arg_max(l_discount * 100, l_extendedprice) AS r FROM lineitem GROUP BY 1),
  g AS (SELECT c_custkey AS k, c_name AS ref FROM customer WHERE c_nationkey < 10)
  SELECT printf('t%d', image_id) AS image_id, source_dataset, source_image_id, '512x512' AS image_dimensions, NULL::DOUBLE AS road_density, 7.5::DOUBLE AS avg_road_width_px, 9.0::DOUBLE AS max_road_width_px, road_pixel_pct, 100 - road_pixel_pct AS background_pixel_pct,
  t AS occlusion_type, s AS occlusion_severity, c AS occlusion_coverage_pct, round(r, 6) AS occlusion_road_coverage_pct, split, 'tiles/' || image_id || '.jpg' AS image_tile_path, '' AS mask_tile_path, coalesce(ref, '') AS geospatial_metadata_reference
  FROM images LEFT JOIN o ON image_id = o.k LEFT JOIN g ON source_image_id = g.k""")
def q_master_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1-2, PRJ2, PRJ4: the 17 columns of the master table."""
    name = lambda c: F.format_string("t%d", c)
    tile_rows = images(spark, sf_dir).withColumns({
        "tile_id": name(F.col("image_id")), "tile_width": F.lit(512), "tile_height": F.lit(512), "road_density": F.lit(None).cast("double"), "avg_road_width_px": F.lit(7.5), "max_road_width_px": F.lit(9.0),
        "image_tile_path": F.concat(F.lit("tiles/"), F.col("image_id").cast("string"), F.lit(".jpg")), "mask_tile_path": F.lit(None).cast("string"),
    })
    occlusions = table(spark, sf_dir, "lineitem").select(name(F.col("l_orderkey")).alias("image_id"), F.col("l_extendedprice").alias("ordinal"), F.col("l_returnflag").alias("occlusion_type"), F.col("l_linestatus").alias("severity"), F.col("l_quantity").alias("coverage_pct"), (F.col("l_discount") * 100).alias("road_coverage_pct"))
    geo = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("source_image_id"), F.col("c_name").alias("reference"))
    return rounded(master.master(tile_rows, occlusions, geo))
