"""Queries on rasters, metrics, vectors and graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import geo, numbers, raster
from roadlens.operators import graphs, metrics, nearest, occlusion, overlay, scenes, stats, tiling, vectors
from roadlens.session import cut
from roadlens.sources.tables import table
from roadlens.streaming import ingest

from .registry import PIXELS, SIDE, query, rasters, rounded

DATA_COLUMN = "data"
MEASURES = """CASE WHEN dx >= dy THEN CASE WHEN dx >= 2 * dy THEN (dx - 2 * dy) * 1.0::DOUBLE + dy * 2.1969::DOUBLE ELSE (2 * dy - dx) * 1.4::DOUBLE + (dx - dy) * 2.1969::DOUBLE END
  ELSE CASE WHEN dy >= 2 * dx THEN (dy - 2 * dx) * 1.0::DOUBLE + dx * 2.1969::DOUBLE ELSE (2 * dx - dy) * 1.4::DOUBLE + (dy - dx) * 2.1969::DOUBLE END END"""


def weighed(data: Column) -> Column:
    """A checksum that tells where the values are: each times its place."""
    return raster.total(F.transform(data, lambda v, i: v * (i + 1)))


@query(f"""WITH {PIXELS}, w AS (SELECT vec_id, r.i AS "row", c.i AS col, v FROM e, range(3) r(i), range(3) c(i) WHERE y >= r.i * 2 AND y < r.i * 2 + 4 AND x >= c.i * 2 AND x < c.i * 2 + 4)
  SELECT vec_id, "row", col, round(count(*) FILTER (v > 0) * 100.0::DOUBLE / 16, 6) AS road_pixel_pct, round(stddev_pop(v), 6) AS image_std FROM w GROUP BY 1, 2, 3""")
def q_tile_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS8-9, JN8: statistics of overlapping windows; a raster's windows never leave its row."""
    cut = tiling.windows(rasters(spark, sf_dir), SIDE, SIDE, 4, 2)
    return rounded(cut.select("vec_id", "row", "col", numbers.percentage(raster.positives(F.col("window")), F.size("window")).alias("road_pixel_pct"), raster.spread(F.col("window")).alias("image_std")))


@query(f"""WITH {PIXELS}, i AS (SELECT i, CASE WHEN i < 8 THEN i ELSE 14 - i END AS s FROM range(10) r(i)), p AS (SELECT vec_id, a.i AS y, b.i AS x, v FROM e JOIN i a ON e.y = a.s JOIN i b ON e.x = b.s)
  SELECT vec_id, round(sum(v), 6) AS total, round(sum(v * (y * 10 + x + 1)), 6) AS weighed, round(max(v) FILTER (y = 9 AND x = 9), 6) AS corner FROM p GROUP BY 1""")
def q_reflect_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS7: padding by reflection."""
    grown = rasters(spark, sf_dir).select("vec_id", raster.padded(F.col(DATA_COLUMN), SIDE, SIDE, 10, 10).alias("p"))
    return rounded(grown.select("vec_id", raster.total(F.col("p")).alias("total"), weighed(F.col("p")).alias("weighed"), F.element_at("p", -1).alias("corner")))


@query(f"WITH {PIXELS} SELECT vec_id, count(*) FILTER (v > 0) AS road, sum(CASE WHEN v > 0 THEN 255 ELSE 0 END)::DOUBLE AS total, sum(CASE WHEN v > 0 OR v < -0.2 THEN 255 ELSE 0 END)::DOUBLE AS any_channel FROM e GROUP BY 1")
def q_mask_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS1, SRC12: masks of one channel and of several."""
    mask = rasters(spark, sf_dir).select("vec_id", raster.threshold(F.col(DATA_COLUMN), 0).alias("m"), raster.any_channel([F.col(DATA_COLUMN), F.transform(F.col(DATA_COLUMN), lambda v: F.when(v < -0.2, 1.0).otherwise(0.0))], 0).alias("a"))
    return mask.select("vec_id", raster.positives(F.col("m")).alias("road"), raster.total(F.col("m")).alias("total"), raster.total(F.col("a")).alias("any_channel"))


@query(f"WITH {PIXELS} SELECT vec_id, label, round(count(*) FILTER (v > 0) * 100.0::DOUBLE / count(*), 6) AS road_pixel_pct FROM e GROUP BY 1, 2")
def q_road_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1, RAS9."""
    return rounded(rasters(spark, sf_dir).select("vec_id", "label", numbers.percentage(raster.positives(F.col(DATA_COLUMN)), F.size(F.col(DATA_COLUMN))).alias("road_pixel_pct")))


@query(f"""WITH {PIXELS}, d AS (SELECT a.vec_id, a.y, a.x, min({MEASURES.replace("dx", "abs(a.x - b.x)").replace("dy", "abs(a.y - b.y)")}) AS d FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.v > 0 AND b.v <= 0 GROUP BY 1, 2, 3)
  SELECT vec_id, round(2 * avg(d), 6) AS avg_road_width_px, round(2 * max(d), 6) AS max_road_width_px, round(count(*) / 64.0::DOUBLE, 6) AS road_density FROM d GROUP BY 1""")
def q_road_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS11: widths by the chamfer distance to the background."""
    return rounded(occlusion.road_width(rasters(spark, sf_dir), "vec_id"))


@query(f"""WITH {PIXELS} SELECT vec_id, round(sum(v * (y * 8 + 7 - x + 1)), 6) AS across, round(sum(v * ((7 - y) * 8 + x + 1)), 6) AS down, round(sum(v * ((7 - x) * 8 + y + 1)), 6) AS turned FROM e GROUP BY 1""")
def q_flip_rot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS21: flips and turns as permutations."""
    return rounded(rasters(spark, sf_dir).select("vec_id", weighed(raster.flipped_across(F.col(DATA_COLUMN), SIDE, SIDE)).alias("across"), weighed(raster.flipped_down(F.col(DATA_COLUMN), SIDE, SIDE)).alias("down"), weighed(raster.turned(F.col(DATA_COLUMN), SIDE, SIDE)).alias("turned")))


@query(f"WITH {PIXELS} SELECT vec_id, round(avg(least(greatest(v * 1.3 + 0.1, 0), 1)), 6) AS mean, round(stddev_pop(least(greatest(v * 1.3 + 0.1, 0), 1)), 6) AS spread FROM e GROUP BY 1")
def q_brightness_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS21."""
    out = raster.adjusted(F.col(DATA_COLUMN), 0.3, 0.1)
    return rounded(rasters(spark, sf_dir).select("vec_id", raster.mean(out).alias("mean"), raster.spread(out).alias("spread")))


BLOB = "exp(-((x - label % 8)**2 + (y - label * 3 % 8)**2)::DOUBLE / 8.0::DOUBLE)"


def blob() -> Column:
    return raster.gaussian_blob(SIDE, SIDE, F.col("label") % 8, F.col("label") * 3 % 8, F.lit(4.0))


@query(f"WITH {PIXELS} SELECT vec_id, round(sum({BLOB}), 6) AS total, count(*) FILTER ({BLOB} > 0.35) AS covered FROM e GROUP BY 1")
def q_gaussian_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS13, FN7."""
    return rounded(rasters(spark, sf_dir).select("vec_id", raster.total(blob()).alias("total"), F.size(F.filter(blob(), lambda v: v > 0.35)).alias("covered")))


@query(f"""WITH {PIXELS} SELECT vec_id, round(count(*) FILTER ({BLOB} > 0.35) * 100.0::DOUBLE / 64, 6) AS coverage_pct,
  round(CASE WHEN count(*) FILTER (v > 0) > 0 THEN count(*) FILTER ({BLOB} > 0.35 AND v > 0) * 100.0::DOUBLE / count(*) FILTER (v > 0) ELSE 0 END, 6) AS road_coverage_pct FROM e GROUP BY 1""")
def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG17, RAS19: shares of pixels and of road that an occlusion covers."""
    return rounded(stats.coverage(rasters(spark, sf_dir), raster.threshold(blob(), 0.35), raster.threshold(F.col(DATA_COLUMN), 0), "vec_id"))


@query("""WITH s AS (SELECT p_partkey AS id, p_partkey % 100 AS x, p_partkey % 77 AS y, 20 + p_size AS w, 20 + p_partkey % 61 AS h, trunc(p_retailprice / 20 * cos(radians(30 + p_partkey % 121)))::BIGINT AS dx, trunc(p_retailprice / 20 * sin(radians(30 + p_partkey % 121)))::BIGINT AS dy FROM part),
  c AS (SELECT id, dx, dy, unnest([x, x + w, x + w, x]) AS x, unnest([y, y, y + h, y + h]) AS y, unnest([0, 1, 2, 3]) AS k FROM s)
  SELECT id, k::BIGINT AS k, x::BIGINT AS x, y::BIGINT AS y FROM c UNION ALL SELECT id, 7 - k, x + dx, y + dy FROM c""")
def q_shadow_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS16: the polygons of shadows."""
    key = F.col("p_partkey")
    shape = raster.shadow_polygon(key % 100, key % 77, 20 + F.col("p_size"), 20 + key % 61, 30 + key % 121, F.col("p_retailprice") / 20)
    return table(spark, sf_dir, "part").select(key.alias("id"), F.posexplode(shape).alias("k", "p")).select("id", F.col("k").cast("long").alias("k"), "p.x", "p.y")


@query(f"WITH {PIXELS} SELECT vec_id, round(avg(CASE WHEN v > 0 THEN v * 0.6 + 0.4 ELSE v END), 6) AS mean, round(stddev_pop(CASE WHEN v > 0 THEN v * 0.6 + 0.4 ELSE v END), 6) AS spread FROM e GROUP BY 1")
def q_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS26-27: a colour blended in where the mask is set."""
    out = raster.blended(F.col(DATA_COLUMN), raster.threshold(F.col(DATA_COLUMN), 0), 1.0, 0.4)
    return rounded(rasters(spark, sf_dir).select("vec_id", raster.mean(out).alias("mean"), raster.spread(out).alias("spread")))


def one_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = lambda k: (F.element_at(F.col(DATA_COLUMN), k) + 0.5) * 7
    return rasters(spark, sf_dir).select("vec_id", place(1).alias("x1"), place(2).alias("y1"), place(3).alias("x2"), place(4).alias("y2"))


SEGMENT = "(SELECT vec_id, (embedding[1]::DOUBLE + 0.5) * 7 AS x1, (embedding[2]::DOUBLE + 0.5) * 7 AS y1, (embedding[3]::DOUBLE + 0.5) * 7 AS x2, (embedding[4]::DOUBLE + 0.5) * 7 AS y2 FROM embeddings)"


@query(f"""WITH g AS (SELECT s.*, x.i AS x, y.i AS y FROM {SEGMENT} s, range(8) x(i), range(8) y(i)),
  t AS (SELECT *, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / greatest((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 1e-12::DOUBLE), 0), 1) AS t FROM g)
  SELECT vec_id, count(*) AS pixels, sum(y * 8 + x)::BIGINT AS places FROM t WHERE (x - x1 - t * (x2 - x1))**2 + (y - y1 - t * (y2 - y1))**2 <= 1.44 GROUP BY 1""")
def q_rasterize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS22-23: pixels within reach of a line; only those in its own box are looked at."""
    on = vectors.burnt(one_segment(spark, sf_dir), "vec_id", height=SIDE, width=SIDE, reach=1.2)
    return on.groupBy("vec_id").agg(F.count("*").alias("pixels"), F.sum(F.col("y") * SIDE + F.col("x")).alias("places"))


@query()
def q_skeleton_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS24, GR1: ends and junctions of centre lines."""
    return occlusion.skeleton_nodes(rasters(spark, sf_dir), "vec_id")


@query(f"""WITH RECURSIVE {PIXELS}, f AS (SELECT vec_id, y * 10 + x + 11 AS p FROM e WHERE v > 0), b AS (SELECT vec_id, p FROM (SELECT DISTINCT vec_id FROM e), generate_series(0, 99) s(p) WHERE (vec_id, p) NOT IN (SELECT vec_id, p FROM f)),
  n AS (SELECT p, q, abs(p // 10 - q // 10) + abs(p % 10 - q % 10) = 1 AS side FROM generate_series(0, 99) a(p), generate_series(0, 99) b(q) WHERE p <> q AND abs(p // 10 - q // 10) <= 1 AND abs(p % 10 - q % 10) <= 1),
  rf AS (SELECT vec_id, p, p AS root FROM f UNION SELECT f.vec_id, f.p, rf.root FROM rf JOIN n ON n.p = rf.p JOIN f ON f.vec_id = rf.vec_id AND f.p = n.q), rb AS (SELECT vec_id, p, p AS root FROM b UNION SELECT b.vec_id, b.p, rb.root FROM rb JOIN n ON n.p = rb.p AND side JOIN b ON b.vec_id = rb.vec_id AND b.p = n.q),
  cf AS (SELECT vec_id, p, min(root) AS r FROM rf GROUP BY 1, 2), cb AS (SELECT vec_id, p, min(root) AS r FROM rb GROUP BY 1, 2), m AS (SELECT DISTINCT cf.vec_id, cf.p, cf.r AS region, cb.r AS around FROM cf JOIN n ON n.p = cf.p AND side JOIN cb ON cb.vec_id = cf.vec_id AND cb.p = n.q)
  SELECT vec_id, count(DISTINCT region) AS outer_borders, count(DISTINCT (region, around)) - count(DISTINCT region) AS hole_borders, count(*) AS border_pixels FROM m GROUP BY 1""")
def q_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS24: borders of regions and of their holes; each parts one region from one stretch of background."""
    found = rasters(spark, sf_dir).withColumn("borders", occlusion.borders("data", "width"))
    size = lambda holes: F.size(F.filter("borders", lambda b: b["hole"] == holes)).cast("long")
    pixels = F.aggregate(F.transform("borders", lambda b: F.size(F.array_distinct(b["points"]))), F.lit(0), lambda a, n: a + n).cast("long")
    return found.filter(F.size("borders") > 0).select("vec_id", size(False).alias("outer_borders"), size(True).alias("hole_borders"), pixels.alias("border_pixels"))


@query()
def q_centre_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS24-25, SNK7: centre lines as GeoJSON features."""
    return occlusion.centre_lines(rasters(spark, sf_dir), "vec_id").select("vec_id", F.col("line").cast("long").alias("line"), vectors.feature(F.col("points")).alias("feature"))


@query(f"""WITH RECURSIVE {PIXELS}, p AS (SELECT vec_id, y, x, y * 8 + x AS id FROM e WHERE v > 0), n AS (SELECT a.vec_id, a.id AS a, b.id AS b FROM p a JOIN p b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND a.id <> b.id),
  r AS (SELECT vec_id, id AS node, id AS root FROM p UNION SELECT n.vec_id, n.b, r.root FROM r JOIN n ON n.vec_id = r.vec_id AND n.a = r.node), c AS (SELECT vec_id, node, min(root) AS root FROM r GROUP BY 1, 2), s AS (SELECT vec_id, root, count(*) AS n FROM c GROUP BY 1, 2)
  SELECT vec_id, count(*) AS components, max(n) AS largest FROM s GROUP BY 1""")
def q_pixel_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR1 (extension): connected regions of masks."""
    return graphs.pixel_components(rasters(spark, sf_dir), "vec_id")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each raster as logits, the next one's mask as target, eight rasters to a batch."""
    src = rasters(spark, sf_dir).select("vec_id", F.col(DATA_COLUMN).alias("logits"))
    nexts = rasters(spark, sf_dir).select((F.col("vec_id") - 1).alias("vec_id"), F.transform(F.col(DATA_COLUMN), lambda v: (v > 0).cast("int")).alias("targets"))
    return metrics.batches(src.join(nexts, "vec_id"), 8, "vec_id")


BATCHED = """j AS (SELECT a.vec_id, a.embedding AS x, b.embedding AS t, (row_number() OVER (ORDER BY a.vec_id) - 1) // 8 AS batch FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
  p AS (SELECT batch, x[i]::DOUBLE AS x, (t[i] > 0)::INT AS t FROM j, generate_series(1, 64) g(i)),
  c AS (SELECT batch, count(*) FILTER (1 / (1 + exp(-x)) > 0.5 AND t = 1) AS tp, count(*) FILTER (1 / (1 + exp(-x)) > 0.5 AND t = 0) AS fp, count(*) FILTER (NOT 1 / (1 + exp(-x)) > 0.5 AND t = 1) AS fn FROM p GROUP BY 1),
  m AS (SELECT *, (tp + 1e-7::DOUBLE) / (tp + fp + 1e-7::DOUBLE) AS precision, (tp + 1e-7::DOUBLE) / (tp + fn + 1e-7::DOUBLE) AS recall, (2.0::DOUBLE * tp + 1e-7::DOUBLE) / (2.0::DOUBLE * tp + fp + fn + 1e-7::DOUBLE) AS dice, (tp + 1e-7::DOUBLE) / (tp + fp + fn + 1e-7::DOUBLE) AS iou FROM c)"""


@query(f"WITH {BATCHED} SELECT batch, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(dice, 6) AS f1_score, round(dice, 6) AS dice, round(iou, 6) AS iou FROM m")
def q_seg_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG14, FN8: metrics of each batch."""
    return rounded(metrics.by_batch(predictions(spark, sf_dir)))


@query(f"WITH {BATCHED} SELECT count(*) AS batches, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(dice), 6) AS dice, round(avg(iou), 6) AS iou FROM m")
def q_seg_metrics_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG15, BAT1, ML4: the mean of the batches."""
    return rounded(metrics.epoch(metrics.by_batch(predictions(spark, sf_dir))))


@query(f"""WITH {BATCHED}, s AS (SELECT batch, avg(greatest(x, 0) - x * t + ln(1 + exp(-abs(x)))) AS bce, sum(t / (1 + exp(-x))) AS i, sum(1 / (1 + exp(-x))) AS p, sum(t)::DOUBLE AS t FROM p GROUP BY 1),
  l AS (SELECT batch, bce, 1 - (2 * i + 1e-7::DOUBLE) / (p + t + 1e-7::DOUBLE) AS d, 1 - (i + 1e-7::DOUBLE) / (p + t - i + 1e-7::DOUBLE) AS j FROM s)
  SELECT batch, round(bce, 6) AS bce, round(d, 6) AS dice_loss, round(j, 6) AS jaccard_loss, round(0.5::DOUBLE * bce + 0.5::DOUBLE * d, 6) AS combined FROM l""")
def q_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG16."""
    return rounded(metrics.losses(predictions(spark, sf_dir)))


@query("""WITH h AS (SELECT row_number() OVER (ORDER BY ts::DATE) AS epoch, avg(value) AS m FROM events GROUP BY ts::DATE),
  b AS (SELECT *, greatest(coalesce(max(m) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS before FROM h),
  i AS (SELECT *, m > before AS improved, greatest(m, before) AS best FROM b), w AS (SELECT *, epoch - coalesce(max(CASE WHEN improved THEN epoch END) OVER (ORDER BY epoch), 0) AS waited FROM i)
  SELECT epoch, round(m, 6) AS metric, round(best, 6) AS best, improved, waited, max((waited >= 5)::INT) OVER (ORDER BY epoch) = 1 AS stopped FROM w""")
def q_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG19, ML5, VIS10: days as epochs."""
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("metric"))
    first = days.agg(F.min("day").alias("first"))  # one row
    numbered = days.join(F.broadcast(first)).select((F.date_diff("day", "first") + 1).cast("long").alias("epoch"), "metric")
    return rounded(metrics.early_stop(numbered, "metric"))


@query("SELECT event_id, unnest([0, 1]) AS k, unnest([value, value + 1]) AS x, unnest([hour(ts), hour(ts) + 1])::DOUBLE AS y FROM events")
def q_geojson_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC16, SNK7: lines written as GeoJSON and read back."""
    point = lambda d: F.struct((F.col("value") + d).alias("x"), (F.hour("ts") + d).alias("y"))
    written = table(spark, sf_dir, "events").select("event_id", vectors.feature(F.array(point(0), point(1))).alias("feature"))
    return vectors.vertices(written, "event_id")


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as saved replies of a map service: a way for each user and hour."""
    at = F.struct(F.col("value").alias("lon"), F.minute("ts").cast("double").alias("lat"))
    hours = table(spark, sf_dir, "events").groupBy("user_id", F.date_trunc("hour", "ts").alias("h")).agg(F.array_sort(F.collect_list(F.struct("event_id", at.alias("p")))).alias("g"), F.max("event_type").alias("t"))
    tags = F.map_filter(F.map_from_arrays(F.array(F.lit("highway"), F.lit("name")), F.array(F.when(F.col("user_id") % 2 == 0, F.col("t")), F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))))), lambda k, v: v.isNotNull())
    way = F.struct(F.lit("way").alias("type"), (F.col("user_id") * 1_000_000 + F.unix_seconds(F.col("h").cast("timestamp")) / 3600 % 1_000_000).cast("long").alias("id"), F.col("g.p").alias("geometry"), tags.alias("tags"))
    return hours.select(F.to_json(F.struct(F.array(way).alias("elements"))).alias("reply"))


@query("""WITH w AS (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS n, max(event_type) AS t, sum(value) AS s, (user_id * 1000000 + epoch(date_trunc('hour', ts))::BIGINT // 3600 % 1000000)::BIGINT AS id FROM events GROUP BY 1, 2)
  SELECT id AS way_id, CASE WHEN user_id % 2 = 0 THEN t ELSE 'road' END AS highway, CASE WHEN user_id % 3 = 0 THEN 'u' || user_id ELSE '' END AS name, n AS points, round(s, 4) AS x_total FROM w WHERE n >= 2""")
def q_osm_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC18, FIL9: ways of at least two points, with defaults for missing tags."""
    out = vectors.ways(replies(spark, sf_dir))
    return rounded(out.select("way_id", "highway", "name", F.size("points").alias("points"), raster.total(F.col("points.x")).alias("x_total")), 4)


@query("SELECT user_id, min(value) AS \"left\", min(hour(ts))::DOUBLE AS bottom, max(value) AS \"right\", max(hour(ts))::DOUBLE AS top FROM events GROUP BY 1")
def q_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN16."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(*geo.bounds(F.col("value"), F.hour("ts").cast("double")))


@query("""WITH b AS (SELECT user_id, min(value) AS l, max(value) AS r FROM events GROUP BY 1) SELECT event_id, round(l + (r - l) / 8 * (event_id % 8 + 0.5::DOUBLE), 6) AS x, round(24 - 24 / 8.0::DOUBLE * (event_id // 8 % 8 + 0.5::DOUBLE), 6) AS y FROM events JOIN b USING (user_id)""")
def q_affine_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN13, FN15: map coordinates of pixels' centres."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    boxes = events.groupBy("user_id").agg(F.min("value").alias("l"), F.max("value").alias("r"))
    t = geo.affine_of_bounds(F.col("l"), F.lit(0.0), F.col("r"), F.lit(24.0), F.lit(SIDE), F.lit(SIDE))
    at = geo.pixel_centre(t, F.col("event_id") % 8, F.floor(F.col("event_id") / 8) % 8)
    return rounded(events.join(boxes, "user_id").select("event_id", at["x"].alias("x"), at["y"].alias("y")))


@query("SELECT event_id, round(radians(value) * 6378137.0::DOUBLE, 4) AS x, round(ln(tan(pi() / 4 + radians(user_id % 80) / 2)) * 6378137.0::DOUBLE, 4) + 0.0::DOUBLE AS y, round(value, 4) AS lon, round((user_id % 80)::DOUBLE, 4) AS lat FROM events")
def q_mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN14: to metres and back."""
    m = table(spark, sf_dir, "events").select("event_id", geo.to_mercator(F.col("value"), (F.col("user_id") % 80).cast("double")).alias("m")).select("event_id", "m.x", "m.y")
    return rounded(m.select("event_id", "x", "y", geo.from_mercator(F.col("x"), F.col("y")).alias("b")).select("event_id", "x", "y", "b.lon", "b.lat"), 4)


PART_NODE = 1_000_000_000


def road_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as edges, which may be repeated: enough where only their ends count."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + PART_NODE).alias("dst"), "l_quantity")


def road_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graphs.edges(road_links(spark, sf_dir), "src", "dst", F.sum("l_quantity"))


EDGES = f"g AS (SELECT l_suppkey AS src, l_partkey + {PART_NODE} AS dst, sum(l_quantity) AS weight FROM lineitem GROUP BY 1, 2)"


@query(f"WITH {EDGES} SELECT src, dst, weight FROM g")
def q_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR2 (extension)."""
    return road_graph(spark, sf_dir)


@query(f"WITH {EDGES}, n AS (SELECT src AS node FROM g UNION ALL SELECT dst FROM g), d AS (SELECT node, count(*) AS degree FROM n GROUP BY 1) SELECT node, degree, round(degree / ((SELECT count(*) FROM d) - 1.0::DOUBLE), 6) AS centrality FROM d")
def q_degree_centrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR3 (extension)."""
    return rounded(graphs.degree_centrality(road_graph(spark, sf_dir)))


HOPS = 12


@query(f"""WITH RECURSIVE {EDGES}, e AS (SELECT src AS a, dst AS b, weight AS w FROM g UNION ALL SELECT dst, src, weight FROM g), s AS (SELECT min(src) AS node FROM g UNION ALL SELECT max(src) FROM g),
  r AS (SELECT node AS seed, node, 0.0::DOUBLE AS d, 0 AS hops FROM s UNION ALL SELECT * FROM (SELECT r.seed, e.b AS node, min(r.d + e.w) AS d, any_value(r.hops) + 1 AS hops FROM r JOIN e ON e.a = r.node WHERE r.hops < {HOPS} GROUP BY 1, 2)),
  m AS (SELECT seed, node, min(d) AS d FROM r GROUP BY 1, 2) SELECT seed, node, round(d, 6) AS d FROM m""")
def q_path_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR3 (extension): lengths of shortest paths from two nodes by weight; the SQL walks up to {HOPS} edges, which no shortest path here exceeds."""
    road = road_graph(spark, sf_dir)
    ends = road_links(spark, sf_dir).agg(F.min("src").alias("a"), F.max("src").alias("b"))
    return rounded(graphs.lengths(road, ends.select(F.explode(F.array("a", "b")).alias("node"))))


def _suppliers(g: str, k: str) -> str:
    """Components of the two-sided graph by its left side: l links those that share a part, c names their components, s has their sizes."""
    return f"""l{k} AS (SELECT DISTINCT a.src AS a, b.src AS b FROM {g} a JOIN {g} b ON a.dst = b.dst), r{k} AS (SELECT DISTINCT src AS node, src AS root FROM {g} UNION SELECT l{k}.b, r{k}.root FROM r{k} JOIN l{k} ON l{k}.a = r{k}.node),
  c{k} AS (SELECT node, min(root) AS root FROM r{k} GROUP BY 1), s{k} AS (SELECT root, count(DISTINCT src) + count(DISTINCT dst) AS n FROM {g} JOIN c{k} ON node = src GROUP BY 1)"""


BUSIEST = "n AS (SELECT src AS node FROM g UNION ALL SELECT dst FROM g), f AS (SELECT node FROM (SELECT node, count(*) AS d FROM n GROUP BY 1) ORDER BY d DESC, node LIMIT 1), h AS (SELECT * FROM g WHERE src NOT IN (SELECT node FROM f) AND dst NOT IN (SELECT node FROM f))"


@query(f"""WITH RECURSIVE {EDGES}, {BUSIEST}, {_suppliers("g", "0")}, {_suppliers("h", "1")}
  SELECT (SELECT count(DISTINCT node) FROM n) AS nodes_before, (SELECT max(n) FROM s0) AS lcc_before, (SELECT max(n) FROM s1) AS lcc_after, round((SELECT max(n) FROM s1) / (SELECT max(n) FROM s0)::DOUBLE, 6) AS ratio""")
def q_failure_lcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR4 (extension): what is left of the largest component when the busiest node fails."""
    # a node's degree counts its different neighbours, the components do not ask how often an edge is there
    busiest = cut(graphs.degrees(road_graph(spark, sf_dir)).orderBy(F.desc("degree"), "node").limit(1))
    return rounded(graphs.failure(road_links(spark, sf_dir).select("src", "dst"), busiest))


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as road edges with places."""
    at = lambda c, k: F.col(c) * k % 1000
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("src"), (-F.col("c_custkey")).alias("dst"), at("c_custkey", 37).alias("x1"), at("c_custkey", 91).alias("y1"), (at("c_custkey", 37) + F.col("c_custkey") % 23 - 11).alias("x2"), (at("c_custkey", 91) + F.col("c_custkey") % 17 - 8).alias("y2"),
    )


CORNERS = ((-1.0, -1.0), (1.0, -1.0), (0.25, 0.0), (1.0, 1.0), (-0.5, 0.5))


@query(f"""WITH e AS (SELECT c_custkey AS src, c_custkey * 37 % 1000 AS x1, c_custkey * 91 % 1000 AS y1, c_custkey * 37 % 1000 + c_custkey % 23 - 11 AS x2, c_custkey * 91 % 1000 + c_custkey % 17 - 8 AS y2 FROM customer),
  z AS (SELECT s_suppkey AS zone, s_suppkey * 53 % 1000 AS x, s_suppkey * 29 % 1000 AS y, s_suppkey % 40 * 4 + 12 AS r FROM supplier),
  k AS (SELECT * FROM (VALUES {", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for (a, b), (c, d) in zip(CORNERS, CORNERS[1:] + CORNERS[:1]))}) v(a, b, c, d)),
  r AS (SELECT zone, x + r * a AS p, y + r * b AS q, x + r * c AS s, y + r * d AS t FROM z, k),
  m AS (SELECT src, zone, max(CASE WHEN sign((x2 - x1) * (q - y1) - (y2 - y1) * (p - x1)) * sign((x2 - x1) * (t - y1) - (y2 - y1) * (s - x1)) <= 0 AND sign((s - p) * (y1 - q) - (t - q) * (x1 - p)) * sign((s - p) * (y2 - q) - (t - q) * (x2 - p)) <= 0
      AND greatest(x1, x2) >= least(p, s) AND greatest(p, s) >= least(x1, x2) AND greatest(y1, y2) >= least(q, t) AND greatest(q, t) >= least(y1, y2) THEN 1 ELSE 0 END) AS met,
    sum(CASE WHEN (q > y1) <> (t > y1) THEN CASE WHEN x1 < (s - p) * (y1 - q) / (t - q) + p THEN 1 ELSE 0 END ELSE 0 END) % 2 AS inside FROM e, r GROUP BY 1, 2)
  SELECT src, zone FROM m WHERE met = 1 OR inside = 1""")
def q_flooded_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR4 (extension): customers as road edges, suppliers as zones with a notch."""
    at = lambda c, k: F.col(c) * k % 1000
    r = F.col("s_suppkey") % 40 * 4 + 12
    ring = F.array(*[F.struct((at("s_suppkey", 53) + r * a).alias("x"), (at("s_suppkey", 29) + r * b).alias("y")) for a, b in CORNERS])
    return overlay.flooded(road_edges(spark, sf_dir), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("zone"), ring.alias("points")), 16.0).select("src", "zone")


@query("""WITH e AS (SELECT c_custkey AS src, (c_custkey * 37 % 1000 + c_custkey * 37 % 1000 + c_custkey % 23 - 11) / 2::DOUBLE AS px, (c_custkey * 91 % 1000 + c_custkey * 91 % 1000 + c_custkey % 17 - 8) / 2::DOUBLE AS py FROM customer),
  w AS (SELECT s_suppkey AS way_id, s_nationkey::VARCHAR AS highway, s_name AS name, s_suppkey * 53 % 1000 AS x, s_suppkey * 29 % 1000 AS y, s_suppkey % 31 - 15 AS a, s_suppkey % 13 * 3 - 18 AS b FROM supplier),
  g AS (SELECT way_id, x AS x1, y AS y1, x + a AS x2, y + b AS y2 FROM w UNION ALL SELECT way_id, x + a, y + b, x + 2 * a, y FROM w),
  v AS (SELECT src, way_id, px - x1 AS vx, py - y1 AS vy, x2 - x1 AS ux, y2 - y1 AS uy FROM e, g),
  t AS (SELECT *, CASE WHEN ux * ux + uy * uy > 0 THEN least(greatest((vx * ux + vy * uy) / (ux * ux + uy * uy), 0), 1) ELSE 0 END AS t FROM v),
  d AS (SELECT src, way_id, (vx - t * ux) * (vx - t * ux) + (vy - t * uy) * (vy - t * uy) AS d FROM t),
  n AS (SELECT src, way_id, d FROM d QUALIFY row_number() OVER (PARTITION BY src ORDER BY d, way_id) = 1)
  SELECT src, CASE WHEN sqrt(d) <= 40 THEN way_id END AS way_id, CASE WHEN sqrt(d) <= 40 THEN highway END AS highway, CASE WHEN sqrt(d) <= 40 THEN name END AS name, CASE WHEN sqrt(d) <= 40 THEN round(sqrt(d), 6) END AS way_distance FROM n JOIN w USING (way_id)""")
def q_nearest_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR2 (extension): customers as road edges with the attributes of the way nearest to them, of suppliers as ways."""
    x, y, a, b = F.col("s_suppkey") * 53 % 1000, F.col("s_suppkey") * 29 % 1000, F.col("s_suppkey") % 31 - 15, F.col("s_suppkey") % 13 * 3 - 18
    points = F.array(*[F.struct(u.cast("double").alias("x"), v.cast("double").alias("y")) for u, v in ((x, y), (x + a, y + b), (x + a * 2, y))])
    ways = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("way_id"), F.col("s_nationkey").cast("string").alias("highway"), F.col("s_name").alias("name"), points.alias("points"))
    return rounded(nearest.enriched(road_edges(spark, sf_dir), ways, 16.0, reach=40.0).select("src", "way_id", "highway", "name", "way_distance"))


@query(f"""WITH RECURSIVE p AS (SELECT c_custkey AS k, {geo.FLATTENING!r}::DOUBLE AS f, c_custkey * 91 % 171 - 85 AS lat1, c_custkey * 53 % 169 - 84 AS lat2, c_custkey % 61 + 1 AS far FROM customer),
  q AS (SELECT k, f, atan((1 - f) * tan(radians(lat1))) AS u, atan((1 - f) * tan(radians(lat2))) AS v, radians(far) AS far FROM p),
  r AS (SELECT k, f, u, v, far, far AS lam, 0 AS i FROM q UNION ALL SELECT k, f, u, v, far, far + (1 - c) * f * sa * (s + c * ss * (m + c * cs * (2 * m * m - 1))), i + 1
    FROM (SELECT *, f / 16 * q2 * (4 + f * (4 - 3 * q2)) AS c, CASE WHEN q2 > 0 THEN cs - 2 * sin(u) * sin(v) / q2 ELSE 0 END AS m, atan2(ss, cs) AS s
    FROM (SELECT *, 1 - sa * sa AS q2 FROM (SELECT *, cos(u) * cos(v) * sin(lam) / ss AS sa
    FROM (SELECT *, sqrt((cos(v) * sin(lam)) ** 2 + (cos(u) * sin(v) - sin(u) * cos(v) * cos(lam)) ** 2) AS ss, sin(u) * sin(v) + cos(u) * cos(v) * cos(lam) AS cs FROM r)))) WHERE i < 15),
  e AS (SELECT *, atan2(ss, cs) AS s, CASE WHEN q2 > 0 THEN cs - 2 * sin(u) * sin(v) / q2 ELSE 0 END AS m, sqrt(1 + q2 * (1 / (1 - f) ** 2 - 1)) AS w
    FROM (SELECT *, 1 - (cos(u) * cos(v) * sin(lam) / ss) ** 2 AS q2 FROM (SELECT *, sqrt((cos(v) * sin(lam)) ** 2 + (cos(u) * sin(v) - sin(u) * cos(v) * cos(lam)) ** 2) AS ss, sin(u) * sin(v) + cos(u) * cos(v) * cos(lam) AS cs FROM r WHERE i = 15))),
  h AS (SELECT *, (w - 1) / (w + 1) AS j FROM e), l AS (SELECT *, (1 + j * j / 4) / (1 - j) AS a, j * (1 - 3 * j * j / 8) AS b FROM h)
  SELECT k, round({geo.RADIUS!r}::DOUBLE * (1 - f) * a * (s - b * ss * (m + b / 4 * (cs * (2 * m * m - 1) - b / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))), 2) AS metres FROM l""")
def q_geodesic_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR2 (extension): metres on the ellipsoid between two places of each customer."""
    k = F.col("c_custkey")
    length = geo.geodesic(k % 360, k * 91 % 171 - 85, k % 360 + k % 61 + 1, k * 53 % 169 - 84)
    return rounded(table(spark, sf_dir, "customer").select(k.alias("k"), length.alias("metres")), 2)


@query(f"""WITH RECURSIVE {EDGES}, {_suppliers("g", "0")} SELECT sum(n)::BIGINT AS nodes, sum(n * (n - 1))::BIGINT AS pairs, round(sum(n * (n - 1)) / (sum(n) * (sum(n) - 1.0::DOUBLE)), 6) AS reachable FROM s0""")
def q_reachability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR5 (extension): how many pairs of nodes reach each other."""
    return rounded(graphs.reachability(graphs.components(road_links(spark, sf_dir))))


ABOVE = 0.13


def scene_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as tiles of scenes of four by four; what is above ABOVE is road."""
    bits = F.array_join(F.transform(DATA_COLUMN, lambda v: F.when(v > ABOVE, "01").otherwise("00")), "")
    k = F.col("vec_id")
    return rasters(spark, sf_dir).select(F.floor(k / 16).alias("scene"), F.floor(k % 16 / 4).alias("row"), (k % 4).alias("col"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"), F.unhex(bits).alias("data"))


@query(f"""WITH RECURSIVE {PIXELS}, o AS (SELECT vec_id // 16 AS scene, (vec_id % 16 // 4) * 8 + y AS y, vec_id % 4 * 8 + x AS x FROM e WHERE v > {ABOVE}),
  l AS (SELECT a.scene, a.y, a.x, b.y AS v, b.x AS u FROM o a JOIN o b ON a.scene = b.scene AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1),
  r AS (SELECT scene, y, x, y * 32 + x AS root FROM o UNION SELECT r.scene, l.v, l.u, r.root FROM r JOIN l ON r.scene = l.scene AND r.y = l.y AND r.x = l.x),
  c AS (SELECT scene, y, x, min(root) AS root FROM r GROUP BY 1, 2, 3), s AS (SELECT scene, root, count(*) AS n FROM c GROUP BY 1, 2)
  SELECT scene::BIGINT AS scene, count(*) AS regions, max(n) AS largest, sum(n * n)::BIGINT AS squares FROM s GROUP BY 1""")
def q_scene_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR1 (extension): regions of scenes that lie in tiles."""
    found = scenes.regions(scene_tiles(spark, sf_dir), SIDE)
    return found.groupBy("scene").agg(F.count("*").alias("regions"), F.max("pixels").alias("largest"), F.sum(F.col("pixels") * F.col("pixels")).alias("squares"))


@query()
def q_scene_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GR2, RAS24 (extension): road graphs of scenes that lie in tiles; tests/test_scenes.py holds them against whole scenes."""
    thin = scenes.thinned(scene_tiles(spark, sf_dir), SIDE)
    return rounded(scenes.road_graph(thin, SIDE))


@query("""WITH p AS (SELECT vec_id, (i // 4) * 3 + i % 4 + 1 AS place, (floor(embedding[i + 1]::DOUBLE * 2000)::BIGINT % 256 + 256) % 256 AS v FROM embeddings, generate_series(0, 63) s(i) WHERE i % 4 < 3)
  SELECT vec_id, count(*) AS n, sum(place * v)::BIGINT AS weighted, 30 * 192::BIGINT AS dark FROM p GROUP BY 1""")
def q_ensure_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAS2-3, RAS28: four channels become three, values wrap around; beside it the placeholder of the same size."""
    whole = F.transform(F.col("data"), lambda v: F.floor(v * 2000))
    seen = rasters(spark, sf_dir).select("vec_id", raster.rgb(whole, 4).alias("rgb"))
    weighted = F.aggregate(F.transform("rgb", lambda v, i: v.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    dark = F.aggregate(raster.placeholder(SIDE, SIDE), F.lit(0).cast("long"), lambda a, x: a + x)
    return seen.select("vec_id", F.size("rgb").cast("long").alias("n"), weighted.alias("weighted"), dark.alias("dark"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def q_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: the plan that also runs on streams."""
    out = ingest.windowed(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return rounded(out.withColumn("start", F.col("start").cast("timestamp_ntz")), 4)
