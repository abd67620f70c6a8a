"""Registered queries, the SQL they are held against, and the driver's tables as images, tiles and rasters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import text
from roadlens.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SIDE = 8
#: The order of tiles of one image; parts and suppliers settle what the table repeats.
ORDER = ["row", "col", "part", "supp"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL for the same rows if SQL can express it."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to some decimals, so that the order of a sum does not show; whole numbers as long."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c).cast("long").alias(c) if kinds[c] in ("int", "smallint", "tinyint") else F.col(c) for c in df.columns])


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as images: priority is the source, status the split."""
    raw = F.element_at(F.create_map(*[F.lit(x) for x in ("F", "train", "O", "valid", "P", "test")]), F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("source_dataset"), text.split_name(raw).alias("split"),
        (F.col("o_orderkey") % 4 != 0).alias("has_mask"), (F.col("o_custkey") % 50 == 0).alias("invalid"),
        F.floor("o_totalprice").alias("size_bytes"), (F.col("o_custkey") % 30).cast("double").alias("road_pixel_pct"), F.col("o_custkey").alias("source_image_id"),
    )


IMAGES = """images AS (SELECT o_orderkey AS image_id, o_orderpriority AS source_dataset,
  CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END AS split, o_orderkey % 4 <> 0 AS has_mask, o_custkey % 50 = 0 AS invalid,
  floor(o_totalprice)::BIGINT AS size_bytes, (o_custkey % 30)::DOUBLE AS road_pixel_pct, o_custkey AS source_image_id FROM orders)"""


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as tiles of their order: price is the road score, quantity the spread."""
    at = F.col("l_linenumber").cast("long") - 1
    ids = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image_id"), F.concat_ws("-", *ids).alias("tile_id"), F.floor(at / 3).alias("row"), (at % 3).alias("col"), F.col("l_extendedprice").alias("road_pixel_pct"),
        F.col("l_quantity").alias("image_std"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_discount").alias("share"), F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
    )


TILES = """tiles AS (SELECT l_orderkey AS image_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS tile_id, ((l_linenumber - 1) // 3)::BIGINT AS "row",
  ((l_linenumber - 1) % 3)::BIGINT AS col, l_extendedprice AS road_pixel_pct, l_quantity AS image_std, l_partkey AS part, l_suppkey AS supp, l_discount AS share, l_tax AS tax,
  l_returnflag AS flag, l_linestatus AS status FROM lineitem)"""


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as rasters of 8 x 8 pixels; what is above 0 is road."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("data"), F.lit(SIDE).alias("width"))


PIXELS = "e AS (SELECT vec_id, label::BIGINT AS label, ((p - 1) // 8)::BIGINT AS y, ((p - 1) % 8)::BIGINT AS x, embedding[p]::DOUBLE AS v FROM embeddings, generate_series(1, 64) g(p))"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as images; those with a label have a mask."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.select("doc_id", "text", "source", "lang", "n_chars").join(labels, "doc_id", "left")
    has = F.col("quality").isNotNull()
    return joined.select(
        F.col("doc_id").alias("image_id"), F.col("source").alias("source_dataset"), "lang", has.alias("has_mask"), F.col("n_chars").alias("size_bytes"),
        (F.col("n_chars") < 50).alias("invalid"), F.when(has, F.col("n_chars") % 101 / 4.0).otherwise(0.0).alias("road_pixel_pct"), "quality", "toxic", "text",
    )


RECORDS = """records AS (SELECT d.doc_id AS image_id, source AS source_dataset, lang, quality IS NOT NULL AS has_mask, n_chars AS size_bytes, n_chars < 50 AS invalid,
  CASE WHEN quality IS NOT NULL THEN (n_chars % 101) / 4.0::DOUBLE ELSE 0.0 END::DOUBLE AS road_pixel_pct, quality, toxic, text FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def four_sql(x: str, name: str, digits: int = 6) -> str:
    """The oracle's form of stats.four."""
    return ", ".join(f"round(coalesce({f}({x})::DOUBLE, 0), {digits}) AS {name}_{n}" for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")))
