"""Incremental ingest and windowed counts (an extension: the reference has no streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlens.functions import numbers, text


def new_images(spark: SparkSession, folder: str) -> DataFrame:
    """Files as they arrive: image_id, path, size_bytes, md5."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.schema(schema).format("binaryFile").load(folder)
    return files.select(text.image_id(F.col("path")).alias("image_id"), "path", F.col("length").alias("size_bytes"), numbers.whole_hash(F.col("content")).alias("md5"))


def keep_up(stream: DataFrame, table: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends a stream to a Parquet table; with once, what is there now and no more."""
    writer = stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed(events: DataFrame, length: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """start, event_type, n, total of tumbling or sliding windows; rows later than the watermark are dropped.

    The same plan serves a stream and a table: on a table the watermark does nothing.
    """
    at = F.window("ts", length, slide) if slide else F.window("ts", length)
    seen = events.withWatermark("ts", late).groupBy(at.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return seen.select(F.col("w.start").alias("start"), "event_type", "n", "total")
