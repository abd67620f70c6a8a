"""Helpers shared by the operators."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut, drop_path, join_often, new_path, small

__all__ = ["cut", "drop_path", "held_out", "join_often", "new_path", "small", "spread", "unused"]

log = logging.getLogger(__name__)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: a small table in fewer files than there are cores has its rows dealt round; any other stays.

    For steps that take long for a row. Small are fewer bytes than the cores read in one split each: of what is larger,
    Spark's own splits keep them busy, and nothing is shuffled nor its file names brought together.
    """
    spark = df.sparkSession
    cores, split = spark.sparkContext.defaultParallelism, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= cores * split or not 0 < (files := len(df.inputFiles())) < cores:
        return df
    log.info("the rows of %d files are dealt out to %d cores", files, cores)
    return df.repartition(cores)


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from: crc32 of the id as text is divisible by five. A null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
