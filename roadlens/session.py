"""Sessions, lineage cuts in the cluster's shared folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(name: str = "roadlens", **settings: str) -> SparkSession:
    """A session with the settings that the library is written for; a cluster's own settings stay.

    Checkpoints are deleted when nothing refers to them any more.
    """
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. On one machine, where it is unset, a temporary one; a cluster has to name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="roadlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes what was written to a path of new_path, through the file system that the path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, through the file system that it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def cut(df: DataFrame) -> DataFrame:
    """Compute df once into the shared folder, so that later steps neither repeat it nor lose it with an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Mark df for broadcast if it has at most that many rows (of a fixed width); beyond that it joins by shuffle.

    df has to be cheap to count: a cut table.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_often(rows: DataFrame, names: DataFrame, on: list[str], how: str = "inner", often: int = 1_000) -> DataFrame:
    """rows joined with names, which has one row for each key and, as n, how many of rows have that key; n is not in the result.

    Keys of more than `often` rows are at most a share of 1 / often of them: they meet their names by broadcast, where
    they lie, if their table is small. All others join by shuffle, where no task gets many rows of one key. names has to be
    a cut table; how is inner or left.
    """
    hot = names.filter(F.col("n") > often).drop("n")
    if not hot.limit(1).count():
        return rows.join(names.drop("n"), on, how)
    hot = small(hot, 200_000)
    rest = rows.join(hot.select(*on), on, "left_anti").join(names.filter(F.col("n") <= often).drop("n"), on, how)
    return rows.join(hot, on).unionByName(rest)
