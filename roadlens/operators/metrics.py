"""Segmentation metrics, losses and early stopping (AGG14-16, AGG19, BAT1, FN8, VIS10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.functions import numbers

EPS = 1e-7


def batches(rows: DataFrame, size: int, key: str, *ties: str, ranges: int = 200) -> DataFrame:
    """Adds batch: rows in order of a numeric key and ties, so many to a batch; the last may be short.

    Quantiles of the key deal rows into ranges, rows are numbered within a range, and what the ranges before hold is
    added from one row for each, so no task sorts the table.
    """
    edges = rows.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 1000).alias("__edges"))  # one row
    at = F.coalesce(F.size(F.filter("__edges", lambda e: e < F.col(key))), F.lit(0))
    dealt = rows.join(F.broadcast(edges)).withColumn("__range", at).drop("__edges")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    # one row for each range: at most as many as asked for
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).drop("__n")
    numbered = dealt.withColumn("__k", F.row_number().over(Window.partitionBy("__range").orderBy(key, *ties)))
    joined = numbered.join(F.broadcast(before), "__range")
    return joined.withColumn("batch", F.floor((F.col("__before") + F.col("__k") - 1) / size).cast("long")).drop("__range", "__k", "__before")


def _summed(rows: DataFrame, **each: Column) -> DataFrame:
    """batch and the sums of what each raster gives: rasters are folded where they lie, pixels never become rows."""
    return rows.select("batch", *[v.alias(k) for k, v in each.items()]).groupBy("batch").agg(*[F.sum(k).alias(k) for k in each])


def _folded(pairs: Column, value) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda a, p: a + value(p["x"], p["t"]))


def _pairs(logits: Column, targets: Column) -> Column:
    return F.arrays_zip(logits.alias("x"), targets.alias("t"))


def scores(tp: Column, fp: Column, fn: Column) -> list[Column]:
    f1 = (2.0 * tp + EPS) / (2.0 * tp + fp + fn + EPS)
    return [((tp + EPS) / (tp + fp + EPS)).alias("precision"), ((tp + EPS) / (tp + fn + EPS)).alias("recall"), f1.alias("f1_score"), f1.alias("dice"), ((tp + EPS) / (tp + fp + fn + EPS)).alias("iou")]


def by_batch(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Metrics of each batch from rasters (batch, logits, targets): a pixel is said to be road above the threshold."""
    pairs, said = _pairs(F.col("logits"), F.col("targets")), lambda x: numbers.sigmoid(x) > threshold
    count = lambda test: F.size(F.filter(pairs, lambda p: test(said(p["x"]), p["t"] > 0))).cast("long")
    sums = _summed(rows, tp=count(lambda s, t: s & t), fp=count(lambda s, t: s & ~t), fn=count(lambda s, t: ~s & t))
    return sums.select("batch", "tp", "fp", "fn", *scores(F.col("tp"), F.col("fp"), F.col("fn")))


def epoch(batch_metrics: DataFrame) -> DataFrame:
    """The mean of the batches' metrics; a short batch weighs as much as a full one."""
    return batch_metrics.agg(F.count("*").alias("batches"), *[F.avg(c).alias(c) for c in ("precision", "recall", "dice", "iou")])


def losses(rows: DataFrame, bce: float = 0.5, dice: float = 0.5, jaccard: float = 0.0) -> DataFrame:
    """Binary cross-entropy (stable form), soft Dice and soft Jaccard of each batch, and the sum of those with a weight."""
    pairs = _pairs(F.col("logits"), F.col("targets"))
    entropy = lambda x, t: F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x)))
    sums = _summed(rows, b=_folded(pairs, entropy), i=_folded(pairs, lambda x, t: numbers.sigmoid(x) * t), p=_folded(pairs, lambda x, t: numbers.sigmoid(x)), t=_folded(pairs, lambda x, t: t.cast("double")), n=F.size("logits").cast("long"))
    both = F.col("p") + F.col("t")
    parts = sums.select("batch", (F.col("b") / F.col("n")).alias("bce"), (1.0 - (2.0 * F.col("i") + EPS) / (both + EPS)).alias("dice_loss"), (1.0 - (F.col("i") + EPS) / (both - F.col("i") + EPS)).alias("jaccard_loss"))
    used = [w * F.col(c) for w, c in ((bce, "bce"), (dice, "dice_loss"), (jaccard, "jaccard_loss")) if w > 0]
    return parts.withColumn("combined", sum(used[1:], used[0]) if used else F.lit(0.0))


def early_stop(history: DataFrame, metric: str, epoch_col: str = "epoch", patience: int = 5) -> DataFrame:
    """Adds best (so far, 0 at first), improved, waited (epochs since) and stopped (from the first stop on).

    A history has one row for each epoch of one run, which is what a single ordered window is for.
    """
    order = Window.orderBy(epoch_col)
    before = F.greatest(F.coalesce(F.max(metric).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), F.lit(0.0))
    marked = history.withColumns({"improved": F.col(metric) > before, "best": F.greatest(F.col(metric), before), "__i": F.row_number().over(order)})
    last = F.coalesce(F.max(F.when(F.col("improved"), F.col("__i"))).over(order), F.lit(0))
    waited = marked.withColumn("waited", (F.col("__i") - last).cast("long"))
    return waited.withColumn("stopped", F.max((F.col("waited") >= patience).cast("int")).over(order) == 1).drop("__i")
