"""Seeded splits into train, val and test, sampling and leakage checks (SPL1-4, SMP1-3, SET1-4, JN6, OP7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.errors import LeakageError, RatioError
from roadlens.functions import numbers

#: Buckets of the shuffled order, by so many hexadecimal digits of a row's hash.
DIGITS = 4


def check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-6:
        raise RatioError(f"the ratios {train}, {val} and {test} do not add up to 1")


def places(rows: DataFrame, seed: int, id_col: str, by: str | None = None) -> DataFrame:
    """Adds place (0 first in shuffled order) and of (how many there are), within each group or over all rows.

    The order is that of a hash, whose first digits deal the rows into buckets of about equal size. Rows are numbered
    within a bucket; what the buckets before hold is added from a table of at most 16^DIGITS rows per group. So neither
    one large group nor the table itself is ever sorted in one task.
    """
    key = numbers.order_key(seed, F.col(id_col))
    group = [by] if by else []
    keyed = rows.withColumn("__key", key).withColumn("__bucket", F.conv(F.substring("__key", 1, DIGITS), 16, 10).cast("int"))
    sizes = keyed.groupBy(*group, "__bucket").agg(F.count("*").alias("__n"))
    # of one group only: as many rows as there are buckets at most, whatever the table's size
    lines = Window.partitionBy(*(group or [F.lit(0)]))
    before = sizes.withColumns({"__before": F.sum("__n").over(lines.orderBy("__bucket")) - F.col("__n"), "of": F.sum("__n").over(lines)}).drop("__n")
    within = F.row_number().over(Window.partitionBy(*group, "__bucket").orderBy("__key", id_col))
    numbered = keyed.withColumn("__within", within)
    on = [*group, "__bucket"]
    return numbered.join(before, on).withColumn("place", (F.col("__before") + F.col("__within") - 1).cast("long")).select(*rows.columns, "place", "of")


def _named(place: Column, train: Column, val: Column) -> Column:
    return F.when(place < train, "train").when(place < train + val, "val").otherwise("test")


def stratified(rows: DataFrame, by: str, id_col: str, train: float = 0.7, val: float = 0.15, test: float = 0.15, seed: int = 42) -> DataFrame:
    """Adds split; every group gives at least one row to train, and one to val if it has two."""
    check_ratios(train, val, test)
    n = F.col("of")
    first = F.greatest(F.lit(1), F.floor(n * train))
    second = F.greatest(F.lit(1), F.floor(n * val))
    second = F.when(n - first - second < 0, F.greatest(F.lit(0), n - first)).otherwise(second)
    return places(rows, seed, id_col, by).withColumn("split", _named(F.col("place"), first, second)).select(*rows.columns, "split")


def simple(rows: DataFrame, id_col: str, train: float = 0.7, val: float = 0.15, test: float = 0.15, seed: int = 42) -> DataFrame:
    """Adds split by place in one shuffled order of all rows."""
    check_ratios(train, val, test)
    return places(rows, seed, id_col).withColumn("split", _named(F.col("place"), F.floor(F.col("of") * train), F.floor(F.col("of") * val))).select(*rows.columns, "split")


def by_group(rows: DataFrame, group: str, train: float = 0.85, seed: int = 42) -> DataFrame:
    """Adds split, train or val, so that all rows of a group share it."""
    groups = places(rows.select(group).distinct(), seed, group)
    named = groups.select(group, F.when(F.col("place") < F.floor(F.col("of") * train), "train").otherwise("val").alias("split"))
    return rows.join(named, group)


def leakage(rows: DataFrame, key: str, splits: tuple[str, ...] = ("train", "val", "test"), by: tuple[str, ...] = ()) -> DataFrame:
    """by, pair, shared: how many keys two splits have in common. One aggregation, not a join for each pair."""
    seen = rows.groupBy(*by, key).agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in splits])
    pairs = [(a, b) for i, a in enumerate(splits) for b in splits[i + 1 :]]
    counts = seen.groupBy(*by).agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long").alias(f"{a}_{b}") for a, b in pairs])
    return counts.select(*by, F.inline(F.array(*[F.struct(F.lit(f"{a}_{b}").alias("pair"), F.col(f"{a}_{b}").alias("shared")) for a, b in pairs])))


def verified(rows: DataFrame, key: str, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """rows, if no two splits share a key; else LeakageError names the pairs that do."""
    shared = [f"{r['pair']}: {r['shared']}" for r in leakage(rows, key, splits).collect() if r["shared"]]  # one row for each pair of splits
    if shared:
        raise LeakageError(f"splits share values of {key}: {', '.join(shared)}")
    return rows


def sample(rows: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """n rows by hash order, the same on any cluster; each task keeps n rows of its own."""
    return rows.withColumn("__key", numbers.order_key(seed, F.col(id_col))).orderBy("__key", id_col).limit(n)


def occlusion_plan(tiles: DataFrame, types: tuple[str, ...], severities: tuple[str, ...], n: int = 20, id_col: str = "tile_id", seed: int = 42) -> DataFrame:
    """A sample of the tiles with image and mask; types and severities take turns."""
    ready = tiles.filter(F.col("image_path").isNotNull() & (F.col("image_path") != "") & F.col("mask_path").isNotNull() & (F.col("mask_path") != ""))
    # the sample has n rows: numbering them takes one small task
    i = F.row_number().over(Window.orderBy("__key", id_col)) - 1
    return sample(ready, n, id_col, seed).withColumn("i", i.cast("long")).withColumns({"occlusion_type": numbers.round_robin(types, F.col("i")), "severity": numbers.round_robin(severities, F.col("i"))}).drop("__key")


def occlusion_gate(tiles: DataFrame, types: tuple[str, ...], severities: tuple[str, ...], probability: float = 0.5, id_col: str = "tile_id", seed: int = 42) -> DataFrame:
    """Whether a tile is occluded while training, and how: drawn from hashes, so that each row is drawn anywhere."""
    u = [numbers.uniform(seed, F.col(id_col), k) for k in range(3)]
    hit = u[0] <= probability
    return tiles.withColumns({"occluded": hit, "occlusion_type": F.when(hit, numbers.choice(types, u[1])), "severity": F.when(hit, numbers.choice(severities, u[2]))})
