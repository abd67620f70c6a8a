"""Guarded ratios, hash-derived random numbers and file hashes as column expressions (PRJ1-2, PRJ6-8, FN5-9, SMP1-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = 64 << 10


def percentage(part: Column, whole: Column) -> Column:
    """100 part / whole, and 0 where whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole * 100.0).otherwise(0.0)


def order_key(seed: int, id_: Column) -> Column:
    """What a seeded shuffle sorts by: the same for a row wherever and whenever it is computed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_.cast("string")).cast("binary"))


def uniform(seed: int, id_: Column, draw: int | str = 0) -> Column:
    """The draw-th uniform number in [0, 1) of a row, from eight hexadecimal digits of a hash."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), id_.cast("string"), F.lit(f":{draw}")).cast("binary"))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 4294967296.0


def choice(names: tuple[str, ...], u: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.floor(u * len(names)).cast("int") + 1)


def round_robin(names: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (i % len(names)).cast("int") + 1)


def whole_hash(content: Column) -> Column:
    return F.md5(content)


def prefix_hash(content: Column, length: int = PREFIX) -> Column:
    """MD5 of the first bytes; a missing file has the hash of an empty one."""
    return F.md5(F.substring(F.coalesce(content, F.lit(b"")), 1, length))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def imbalance(background: Column, road: Column) -> Column:
    return background / F.greatest(road, F.lit(1e-6))


def advice(ratio: Column) -> Column:
    return F.when(ratio > 10, "severe").when(ratio > 5, "moderate").otherwise("acceptable")
