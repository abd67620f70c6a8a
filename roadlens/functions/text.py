"""Names, paths, ids and sizes as column expressions (PRJ3-5, FN1-4, FN11-12, SRC19, SRC23)."""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The file name without its last extension; names that begin with the only dot stay whole."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """The last extension in lower case with its dot, or an empty string."""
    return F.lower(F.regexp_extract(basename(path), r"(?<=.)(\.[^.]*)$", 1))


def image_id(name: Column) -> Column:
    """The stem of an image's name without the marker of satellite images."""
    return F.replace(stem(name), F.lit("_sat"), F.lit(""))


def title(x: Column) -> Column:
    """snake_case as Title Case."""
    return F.initcap(F.replace(x, F.lit("_"), F.lit(" ")))


def tile_id(split: Column, image: Column, row: Column, col: Column) -> Column:
    return F.format_string("%s_%s_r%03d_c%03d", split, image.cast("string"), row.cast("int"), col.cast("int"))


def index_in(tile: Column, mark: str, back: int) -> Column:
    """Row or column number of a tile id: the part that many from the end, without its mark; 0 if it is no number."""
    part = F.try_element_at(F.split(tile, "_"), F.lit(-back))
    return F.coalesce(F.regexp_replace(part, f"^{mark}", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def dimensions(width: Column, height: Column) -> Column:
    return F.concat_ws("x", width.cast("string"), height.cast("string"))


#: The doubles next to the halves of tenths, and whether a part of that size rounds up: of exact halves, 0.75 does and 0.25 does not.
HALVES = tuple(((2 * k + 1) / 20, Fraction((2 * k + 1) / 20) > Fraction(2 * k + 1, 20) or k == 7) for k in range(10))


def one_decimal(x: Column) -> Column:
    """x to one decimal as C and Python print it: by its exact value, where Java's formats round its shortest digits half up."""
    size = F.abs(x)
    whole = F.floor(size)
    tenths = reduce(add, [(size - whole >= half if up else size - whole > half).cast("long") for half, up in HALVES])
    digits = F.concat((whole + F.when(tenths > 9, 1).otherwise(0)).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    return F.concat(F.when(x < 0, "-").otherwise(""), digits)


def human_size(n: Column, units: tuple[str, ...] = UNITS) -> Column:
    """Bytes with the largest of the units that leaves at least one of it, to one decimal."""
    size = n.cast("double")
    scaled, unit = size / 1024.0 ** (len(units) - 1), F.lit(units[-1])
    for k in reversed(range(len(units) - 1)):
        below = size < 1024.0 ** (k + 1)
        scaled, unit = F.when(below, size / 1024.0**k).otherwise(scaled), F.when(below, units[k]).otherwise(unit)
    return F.concat(one_decimal(scaled), F.lit(" "), unit)


def after(path: Column, folder: str) -> Column:
    """The part of a path from the last step of that name on, or null."""
    parts = F.split(path, "[/\\\\]")
    at = F.array_position(F.reverse(parts), folder)
    return F.when(at > 0, F.array_join(F.slice(parts, F.size(parts) - at.cast("int") + 1, F.lit(1 << 20)), "/"))


def split_name(raw: Column) -> Column:
    """train, val or test; valid counts as val, a missing name as train."""
    low = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return F.when(low == "", "train").when(low == "valid", "val").otherwise(low)


def stamp(moment: Column) -> Column:
    """A time to the second, as YYYY-MM-DDThh:mm:ss."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def clock(seconds: Column) -> Column:
    """Seconds as hh:mm:ss; days are left out, as on a clock."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60)
