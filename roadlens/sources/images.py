"""Pixels of image files as rows (SRC11-12, RAS1-4, FN5-6, SNK2)."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions import numbers, text
from roadlens.operators.kernels import lanczos, levels, stretched
from roadlens.operators.stats import quantiles
from roadlens.session import cut, small

from . import tiff

TIFF = (".tif", ".tiff")
#: The weights of blue, green and red in grey, in parts of 2^14.
LUMA = np.array([1868, 9617, 4899])


FILE = ["height", "width", "channels", "pixels"]
#: The path of a file as its owner wrote it, without a scheme. Sources give it as an address, with escapes.
LOCAL_PATH = "regexp_replace(url_decode(replace(_metadata.file_path, '+', '%2B')), '^[a-z]+:/+', '/')"


def among(hashes: list[int]) -> Column:
    """Whether a file's path is one of those with the given xxhash64: a condition that chooses files before any is opened."""
    return F.expr(f"xxhash64({LOCAL_PATH}) IN ({', '.join(f'{h}L' if h > -(2**63) else 'cast(-9223372036854775808 as bigint)' for h in hashes)})") if hashes else F.lit(False)


def _files(spark: SparkSession, source: str, path: str, named: Column | None) -> DataFrame:
    """Files of a folder as a source gives them: TIFF files by binaryFile, all others by image."""
    rows = spark.read.format(source).option("recursiveFileLookup", "true")
    rows = (rows.option("dropInvalid", "false") if source == "image" else rows).load(path)
    is_tiff = text.extension(F.expr(LOCAL_PATH)).isin(*TIFF)
    chosen = is_tiff if source == "binaryFile" else ~is_tiff
    return rows.filter(chosen if named is None else chosen & named)


def images(spark: SparkSession, path: str, broken: bool = False, named: Column | None = None) -> DataFrame:
    """path, height, width, channels, pixels (bytes as stored: blue, green, red) of JPEG, PNG and other files that Java reads, but TIFF.

    Paths have no scheme. Files that cannot be decoded go or, with broken, stay with a height of -1 and no pixels. named: a
    condition on LOCAL_PATH or `among`; files without it are not opened.
    """
    rows = _files(spark, "image", path, named)
    out = rows.select(F.expr(LOCAL_PATH).alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("pixels"))
    return out if broken else out.filter("height > 0")


def tiff_row(content: bytes, mask: bool) -> tuple:
    """height, width, channels, pixels of a TIFF file: the first three bands as bytes, stretched between their percentiles if
    they are of another type; of a mask whether its first band is above 0. A height of -1 if it cannot be decoded."""
    try:
        x = tiff.decode(content)
    except tiff.TiffError:
        return -1, -1, -1, b""
    if mask:
        return (*x.shape[:2], 1, ((x[:, :, 0] > 0) * np.uint8(255)).tobytes())
    x = stretched(x[:, :, : 3 if x.shape[2] > 2 else 1])
    return (*x.shape, np.ascontiguousarray(x[:, :, ::-1]).tobytes())


def tiff_contents(spark: SparkSession, path: str, named: Column | None = None) -> DataFrame:
    """path and content of the TIFF files of a folder; named as for images."""
    return _files(spark, "binaryFile", path, named).select(F.expr(LOCAL_PATH).alias("path"), "content")


def decoded_tiffs(rows: DataFrame, is_mask: Column | None = None) -> DataFrame:
    """rows (content and any other columns) with height, width, channels and pixels in place of content, as tiff_row has them."""
    kept = [c for c in rows.columns if c != "content"]
    kinds = dict(rows.dtypes)

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(len(b)):  # a scene at a time
                one = b.iloc[k : k + 1]
                yield one[kept].assign(**{n: [v] for n, v in zip(FILE, tiff_row(bytes(one["content"].iloc[0] or b""), bool(one["__mask"].iloc[0])))})

    marked = rows.withColumn("__mask", F.lit(False) if is_mask is None else is_mask)
    return marked.mapInPandas(decoded, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", height int, width int, channels int, pixels binary")


def tiffs(spark: SparkSession, path: str, broken: bool = False, named: Column | None = None, is_mask: Column | None = None) -> DataFrame:
    """As images, of the TIFF files of a folder, of any depth (SRC11-12). is_mask: a condition on path for files that are masks."""
    out = decoded_tiffs(tiff_contents(spark, path, named), is_mask)
    return out if broken else out.filter("height > 0")


def hashes(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    """path (without a scheme), size_bytes, md5 of the whole file and of its first 64 KiB, and any more that is told from `content` in the same pass."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.expr(LOCAL_PATH).alias("path"), F.col("length").alias("size_bytes"), numbers.whole_hash(F.col("content")).alias("md5"), numbers.prefix_hash(F.col("content")).alias("md5_prefix"), *more)


def rgb_of(pixels: bytes, channels: int) -> np.ndarray:
    """Pixels as stored, as rows of red, green and blue. Grey is repeated; a fourth channel goes."""
    x = np.frombuffer(pixels, np.uint8).reshape(-1, channels)
    return np.repeat(x, 3, 1) if channels == 1 else x[:, 2::-1]


def mask_of(pixels: bytes, channels: int, over: int = 127, any_channel: bool = False) -> np.ndarray:
    """Whether each pixel is grey enough: by the usual weights of blue, green and red, or by its brightest channel."""
    x = np.frombuffer(pixels, np.uint8).reshape(-1, channels)[:, :3]
    if x.shape[1] == 1 or any_channel:
        return (x > over).any(1)
    return (x.astype(np.int64) @ LUMA + (1 << 13)) >> 14 > over


def standardised(rows: DataFrame) -> DataFrame:
    """Adds rgb: red, green and blue bytes. Grey is repeated; a fourth channel goes."""

    @F.pandas_udf("binary")
    def rgb(pixels: pd.Series, channels: pd.Series) -> pd.Series:
        return pd.Series([rgb_of(p, int(c)).tobytes() for p, c in zip(pixels, channels)])

    return rows.withColumn("rgb", rgb("pixels", "channels"))


def limited(rows: DataFrame, most: int) -> DataFrame:
    """rgb, height and width of images whose longer side exceeds most are scaled down (RAS4)."""

    @F.pandas_udf("height int, width int, rgb binary")
    def scaled(rgb: pd.Series, heights: pd.Series, widths: pd.Series) -> pd.DataFrame:
        out = [lanczos(np.frombuffer(x, np.uint8).reshape(h, w, 3), most) for x, h, w in zip(rgb, heights, widths)]
        return pd.DataFrame({"height": [x.shape[0] for x in out], "width": [x.shape[1] for x in out], "rgb": [x.tobytes() for x in out]})

    return rows.withColumn("__s", scaled("rgb", "height", "width")).withColumns({c: F.col(f"__s.{c}") for c in ("rgb", "height", "width")}).drop("__s")


def masks(rows: DataFrame, over: int = 127, any_channel: bool = False) -> DataFrame:
    """Adds mask (bytes, 255 where the grey value, or any channel, is over the limit, else 0) and road_pixel_count.

    A TIFF mask counts from its first level on (SRC12).
    """

    @F.pandas_udf("mask binary, road long")
    def threshold(pixels: pd.Series, channels: pd.Series, limits: pd.Series) -> pd.DataFrame:
        out = []
        for p, c, limit in zip(pixels, channels, limits):
            on = mask_of(p, int(c), int(limit), any_channel)
            out.append(((on * np.uint8(255)).tobytes(), int(on.sum())))
        return pd.DataFrame(out, columns=["mask", "road"])

    limit = F.when(text.extension(F.col("path")).isin(*TIFF), 0).otherwise(over)
    return rows.withColumn("__m", threshold("pixels", "channels", limit)).withColumns({"mask": F.col("__m.mask"), "road_pixel_count": F.col("__m.road")}).drop("__m")


def bytes_as_array(data: Column) -> Column:
    """Bytes as an array of numbers from 0 to 255, for the column expressions on rasters."""

    @F.pandas_udf("array<int>")
    def unpack(x: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(b, np.uint8).astype(np.int32) for b in x])

    return unpack(data)


def png(pixels: np.ndarray) -> bytes:
    """A PNG file of (h, w) grey or (h, w, 3) colour bytes."""
    h, w = pixels.shape[:2]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = np.hstack([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1).astype(np.uint8)])
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if pixels.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 9)) + chunk(b"IEND", b"")


def as_png(data: Column, height: Column, width: Column, channels: int = 3) -> Column:
    @F.pandas_udf("binary")
    def encode(d: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([png(np.frombuffer(x, np.uint8).reshape((a, b, 3) if channels == 3 else (a, b))) for x, a, b in zip(d, h, w)])

    return encode(data, height, width)


def write_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> None:
    """Writes each row's content (bytes) as a file of its name below a folder of any file system that Arrow knows (SNK2-3, SNK9).

    A task that is run again writes the same files again. Names may hold folders; rows without a name or content write nothing.
    """

    def written(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for b in batches:
            for n, c in zip(b[name], b[content]):
                store.create_dir(f"{top}/{n}".rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(f"{top}/{n}") as out:
                    out.write(c)
            yield pd.DataFrame({"n": [len(b)]})

    known = rows.select(name, content).filter(F.col(name).isNotNull() & F.col(content).isNotNull())
    known.mapInPandas(written, "n long").agg(F.sum("n")).first()


def write_tiles(tiles: DataFrame, folder: str) -> None:
    """Tiles (tile_id, split, height, width, rgb, mask) as {split}/images/{tile_id}.png and {split}/masks/{tile_id}.png."""
    at = lambda kind: F.concat("split", F.lit(f"/{kind}/"), "tile_id", F.lit(".png"))
    write_files(tiles.select(at("images").alias("name"), as_png(F.col("rgb"), F.col("height"), F.col("width")).alias("content")), folder)
    write_files(tiles.filter("mask is not null").select(at("masks").alias("name"), as_png(F.col("mask"), F.col("height"), F.col("width"), 1).alias("content")), folder)


#: Scenes of which a task counts the pixels at a time.
COUNTED = 64


def value_counts(rows: DataFrame, *by: str) -> DataFrame:
    """by, band, value, n: how often each value stands in a band of the TIFF files (content) of each group.

    A file of 16 bits makes at most 65,536 rows a band. Files that are not decoded, and NaN, count nothing.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held: dict = {}
            for k in range(len(b)):
                try:
                    x = tiff.decode(bytes(b["content"].iloc[k] or b""))
                except tiff.TiffError:
                    continue
                for band in range(x.shape[2]):
                    values, n = np.unique(x[:, :, band], return_counts=True)
                    values, n = values[values == values], n[values == values]
                    held.setdefault((*(b[c].iloc[k] for c in by), band), []).append((values.astype(float), n))
                if len(held) >= COUNTED:
                    yield from _counts(held, by)
            yield from _counts(held, by)

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", band int, value double, n long"
    return rows.select(*by, "content").mapInPandas(counted, schema).groupBy(*by, "band", "value").agg(F.sum("n").alias("n"))


def _counts(held: dict, by: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """One frame for each group that is held, which is let go."""
    while held:
        key, parts = held.popitem()
        yield pd.DataFrame({**{c: [v] * sum(len(p[0]) for p in parts) for c, v in zip(by, key)}, "band": key[-1], "value": np.concatenate([p[0] for p in parts]), "n": np.concatenate([p[1] for p in parts])})


def stretched_scenes(rows: DataFrame, *by: str, low: float = 2, high: float = 98) -> DataFrame:
    """rows (by, content and any other columns) with height, width, channels and pixels in place of content: the files of a
    group are one scene, each of whose first three bands is stretched between its two percentiles over all of them (RAS5).

    Scenes of bytes are stretched too; NaN becomes 0. Files that are not decoded have a height of -1.
    """
    ends = quantiles(value_counts(rows, *by), [*by, "band"], "value", "n", [low / 100, high / 100])
    known = cut(ends.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("band", "quantiles"))).alias("__ends")))
    kept = [c for c in rows.columns if c != "content"]
    kinds = dict(rows.dtypes)

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(len(b)):
                one = b.iloc[k : k + 1]
                try:
                    x, of = tiff.decode(bytes(one["content"].iloc[0] or b"")), dict(one["__ends"].iloc[0])
                    x = np.stack([levels(x[:, :, n], *of[n]) for n in range(3 if x.shape[2] > 2 else 1)], axis=2)
                    row = (*x.shape, np.ascontiguousarray(x[:, :, ::-1]).tobytes())
                except tiff.TiffError:
                    row = (-1, -1, -1, b"")
                yield one[kept].assign(**{n: [v] for n, v in zip(FILE, row)})

    joined = rows.join(small(known), list(by), "left")
    return joined.mapInPandas(decoded, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", height int, width int, channels int, pixels binary")
