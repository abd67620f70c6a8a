"""Pixels of TIFF files of any depth (SRC11-12): strips and tiles, chunky and planar, decoded inside tasks.

Spark's image source knows 8-bit files only as Java's reader takes them; scenes have 16 bits or floating point, and several
bands. A file is decoded into the type it is stored in. Compressions: none, PackBits, LZW, Deflate, LZMA, Zstandard;
predictors: horizontal and floating point; classic and big files, either byte order. JPEG inside TIFF is not decoded.
"""

from __future__ import annotations

import lzma
import struct
import zlib

import numpy as np

from . import geotiff

#: Fixed values of the TIFF 6.0 specification and its registered extensions: tags, compressions, and codes of LZW.
COMPRESSION, FILL_ORDER, OFFSETS, ROWS, COUNTS, PLANAR, PREDICTOR = 259, 266, 273, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
NONE, LZW, DEFLATE, PACK_BITS, OLD_DEFLATE, LZMA, ZSTD = 1, 5, 8, 32773, 32946, 34925, 50000
CLEAR, END, WIDEST = 256, 257, 12


class TiffError(ValueError):
    """The file is damaged or of a kind that is not decoded."""


def unpacked_bits(data: bytes) -> bytes:
    """PackBits: runs of a byte and stretches of bytes as they are."""
    out, at = bytearray(), 0
    while at < len(data):
        n, at = data[at], at + 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


def unpacked_lzw(data: bytes) -> bytes:
    """LZW with the highest bits first; codes grow by a bit one code early, as the format has it."""
    first = [bytes([k]) for k in range(256)] + [b"", b""]
    out, table, width, before, bits, held = bytearray(), list(first), 9, None, 0, 0
    for byte in data:
        bits, held = (bits << 8) | byte, held + 8
        if held < width:
            continue
        held -= width
        code = bits >> held
        bits &= (1 << held) - 1
        if code == CLEAR:
            table, width, before = list(first), 9, None
            continue
        if code == END:
            break
        if before is None:
            found = table[code] if code < CLEAR else None
        elif code < len(table):
            found = table[code]
            table.append(before + found[:1])
        else:
            found = before + before[:1] if code == len(table) else None
            table.append(found)
        if found is None:
            raise TiffError("damaged LZW data")
        out += found
        before = found
        if len(table) >= (1 << width) - 1 and width < WIDEST:
            width += 1
    return bytes(out)


def unpacked_zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


UNPACK = {NONE: bytes, PACK_BITS: unpacked_bits, LZW: unpacked_lzw, DEFLATE: zlib.decompress, OLD_DEFLATE: zlib.decompress, LZMA: lzma.decompress, ZSTD: unpacked_zstd}


def _samples(raw: bytes, rows: int, cols: int, deep: int, bits: int, kind: np.dtype, predictor: int) -> np.ndarray:
    """(rows, cols, deep) of an unpacked strip or tile; one that is cut short is an error."""
    line = -(-cols * deep * bits // 8)
    if len(raw) < rows * line:
        raise TiffError("a strip or tile is cut short")
    x = np.frombuffer(raw, np.uint8, rows * line).reshape(rows, line)
    if bits < 8:
        single = np.unpackbits(x, axis=1)[:, : cols * deep * bits].reshape(rows, cols, deep, bits)
        return (single * (1 << np.arange(bits - 1, -1, -1, dtype=np.uint8))).sum(axis=3, dtype=np.uint8)
    if predictor == 3:
        x = np.cumsum(x.reshape(rows, -1, deep), axis=1, dtype=np.uint8).reshape(rows, bits // 8, cols * deep)
        return np.ascontiguousarray(x.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(rows, cols, deep).astype(kind.newbyteorder("="))
    x = np.ascontiguousarray(x).view(kind).reshape(rows, cols, deep).astype(kind.newbyteorder("="))
    if predictor == 2:
        whole = x.view(f"u{bits // 8}")
        x = np.cumsum(whole, axis=1, dtype=whole.dtype).view(x.dtype)
    return x


def decode(content: bytes) -> np.ndarray:
    """(height, width, bands) of a file's first image, in the type that it is stored in. Raises TiffError."""
    try:
        return _decode(content)
    except (zlib.error, lzma.LZMAError, struct.error, KeyError, IndexError, OverflowError, MemoryError, ImportError) as e:
        raise TiffError(f"not decoded: {type(e).__name__} {e}") from e
    except Exception as e:
        if isinstance(e, TiffError) or type(e).__name__ == "ZstdError":
            raise TiffError(str(e)) from e
        raise


def _decode(content: bytes) -> np.ndarray:
    tags = geotiff.tags(content)
    if geotiff.WIDTH not in tags or geotiff.HEIGHT not in tags:
        raise TiffError("no TIFF file")
    one = lambda tag, usual: tags.get(tag, (usual,))[0]
    w, h, bands, planar, packing, predictor = tags[geotiff.WIDTH][0], tags[geotiff.HEIGHT][0], one(geotiff.SAMPLES, 1), one(PLANAR, 1), one(COMPRESSION, NONE), one(PREDICTOR, 1)
    depths = set(tags.get(geotiff.BITS, (1,)))
    letter = {1: "u", 2: "i", 3: "f", 4: "u"}.get(one(geotiff.FORMAT, 1))
    bits = depths.pop()
    if depths or letter is None or bits not in ((16, 32, 64) if letter == "f" else (8, 16, 32, 64) if letter == "i" else (1, 2, 4, 8, 16, 32, 64)):
        raise TiffError("samples of this kind are not decoded")
    if packing not in UNPACK or predictor not in (1, 2, 3) or predictor == 3 and letter != "f" or predictor == 2 and bits < 8:
        raise TiffError(f"compression {packing} with predictor {predictor} is not decoded")
    kind = np.dtype(f"{letter}{max(bits // 8, 1)}").newbyteorder("<" if content[:2] == b"II" else ">")
    tiled = TILE_WIDTH in tags
    wide, high = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (w, min(one(ROWS, h), h))
    offsets, counts = tags[TILE_OFFSETS if tiled else OFFSETS], tags.get(TILE_COUNTS if tiled else COUNTS)
    down, across, planes = -(-h // high), -(-w // wide), bands if planar == 2 else 1
    deep = 1 if planar == 2 else bands
    if len(offsets) < down * across * planes:
        raise TiffError("strips or tiles are missing")
    counts = counts or [len(content) - offsets[0]]
    turned = bytes(int(f"{k:08b}"[::-1], 2) for k in range(256)) if one(FILL_ORDER, 1) == 2 else None
    out = np.zeros((h, w, bands), kind.newbyteorder("="))
    for k in range(down * across * planes):
        plane, place = divmod(k, down * across)
        y, x = place // across * high, place % across * wide
        rows = high if tiled else min(high, h - y)
        if not counts[k]:  # a sparse file leaves such parts out
            continue
        raw = content[offsets[k] : offsets[k] + counts[k]]
        if len(raw) < counts[k]:
            raise TiffError("the file is cut short")
        raw = UNPACK[packing](raw.translate(turned) if turned else raw)
        part = _samples(raw, rows, wide, deep, bits, kind, predictor)
        band = slice(plane, plane + 1) if planar == 2 else slice(None)
        out[y : y + high, x : x + wide, band] = part[: h - y, : w - x]
    return out
