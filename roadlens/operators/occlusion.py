"""Synthetic occlusion of tiles and measures of masks, as Arrow batches of rasters (RAS11-20, RAS24, D4).

A row holds a whole tile; tiles are independent, so nothing shuffles. All random numbers of a tile come from a hash of
seed, tile, type and severity: any executor that computes a tile again gets the same pixels.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels

TYPES = ("tree_canopy", "building_shadow", "vehicle", "cloud_cover")
SEVERITIES = ("light", "medium", "heavy")
#: Fixed values, to "End of fixed values": the share of pixels that a type aims at in each severity, counts of vehicles, opacities of clouds,
#: colours, sizes in pixels of a tile of 512, and limits of objects.
TARGET = {
    "tree_canopy": {"light": (0.10, 0.25), "medium": (0.25, 0.50), "heavy": (0.50, 0.75)},
    "building_shadow": {"light": (0.05, 0.20), "medium": (0.20, 0.40), "heavy": (0.40, 0.65)},
    "cloud_cover": {"light": (0.05, 0.20), "medium": (0.20, 0.45), "heavy": (0.45, 0.70)},
}
VEHICLES = {"light": (1, 3), "medium": (3, 8), "heavy": (8, 20)}
OPACITY = {"light": (0.2, 0.5), "medium": (0.5, 0.75), "heavy": (0.75, 0.95)}
CANOPY_RGB, CANOPY_SPREAD, CANOPY_ALPHA, CANOPY_EDGE, CANOPY_RADIUS, CANOPY_NOISE = (34, 85, 34), 20, (0.55, 0.80), 0.35, (15, 60), 0.05
SHADOW_DARK, SHADOW_FADE, SUN, SHADOW_LENGTH, BUILDING, SHADOWS = 0.35, 0.4, (30, 150), (0.5, 2.0), (20, 80), 50
VEHICLE_W, VEHICLE_H, HIGHLIGHT = (8, 25), (15, 45), 60
VEHICLE_RGB = ((200, 200, 200), (40, 40, 40), (180, 30, 30), (30, 30, 160), (200, 180, 30), (50, 100, 50))
CLOUD_RGB, CLOUD_SIGMA, CLOUD_BLUR, CLOUD_COVER, CLOUD_EDGE, CLOUDS = (240, 242, 245), (20, 60), 15, 0.1, 0.15, 30
#: End of fixed values.

#: Trees in a row that add no pixel, after which none is expected to.
STALE = 400


def generator(seed: int, *names: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.md5(":".join(map(str, (seed, *names))).encode()).digest()[:8], "little"))


class Draw:
    """The random choices of one tile. Sizes of objects follow the tile's, from 512 pixels."""

    def __init__(self, shape: tuple[int, int], rng: np.random.Generator):
        self.h, self.w = shape
        self.unit, self.rng = max(shape) / 512, rng

    def whole(self, low: int, high: int) -> int:
        """A whole number from low to high, or the middle where there is none between."""
        return int(self.rng.integers(low, high + 1)) if low <= high else (low + high) // 2

    def pixels(self, bounds: tuple[int, int]) -> int:
        return self.whole(*(max(1, int(b * self.unit)) for b in bounds))


def _canopy(image: np.ndarray, road: np.ndarray, severity: str, draw: Draw) -> tuple[np.ndarray, np.ndarray]:
    """Trees until the share aimed at is reached, however many that takes; each looks at the pixels of its own square only.

    A tile so small that its trees do not reach that share ends when STALE of them in a row have added nothing; what was
    reached is the coverage that `simulate` tells.
    """
    out, cover, rng = image.astype(float), np.zeros((draw.h, draw.w), bool), draw.rng
    wanted = rng.uniform(*TARGET["tree_canopy"][severity]) * cover.size
    widest = max(1, int(CANOPY_RADIUS[1] * draw.unit))
    texture = kernels.noise_texture(max(4 * widest, draw.h, draw.w) + 1, CANOPY_NOISE / draw.unit, rng)
    covered = stale = 0
    while covered < wanted and stale < STALE:
        r = draw.pixels(CANOPY_RADIUS)
        cx, cy = draw.whole(r, draw.w - r), draw.whole(r, draw.h - r)
        tree = kernels.noisy_disc(r, texture, rng) > CANOPY_EDGE
        top, left = max(0, cy - r), max(0, cx - r)
        tree = tree[top - cy + r : draw.h - cy + r, left - cx + r : draw.w - cx + r]
        box = np.s_[top : top + tree.shape[0], left : left + tree.shape[1]]
        leaves = np.clip(np.array(CANOPY_RGB) + rng.uniform(-CANOPY_SPREAD, CANOPY_SPREAD, 3), 0, 255)
        out[box][tree] += (leaves - out[box][tree]) * rng.uniform(*CANOPY_ALPHA)
        added = int((tree & ~cover[box]).sum())
        covered, stale = covered + added, 0 if added else stale + 1
        cover[box] |= tree
    return out, cover


def _shadows(image: np.ndarray, road: np.ndarray, severity: str, draw: Draw) -> tuple[np.ndarray, np.ndarray]:
    """Buildings' shadows, SHADOWS at most: what light is left is one layer, by which the image is multiplied in the end."""
    light, rng = np.ones((draw.h, draw.w)), draw.rng
    wanted = rng.uniform(*TARGET["building_shadow"][severity])
    for _ in range(SHADOWS):
        if (light < 1).mean() >= wanted:
            break
        x, y, wide, high = draw.whole(draw.w // 8, 7 * draw.w // 8), draw.whole(draw.h // 8, 7 * draw.h // 8), draw.pixels(BUILDING), draw.pixels(BUILDING)
        sun, length = np.radians(rng.uniform(*SUN)), rng.uniform(*SHADOW_LENGTH) * max(wide, high)
        corners = np.array([(x, y), (x + wide, y), (x + wide, y + high), (x, y + high)])
        outline = np.vstack([corners, (corners + (length * np.array([np.cos(sun), np.sin(sun)])).astype(int))[::-1]])
        (x0, y0), (x1, y1) = np.maximum(outline.min(0), 0), np.minimum(outline.max(0) + 1, (draw.w, draw.h))
        if x0 >= x1 or y0 >= y1:
            continue
        shade = kernels.inside(y1 - y0, x1 - x0, [tuple(p) for p in (outline - (x0, y0)).tolist()])
        # beyond the box is light, beyond the tile nothing
        rim = [(int(y0 > 0), int(y1 < draw.h)), (int(x0 > 0), int(x1 < draw.w))]
        depth = kernels.chamfer(np.pad(shade, rim))[rim[0][0] : rim[0][0] + y1 - y0, rim[1][0] : rim[1][0] + x1 - x0][shade]
        depth = depth / max(depth.max(initial=0), 1e-6) if np.isfinite(depth).all() else np.ones(len(depth))
        light[y0:y1, x0:x1][shade] *= 1 - (1 - SHADOW_FADE * depth) * (1 - SHADOW_DARK) ** 2
    return image * light[:, :, None], light < 1


def _vehicles(image: np.ndarray, road: np.ndarray, severity: str, draw: Draw) -> tuple[np.ndarray, np.ndarray]:
    """Boxes with a bright front, centred on road pixels; without any road, on the diagonal. The last row and column painted do not count as covered."""
    out, cover = image.copy(), np.zeros((draw.h, draw.w), bool)
    spots = np.argwhere(road > 0)
    if not len(spots):
        spots = np.repeat(np.arange(min(draw.h, draw.w))[:, None], 2, 1)
    for spot in spots[draw.rng.integers(0, len(spots), draw.whole(*VEHICLES[severity]))]:
        size = np.array([draw.pixels(VEHICLE_H), draw.pixels(VEHICLE_W)])
        paint = np.array(VEHICLE_RGB[draw.whole(0, len(VEHICLE_RGB) - 1)])
        (y0, x0), (y1, x1) = np.maximum(spot - size // 2, 0), np.minimum(spot + size // 2, (draw.h, draw.w))
        out[y0 : y1 + 1, x0 : x1 + 1] = paint
        out[y0 + 1 : y0 + max(2, size[0] // 6) + 1, x0 + 1 : x1] = np.minimum(paint + HIGHLIGHT, 255)
        cover[y0:y1, x0:x1] = True
    return out, cover


def _clouds(image: np.ndarray, road: np.ndarray, severity: str, draw: Draw) -> tuple[np.ndarray, np.ndarray]:
    """The highest of bell curves, CLOUDS at most, blurred; a bell is the product of its profiles along the two axes."""
    haze, rng = np.zeros((draw.h, draw.w)), draw.rng
    wanted = rng.uniform(*TARGET["cloud_cover"][severity])
    for _ in range(CLOUDS):
        if (haze > CLOUD_COVER).mean() >= wanted:
            break
        spread = max(1.0, int(rng.uniform(*CLOUD_SIGMA) * draw.unit * 1.5) / 2)
        down, across = (np.exp(-(((np.arange(n) - draw.whole(0, n)) / spread) ** 2) / 2) for n in (draw.h, draw.w))
        haze = np.maximum(haze, np.outer(down, across))
    haze = kernels.blurred(haze, max(CLOUD_BLUR * draw.unit, 0.5))
    haze /= max(haze.max(), 1e-6)
    white = (haze * rng.uniform(*OPACITY[severity]))[:, :, None]
    return image * (1 - white) + np.array(CLOUD_RGB) * white, haze > CLOUD_EDGE


PAINTERS = {"tree_canopy": _canopy, "building_shadow": _shadows, "vehicle": _vehicles, "cloud_cover": _clouds}


def occlude(image: np.ndarray, road: np.ndarray, kind: str, severity: str, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The occluded image and the mask of what is covered."""
    out, cover = PAINTERS[kind](image, road, severity, Draw(image.shape[:2], rng))
    return out.clip(0, 255).astype(np.uint8), cover


def applied(tiles: DataFrame, seed: int = 42) -> DataFrame:
    """tiles (tile_id, height, width, rgb, mask, occlusion_type, severity and any others) with rgb occluded where a type is given (RAS20).

    A null mask is one without road. Masks stay as they are: what is hidden is still road.
    """

    @F.pandas_udf("binary")
    def painted(ids: pd.Series, heights: pd.Series, widths: pd.Series, rgb: pd.Series, masks: pd.Series, kinds: pd.Series, severities: pd.Series) -> pd.Series:
        out = []
        for i, h, w, x, m, kind, severity in zip(ids, heights, widths, rgb, masks, kinds, severities):
            if kind is not None and x is not None:
                road = np.zeros((h, w), np.uint8) if m is None else np.frombuffer(m, np.uint8).reshape(h, w)
                x = occlude(np.frombuffer(x, np.uint8).reshape(h, w, 3), road, kind, severity, generator(seed, i, kind, severity))[0].tobytes()
            out.append(x)
        return pd.Series(out)

    return tiles.withColumn("rgb", painted(F.col("tile_id").cast("string"), "height", "width", "rgb", "mask", "occlusion_type", "severity"))


def simulate(tiles: DataFrame, seed: int = 42) -> DataFrame:
    """image_id, occlusion_type, severity, coverage_pct, road_coverage_pct, occluded (RGB bytes), cover (bytes).

    tiles: tile_id, height, width, rgb and mask (bytes, row-major), occlusion_type, severity, as the plan gives them.
    A null mask is one without road. Percentages have two decimals.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                image = np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)
                road = np.zeros((r.height, r.width), np.uint8) if r.mask is None else np.frombuffer(r.mask, np.uint8).reshape(r.height, r.width)
                out, cover = occlude(image, road, r.occlusion_type, r.severity, generator(seed, r.tile_id, r.occlusion_type, r.severity))
                n = int((road > 0).sum())
                rows.append((r.tile_id, r.occlusion_type, r.severity, round(100 * float(cover.mean()), 2), round(100 * float((cover & (road > 0)).sum()) / n, 2) if n else 0.0, out.tobytes(), (cover * np.uint8(255)).tobytes()))
            yield pd.DataFrame(rows, columns=["image_id", "occlusion_type", "severity", "coverage_pct", "road_coverage_pct", "occluded", "cover"])

    wanted = tiles.select(F.col("tile_id").cast("string"), "height", "width", "rgb", "mask", "occlusion_type", "severity")
    return wanted.mapInPandas(run, "image_id string, occlusion_type string, severity string, coverage_pct double, road_coverage_pct double, occluded binary, cover binary")


def road_width(masks: DataFrame, *keys: str, data: str = "data", width: str = "width") -> DataFrame:
    """keys, avg_road_width_px, max_road_width_px, road_density of masks held as arrays or bytes; a null mask is one without road.

    Widths are twice the mean and twice the greatest distance of road pixels to the background; null without road.
    """

    @F.pandas_udf("avg_road_width_px double, max_road_width_px double, road_density double")
    def measured(pixels: pd.Series, widths: pd.Series) -> pd.DataFrame:
        rows = []
        for p, w in zip(pixels, widths):
            if p is None:
                rows.append((None, None, 0.0))
                continue
            m = (np.frombuffer(p, np.uint8) if isinstance(p, bytes) else np.asarray(p)).reshape(-1, int(w)) > 0
            d = kernels.chamfer(m)[m]
            rows.append((2 * d.mean(), 2 * d.max(), m.mean()) if len(d) else (None, None, 0.0))
        return pd.DataFrame(rows, columns=["avg_road_width_px", "max_road_width_px", "road_density"]).astype(float)

    return masks.withColumn("__m", measured(data, width)).select(*keys, "__m.*")


def skeleton_nodes(masks: DataFrame, *keys: str, data: str = "data", width: str = "width") -> DataFrame:
    """keys, pixels, endpoints, junctions, segments of the centre lines of masks held as arrays."""

    @F.pandas_udf("pixels long, endpoints long, junctions long, segments long")
    def counted(pixels: pd.Series, widths: pd.Series) -> pd.DataFrame:
        rows = []
        for p, w in zip(pixels, widths):
            s = kernels.thinned(np.asarray(p).reshape(-1, int(w)))
            g = np.pad(s, 1)
            n = sum(np.roll(g, (a, b), (0, 1)) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b)[1:-1, 1:-1]
            rows.append((int(s.sum()), int(((s > 0) & (n == 1)).sum()), int(((s > 0) & (n > 2)).sum()), len(kernels.lines(s))))
        return pd.DataFrame(rows, columns=["pixels", "endpoints", "junctions", "segments"])

    return masks.withColumn("__m", counted(data, width)).select(*keys, "__m.*")


def centre_lines(masks: DataFrame, *keys: str, data: str = "data", width: str = "width") -> DataFrame:
    """keys, line (0 first), points array<struct<x, y>>: one row per chain of at least two pixels."""

    @F.pandas_udf("array<array<struct<x: int, y: int>>>")
    def traced(pixels: pd.Series, widths: pd.Series) -> pd.Series:
        out = []
        for p, w in zip(pixels, widths):
            chains = kernels.lines(kernels.thinned(np.asarray(p).reshape(-1, int(w))))
            out.append([[{"x": x, "y": y} for x, y in c] for c in chains if len(c) > 1])
        return pd.Series(out)

    return masks.withColumn("__l", traced(data, width)).select(*keys, F.posexplode("__l").alias("line", "points"))


BORDERS = "array<struct<hole: boolean, points: array<struct<x: int, y: int>>>>"


def borders(data: Column | str, width: Column | str, thin: bool = False) -> Column:
    """All borders of a mask held as an array or bytes, point by point: whether a hole's, and its points. A null mask has none."""

    @F.arrow_udf(BORDERS)
    def followed(pixels: pa.Array, widths: pa.Array) -> pa.Array:
        # flat arrays grow with the borders' points; objects for all points of a batch would take many times as much
        ends, holes, stops, xs, ys = array("i", [0]), array("b"), array("i", [0]), array("i"), array("i")
        for p, w in zip(pixels, widths):
            if p.is_valid:
                flat = np.frombuffer(p.as_buffer(), np.uint8) if pa.types.is_binary(p.type) or pa.types.is_large_binary(p.type) else p.values.to_numpy(zero_copy_only=False)
                m = flat.reshape(-1, w.as_py())
                for hole, points in kernels.contours(kernels.thinned(m) if thin else m):
                    holes.append(hole)
                    xs.extend(x for x, _ in points)
                    ys.extend(y for _, y in points)
                    stops.append(len(xs))
            ends.append(len(holes))
        whole = lambda v: pa.array(np.frombuffer(v, np.int32), pa.int32())
        points = pa.ListArray.from_arrays(whole(stops), pa.StructArray.from_arrays([whole(xs), whole(ys)], ["x", "y"]))
        return pa.ListArray.from_arrays(whole(ends), pa.StructArray.from_arrays([pa.array(np.frombuffer(holes, np.int8).astype(bool)), points], ["hole", "points"]))

    return followed(data, width)


def at_corners(points: Column) -> Column:
    """The points of a closed border at which its direction changes."""
    n = F.size(points)
    turn = lambda a, b: F.struct((b["x"] - a["x"]).alias("x"), (b["y"] - a["y"]).alias("y"))
    at = lambda k: F.get(points, F.pmod(k, n))
    return F.when(n < 2, points).otherwise(F.filter(points, lambda p, k: turn(at(k - 1), p) != turn(p, at(k + 1))))


def contours(masks: DataFrame, *keys: str, data: str = "data", width: str = "width", least: int = 2, thin: bool = False) -> DataFrame:
    """keys, line (0 first), hole, points array<struct<x, y>>: the closed borders of masks held as arrays or bytes, at their corners (RAS24).

    Borders of fewer than `least` corners go, as single pixels do. thin: the borders of a mask's centre lines instead of
    its own, which run along both sides of a line. A raster is followed in its row; null masks have no borders.
    """
    cornered = F.transform(borders(data, width, thin), lambda b: F.struct(b["hole"].alias("hole"), at_corners(b["points"]).alias("points")))
    rows = masks.withColumn("__l", F.filter(cornered, lambda b: F.size(b["points"]) >= least)).select(*keys, F.posexplode("__l").alias("line", "__b"))
    return rows.select(*keys, "line", "__b.hole", "__b.points")
