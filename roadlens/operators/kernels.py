"""Pixel kernels that no built-in function expresses, applied to batches of rasters inside tasks (RAS11-20, RAS24).

Each takes and gives NumPy arrays of one raster. Spark deals out the rasters; `occlusion`, `width` and `skeleton` wrap
these for DataFrames.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the 5 x 5 chamfer metric: steps along an axis, a diagonal, and a knight's move.
AXIS, DIAGONAL, KNIGHT = 1.0, 1.4, 2.1969


def chamfer(mask: np.ndarray) -> np.ndarray:
    """Distance of every set pixel to the nearest clear one; infinite if there is none.

    Two sweeps over the rows, down and up (Borgefors, 1986). A row takes its least from the two rows before it, then from
    its own pixels on one side; a running minimum does that for all of the row.
    """
    h, w = mask.shape
    d = np.full((h, w + 4), np.inf)  # two columns on either side
    d[:, 2:-2] = np.where(mask > 0, np.inf, 0.0)
    along = np.arange(w) * AXIS
    for _ in range(2):
        before = last = np.full(w + 4, np.inf)
        for row in d:
            least = np.minimum(row[2:-2], last[2:-2] + AXIS)
            for by, cost in ((1, DIAGONAL), (2, KNIGHT)):
                least = np.minimum(least, np.minimum(last[2 - by : w + 2 - by], last[2 + by : w + 2 + by]) + cost)
            least = np.minimum(least, np.minimum(before[1 : w + 1], before[3 : w + 3]) + KNIGHT)
            row[2:-2] = np.minimum.accumulate(least - along) + along
            before, last = last, row
        d = d[::-1, ::-1]  # the second sweep is the first over the picture turned by half a circle
    return d[:, 2:-2].copy()


def gaussian(h: int, w: int, cx: float, cy: float, radius: float) -> np.ndarray:
    y, x = np.ogrid[:h, :w]
    s = max(radius / 2.0, 1e-6)
    return np.exp(-((x - cx) ** 2 + (y - cy) ** 2) / (2 * s * s))


def noise(y: np.ndarray, x: np.ndarray, rng: np.random.Generator, octaves: int = 4) -> np.ndarray:
    """Gradient noise summed over octaves (Perlin, 1985), on lattices drawn from rng."""
    out = np.zeros(np.broadcast(y, x).shape)
    for k in range(octaves):
        angle = rng.uniform(0, 2 * np.pi, (64, 64))
        yy, xx = y * 2**k, x * 2**k
        y0, x0 = np.floor(yy).astype(int), np.floor(xx).astype(int)
        fy, fx = yy - y0, xx - x0
        fade = lambda t: t * t * t * (t * (6 * t - 15) + 10)
        corner = {}
        for a in (0, 1):
            for b in (0, 1):
                g = angle[(y0 + a) % 64, (x0 + b) % 64]
                corner[a, b] = np.sin(g) * (fy - a) + np.cos(g) * (fx - b)
        top = corner[0, 0] + fade(fx) * (corner[0, 1] - corner[0, 0])
        low = corner[1, 0] + fade(fx) * (corner[1, 1] - corner[1, 0])
        out += (top + fade(fy) * (low - top)) / 2**k
    return out


def noise_texture(size: int, scale: float, rng: np.random.Generator) -> np.ndarray:
    """A square of noise, from which blobs cut patches at random places."""
    y, x = np.mgrid[:size, :size] * scale
    return noise(y, x, rng)


def noisy_disc(radius: int, texture: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A square of 2 radius + 1 pixels: noise that falls off with the square of the distance from the middle, 0 beyond the radius."""
    n = 2 * radius + 1
    y, x = rng.integers(0, len(texture) - n + 1, 2)
    far = np.add.outer(np.arange(-radius, radius + 1) ** 2, np.arange(-radius, radius + 1) ** 2) / max(radius, 1) ** 2
    return np.where(far < 1, np.maximum(0, (texture[y : y + n, x : x + n] + 0.5) * (1 - far)), 0.0)


def blurred(x: np.ndarray, sigma: float) -> np.ndarray:
    """Separable Gaussian blur with a reflecting border."""
    r = int(np.ceil(3 * sigma))
    k = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    for axis in (0, 1):
        grown = np.pad(x, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        lines = np.lib.stride_tricks.sliding_window_view(grown, 2 * r + 1, axis=axis)
        x = lines @ (k / k.sum())
    return x


def lanczos(x: np.ndarray, most: int, a: int = 4) -> np.ndarray:
    """An image of (h, w, channels) bytes no side of which exceeds most, by Lanczos windows; sizes are cut to whole pixels."""
    h, w = x.shape[:2]
    if max(h, w) <= most:
        return x
    out = x.astype(float)
    for axis, n in enumerate((h, w)):
        m = max(1, int(n * most / max(h, w)))
        centre = (np.arange(m) + 0.5) * n / m - 0.5
        far = (np.arange(n)[None, :] - centre[:, None]) * m / n
        k = np.where(np.abs(far) < a, np.sinc(far) * np.sinc(far / a), 0.0)
        out = np.moveaxis(np.tensordot(k / k.sum(1, keepdims=True), out, (1, axis)), 0, axis)
    return out.round().clip(0, 255).astype(np.uint8)


def ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned whole numbers in the order of the values of any numeric type (NaN aside)."""
    x = np.ascontiguousarray(x)
    if x.dtype.kind == "u":
        return x
    u, sign = x.view(f"u{x.itemsize}"), np.array(1 << (8 * x.itemsize - 1), f"u{x.itemsize}")
    return np.where(u & sign, ~u, u | sign) if x.dtype.kind == "f" else u ^ sign


def order_statistics(x: np.ndarray, ranks: list[int]) -> list[float]:
    """The values of given ranks (0 the least) of a flat array, by histograms of 65,536 bins: one for types of up to 16 bits, else one for each 16 bits more."""
    keys, out = ordered(x), []
    for rank in ranks:
        where = np.arange(len(keys))
        for shift in range(max(8 * x.itemsize - 16, 0), -1, -16):
            digit = (keys[where] >> np.array(shift, keys.dtype)).astype(np.uint16)
            below = np.cumsum(np.bincount(digit, minlength=1 << 16))
            bin_ = int(np.searchsorted(below, rank, side="right"))
            rank -= int(below[bin_ - 1]) if bin_ else 0
            where = where[digit == bin_]
        out.append(float(x[where[0]]))
    return out


def between(a: float, b: float, t: float) -> float:
    """a + (b - a) t, taken from the nearer end."""
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)


def percentiles(x: np.ndarray, qs: tuple[float, ...]) -> list[float]:
    """Percentiles of a flat array with linear interpolation; NaN if it holds one."""
    if not x.size or x.dtype.kind == "f" and np.isnan(x).any():
        return [float("nan")] * len(qs)
    at = [(x.size - 1) * (q / 100) for q in qs]
    found = iter(order_statistics(x, [min(int(p) + k, x.size - 1) for p in at for k in (0, 1)]))
    return [between(next(found), next(found), p - int(p)) for p in at]


def levels(band: np.ndarray, low: float, high: float) -> np.ndarray:
    """A band as bytes from 0 to 255 between two values, truncated; 0 throughout if the second is not greater (RAS5)."""
    if not high > low:
        return np.zeros(band.shape, np.uint8)
    return np.nan_to_num(np.clip((band.astype(np.float64) - low) / (high - low) * 255, 0, 255)).astype(np.uint8)


def stretched(x: np.ndarray, low: float = 2, high: float = 98) -> np.ndarray:
    """Each band of (h, w, bands) between its own two percentiles as bytes; bytes stay as they are."""
    if x.dtype == np.uint8:
        return x
    return np.stack([levels(x[:, :, k], *percentiles(x[:, :, k].ravel(), (low, high))) for k in range(x.shape[2])], axis=2)


def inside(h: int, w: int, polygon: list[tuple[float, float]]) -> np.ndarray:
    """Pixels within a polygon, by crossings."""
    y, x = np.mgrid[:h, :w]
    odd = np.zeros((h, w), bool)
    for (x1, y1), (x2, y2) in zip(polygon, polygon[1:] + polygon[:1]):
        if y1 != y2:
            odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


def thinned(mask: np.ndarray, passes: int | None = None) -> np.ndarray:
    """One-pixel centre lines (Zhang and Suen, 1984); what at most so many passes leave, if given."""
    m = np.pad((mask > 0).astype(np.int8), 1)
    ring = ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))
    changed, left = True, -1 if passes is None else passes
    while changed and left:
        changed, left = False, left - 1
        for odd in (True, False):
            p = [np.roll(m, (-dy, -dx), (0, 1)) for dy, dx in ring]
            n = sum(p)
            turns = sum(((a == 0) & (b == 1)).astype(np.int8) for a, b in zip(p, p[1:] + p[:1]))
            north, east, south, west = p[0], p[2], p[4], p[6]
            free = (north * east * south == 0) & (east * south * west == 0) if odd else (north * east * west == 0) & (north * south * west == 0)
            drop = (m == 1) & (n >= 2) & (n <= 6) & (turns == 1) & free
            changed |= bool(drop.any())
            m = np.where(drop, 0, m).astype(np.int8)
    return m[1:-1, 1:-1]


def lines(skeleton: np.ndarray, stops: frozenset = frozenset()) -> list[list[tuple[int, int]]]:
    """The skeleton's pixel chains (x, y) between end points, junctions and stops, each traced once; closed loops too."""
    spots = {(int(x), int(y)) for y, x in zip(*np.nonzero(skeleton))}
    near = {p: [q for q in ((p[0] + a, p[1] + b) for b in (-1, 0, 1) for a in (-1, 0, 1) if a or b) if q in spots] for p in spots}
    ends = {p for p in spots if len(near[p]) != 2 or p in stops}
    walked: set[frozenset] = set()
    out = []
    for start in [*sorted(ends), *sorted(spots - ends)]:
        for q in sorted(near[start]):
            if frozenset((start, q)) in walked:
                continue
            chain = [start]
            p = start
            while True:
                walked.add(frozenset((p, q)))
                chain.append(q)
                onward = [r for r in near[q] if r != p and frozenset((q, r)) not in walked]
                if q in ends or not onward or q == start:
                    break
                p, q = q, onward[0]
            out.append(chain)
    return out


#: The eight neighbours in counter-clockwise order on the screen, from the right: (dy, dx).
RING = ((0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1), (1, 0), (1, 1))


def contours(mask: np.ndarray) -> list[tuple[bool, list[tuple[int, int]]]]:
    """All borders of a mask's 8-connected regions, outer ones and those of holes, in the order of their first pixels:
    (whether it is a hole's, points as (x, y)), by border following (Suzuki and Abe, 1985).

    A border is closed; points go counter-clockwise around a region and may repeat where it is one pixel wide.
    """
    grid = np.pad((mask > 0).astype(np.int64), 1)
    w = grid.shape[1]
    starts = np.flatnonzero((grid > 0) & ((np.roll(grid, 1, 1) == 0) | (np.roll(grid, -1, 1) == 0)))
    f, step = grid.ravel().tolist(), [dy * w + dx for dy, dx in RING]
    out, mark = [], 1
    for at in starts.tolist():
        # a mark below 0 says that the pixel's right side has been followed
        if f[at] == 1 and not f[at - 1]:
            hole, side = False, 4
        elif f[at] >= 1 and not f[at + 1]:
            hole, side = True, 0
        else:
            continue
        mark += 1
        # clockwise from the empty side to the last pixel of the border
        last = next((d % 8 for d in range(side - 1, side - 9, -1) if f[at + step[d % 8]]), None)
        if last is None:
            f[at] = -mark
            out.append((hole, [(at % w - 1, at // w - 1)]))
            continue
        end, now, d, points = at + step[last], at, last, []
        while True:
            points.append((now % w - 1, now // w - 1))
            right = False
            for k in range(1, 9):
                side = (d + k) % 8
                if f[now + step[side]]:
                    break
                right |= side == 0
            if right:
                f[now] = -mark
            elif f[now] == 1:
                f[now] = mark
            onward = now + step[side]
            if onward == at and now == end:
                break
            now, d = onward, (side + 4) % 8
        out.append((hole, points))
    return out
