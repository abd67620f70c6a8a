"""Augmentation of tiles while training (RAS20-21, SRC24, FN9, SNK11): images and masks in Arrow batches, drawn from hashes.

Geometric steps move image and mask alike; photometric ones change the image only. Only the steps that a configuration
names run, in the order of STEPS.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .kernels import blurred
from .occlusion import generator

STEPS = ("horizontal_flip", "vertical_flip", "random_rotate_90", "shift_scale_rotate", "brightness_contrast", "gauss_noise", "gaussian_blur", "clahe")
#: Probabilities and strengths.
DEFAULTS = {
    "horizontal_flip": {"p": 0.5}, "vertical_flip": {"p": 0.5}, "random_rotate_90": {"p": 0.5}, "shift_scale_rotate": {"p": 0.5, "shift": 0.0625, "scale": 0.2, "rotate": 45},
    "brightness_contrast": {"p": 0.5, "brightness": 0.3, "contrast": 0.3}, "gauss_noise": {"p": 0.3, "variance": (10, 50)}, "gaussian_blur": {"p": 0.3, "limit": 3}, "clahe": {"p": 0.3, "clip": 4.0, "grid": 8},
}
#: Means and deviations of colour channels in the customary normalisation.
MEAN, STD = np.array([0.485, 0.456, 0.406]), np.array([0.229, 0.224, 0.225])


def normalised(rgb: np.ndarray) -> np.ndarray:
    return (rgb / 255.0 - MEAN) / STD


def denormalised(x: np.ndarray) -> np.ndarray:
    return np.clip((x * STD + MEAN) * 255.0, 0, 255).round().astype(np.uint8)


def warped(x: np.ndarray, angle: float, scale: float, dy: float, dx: float, smooth: bool) -> np.ndarray:
    """Turned and scaled about the centre, then shifted by parts of the size; the border is reflected."""
    h, w = x.shape[:2]
    y, c = np.mgrid[:h, :w].astype(float)
    y, c = y - (h - 1) / 2 - dy * h, c - (w - 1) / 2 - dx * w
    a = np.radians(angle)
    sy, sx = (np.cos(a) * y + np.sin(a) * c) / scale + (h - 1) / 2, (np.cos(a) * c - np.sin(a) * y) / scale + (w - 1) / 2
    fold = lambda i, n: (n - 1) - np.abs(np.mod(i, 2 * (n - 1)) - (n - 1)) if n > 1 else np.zeros_like(i)
    if not smooth:
        return x[fold(np.rint(sy).astype(int), h), fold(np.rint(sx).astype(int), w)]
    y0, x0 = np.floor(sy).astype(int), np.floor(sx).astype(int)
    fy, fx = (sy - y0)[..., None], (sx - x0)[..., None]
    at = lambda a, b: x[fold(y0 + a, h), fold(x0 + b, w)].astype(float)
    return (at(0, 0) * (1 - fy) * (1 - fx) + at(0, 1) * (1 - fy) * fx + at(1, 0) * fy * (1 - fx) + at(1, 1) * fy * fx).round().clip(0, 255).astype(np.uint8)


def equalised(rgb: np.ndarray, clip: float, grid: int) -> np.ndarray:
    """Contrast-limited adaptive equalisation of the brightness (Zuiderveld, 1994)."""
    h, w = rgb.shape[:2]
    light = rgb.max(2)
    ys, xs = (np.linspace(0, n, min(grid, n) + 1).astype(int) for n in (h, w))
    maps = np.zeros((len(ys) - 1, len(xs) - 1, 256))
    for i, j in np.ndindex(maps.shape[:2]):
        n = np.bincount(light[ys[i] : ys[i + 1], xs[j] : xs[j + 1]].ravel(), minlength=256).astype(float)
        limit = max(1.0, clip * n.sum() / 256)
        n = np.minimum(n, limit) + np.maximum(n - limit, 0).sum() / 256
        maps[i, j] = 255 * np.cumsum(n) / n.sum()
    place = lambda size, edges: np.interp(np.arange(size), (edges[:-1] + edges[1:] - 1) / 2, np.arange(len(edges) - 1))
    py, px = place(h, ys)[:, None], place(w, xs)[None, :]
    i, j = np.floor(py).astype(int), np.floor(px).astype(int)
    i2, j2, fy, fx = np.minimum(i + 1, len(ys) - 2), np.minimum(j + 1, len(xs) - 2), py - i, px - j
    new = maps[i, j, light] * (1 - fy) * (1 - fx) + maps[i2, j, light] * fy * (1 - fx) + maps[i, j2, light] * (1 - fy) * fx + maps[i2, j2, light] * fy * fx
    return (rgb * (new / np.maximum(light, 1))[..., None]).clip(0, 255).astype(np.uint8)


def augmented(rgb: np.ndarray, mask: np.ndarray, config: dict, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    for step in (s for s in STEPS if s in config):
        c = DEFAULTS[step] | config[step]
        if rng.random() >= c["p"]:
            continue
        if step == "horizontal_flip":
            rgb, mask = rgb[:, ::-1], mask[:, ::-1]
        elif step == "vertical_flip":
            rgb, mask = rgb[::-1], mask[::-1]
        elif step == "random_rotate_90":
            k = int(rng.integers(0, 4)) if rgb.shape[0] == rgb.shape[1] else 2 * int(rng.integers(0, 2))
            rgb, mask = np.rot90(rgb, k), np.rot90(mask, k)
        elif step == "shift_scale_rotate":
            how = (rng.uniform(-c["rotate"], c["rotate"]), 1 + rng.uniform(-c["scale"], c["scale"]), *rng.uniform(-c["shift"], c["shift"], 2))
            rgb, mask = warped(rgb, *how, True), warped(mask, *how, False)
        elif step == "brightness_contrast":
            gain, lift = 1 + rng.uniform(-c["contrast"], c["contrast"]), 255 * rng.uniform(-c["brightness"], c["brightness"])
            rgb = (rgb * gain + lift).clip(0, 255).astype(np.uint8)
        elif step == "gauss_noise":
            rgb = (rgb + rng.normal(0, np.sqrt(rng.uniform(*c["variance"])), rgb.shape)).clip(0, 255).astype(np.uint8)
        elif step == "gaussian_blur":
            sigma = 0.3 * ((c["limit"] - 1) * 0.5 - 1) + 0.8
            rgb = np.stack([blurred(rgb[..., k].astype(float), sigma) for k in range(3)], 2).round().clip(0, 255).astype(np.uint8)
        else:
            rgb = equalised(rgb, c["clip"], c["grid"])
    return rgb, mask


def augment(tiles: DataFrame, config: dict | None = None, seed: int = 42, epoch: int = 0) -> DataFrame:
    """tiles (tile_id, height, width, rgb, mask) with image and mask drawn anew for an epoch; other columns go."""
    chosen = DEFAULTS if config is None else config
    if unknown := set(chosen) - set(STEPS):
        raise ValueError(f"no such steps: {sorted(unknown)}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for r in f.itertuples():
                rgb, mask = augmented(np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3), np.frombuffer(r.mask, np.uint8).reshape(r.height, r.width), chosen, generator(seed, epoch, r.tile_id))
                rows.append((r.tile_id, *mask.shape, np.ascontiguousarray(rgb).tobytes(), np.where(mask > 127, 255, 0).astype(np.uint8).tobytes()))
            yield pd.DataFrame(rows, columns=["tile_id", "height", "width", "rgb", "mask"])

    return tiles.select("tile_id", "height", "width", "rgb", "mask").mapInPandas(run, "tile_id string, height int, width int, rgb binary, mask binary")


def as_json(config: dict | None = None) -> str:
    chosen = DEFAULTS if config is None else config
    return json.dumps([{"step": s, **DEFAULTS[s], **chosen[s]} for s in STEPS if s in chosen])
