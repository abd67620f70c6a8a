"""Pluggable predictors over tiles (ML1, ML7-8, RAS26). Networks themselves are not part of the library."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .augment import normalised

#: A builder makes, once in each Python worker, a function from (n, h, w, 3) normalised images to (n, h, w) logits.
_BUILDERS: dict[str, Callable[..., Callable[[np.ndarray], np.ndarray]]] = {}


def predictor(name: str):
    def put(build):
        _BUILDERS[name.strip().lower()] = build
        return build

    return put


def builder(name: str) -> Callable:
    try:
        return _BUILDERS[name.strip().lower()]
    except KeyError:
        raise KeyError(f"no predictor {name!r}; there are {', '.join(sorted(_BUILDERS))}") from None


@predictor("brightness")
def _brightness(weight: float = 1.0):
    """Grey and bright pixels are road: a baseline to hold networks against."""
    return lambda x: weight * (x.mean(axis=3) - 2 * x.std(axis=3))


def predict(tiles: DataFrame, name: str, batch: int = 8, threshold: float = 0.5, **settings) -> DataFrame:
    """tile_id, height, width, logits array<float>, predicted (bytes, 0 or 255) of tiles (tile_id, height, width, rgb).

    A batch holds tiles of one size.
    """
    build = builder(name)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = build(**settings)
        for f in frames:
            for (h, w), same in f.groupby(["height", "width"], sort=False):
                for k in range(0, len(same), batch):
                    part = same.iloc[k : k + batch]
                    x = np.stack([np.frombuffer(b, np.uint8).reshape(h, w, 3) for b in part["rgb"]])
                    logits = np.asarray(model(normalised(x)), np.float32)
                    on = 1 / (1 + np.exp(-logits.astype(float))) > threshold
                    yield pd.DataFrame({"tile_id": part["tile_id"].to_numpy(), "height": h, "width": w, "logits": [v.ravel() for v in logits], "predicted": [(v * np.uint8(255)).tobytes() for v in on]})

    return tiles.select("tile_id", "height", "width", "rgb").mapInPandas(run, "tile_id string, height int, width int, logits array<float>, predicted binary")


def overlay(tiles: DataFrame, mask: str = "predicted", colour: tuple[int, int, int] = (255, 80, 0), alpha: float = 0.5) -> DataFrame:
    """Adds overlay: rgb with a colour blended in where a mask is over 127."""

    @F.pandas_udf("binary")
    def blend(rgb: pd.Series, on: pd.Series) -> pd.Series:
        out = []
        for a, m in zip(rgb, on):
            x = np.frombuffer(a, np.uint8).reshape(-1, 3).astype(float)
            road = np.frombuffer(m, np.uint8) > 127
            x[road] += (np.array(colour) - x[road]) * alpha
            out.append(x.round().astype(np.uint8).tobytes())
        return pd.Series(out)

    return tiles.withColumn("overlay", blend("rgb", mask))
