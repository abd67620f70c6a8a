"""Tiles as a training run sees them: occluded, augmented, with masks of 0 and 255 (SRC24, RAS20)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import augment, occlusion, splits


def training_rows(tiles: DataFrame, epoch: int = 0, probability: float = 0.5, config: dict | None = None, seed: int = 42) -> DataFrame:
    """tile_id, height, width, rgb, mask of tiles (those columns) as drawn for an epoch, in their own rows.

    A tile is occluded with the probability given, image alone; then image and mask are augmented alike, and the mask is
    cut at its middle. All draws come from hashes of seed, epoch and tile. A tile without a mask is left out.
    """
    drawn = seed + 7919 * epoch
    chosen = splits.occlusion_gate(tiles.filter("mask is not null"), occlusion.TYPES, occlusion.SEVERITIES, probability, seed=drawn)
    return augment.augment(occlusion.applied(chosen, drawn), config, seed, epoch)
