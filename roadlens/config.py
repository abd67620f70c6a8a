"""The configuration of a dataset: a YAML file's values over the defaults (SRC15, D13)."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path

from .errors import ConfigError


@dataclass(frozen=True)
class Config:
    tile_size: int = 512
    stride: int = 256
    min_road_pixel_pct: float = 0.01
    min_image_std: float = 5.0
    max_tiles_per_image: int = 6
    active_splits: tuple[str, ...] = ("train",)
    occlusion_samples: int = 20
    train_ratio: float = 0.7
    val_ratio: float = 0.15
    test_ratio: float = 0.15
    seed: int = 42
    #: The longest side that images may have; longer ones are scaled down. None: as they are.
    max_dimension: int | None = None


def load(path: str | Path) -> Config:
    """Reads keys of the defaults' names from any depth of a YAML mapping; other keys are not looked at."""
    import yaml

    try:
        tree = yaml.safe_load(Path(path).read_text())
    except OSError as e:
        raise ConfigError(f"{path} cannot be read") from e
    except yaml.YAMLError as e:
        raise ConfigError(f"{path} is no YAML") from e
    if not isinstance(tree, dict):
        raise ConfigError(f"{path} holds no mapping")
    known, found = {f.name for f in fields(Config)}, {}

    def visit(node: dict) -> None:
        for k, v in node.items():
            if isinstance(v, dict):
                visit(v)
            elif k in known:
                found[k] = tuple(v) if isinstance(v, list) else v

    visit(tree)
    return Config(**found)
