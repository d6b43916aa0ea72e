"""Deep features: an extractor over tiles with halos, reduced by principal components, appended to a stack."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from .classify import apply_pca, fit_pca
from .neighbourhood import halo_tiles, tiles
from .pixels import PIXEL, append_bands
from .samples import SEED, sample_per_tile

#: Pixels per cell of an extractor's map, by the layer that it is cut at.
STRIDES = {"layer1": 4, "layer2": 8, "layer3": 16}

Extractor = Callable[[np.ndarray], np.ndarray]


def check_shape(stack: tuple[int, int], scenes: tuple[int, int]) -> None:
    """An error unless a stack and the scenes it was built from have one shape."""
    if tuple(stack) != tuple(scenes):
        raise ValueError(f"the stack is {stack[0]} x {stack[1]}, its scenes are {scenes[0]} x {scenes[1]}")


def block_means(stride: int) -> Extractor:
    """A fixed extractor: the mean of each channel over squares of ``stride`` pixels; edge squares may be smaller."""

    def run(image: np.ndarray) -> np.ndarray:
        rows, cols = (np.arange(0, n, stride) for n in image.shape[1:])
        sums = np.add.reduceat(np.add.reduceat(image, rows, axis=1), cols, axis=2)
        tall, wide = (np.diff([*at, n]) for at, n in zip((rows, cols), image.shape[1:], strict=True))
        return sums / (tall[:, None] * wide[None, :])

    return run


def stretch(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, half-pixel centres, clamped edges: (channels, h, w) to (channels, height, width)."""

    def along(x: np.ndarray, axis: int, target: int) -> np.ndarray:
        n = x.shape[axis]
        place = np.clip((np.arange(target) + 0.5) * n / target - 0.5, 0, n - 1)
        low = np.floor(place).astype(int)
        part = (place - low).reshape([-1 if k == axis else 1 for k in range(x.ndim)])
        return x.take(low, axis) * (1 - part) + x.take(np.minimum(low + 1, n - 1), axis) * part

    return along(along(image, 1, height), 2, width)


def tile_features(images: DataFrame, channels: list[str], extract: Extractor, outputs: int, height: int, width: int, tile: int = 512, halo: int = 32, scenes: list | None = None) -> DataFrame:
    """(row, col, f0, f1, ...) of every pixel: the extractor's map of each tile and its halo, stretched and cropped.

    ``images`` has rows (row, col, channels...), or with ``scenes`` a scene column as well; then the maps
    of all scenes follow one another.  Missing values are 0.  A task holds one tile at a time.
    """
    many = scenes if scenes is not None else [None]
    keyed = halo_tiles(images.select("row", "col", *(["scene"] if scenes is not None else []), *channels), tile, halo, height, width)
    names = [f"f{k}" for k in range(outputs * len(many))]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf.tile_row.iloc[0]) * tile, int(pdf.tile_col.iloc[0]) * tile
        r1, c1 = min(height, r0 + tile), min(width, c0 + tile)
        top, left, bottom, right = max(0, r0 - halo), max(0, c0 - halo), min(height, r1 + halo), min(width, c1 + halo)
        maps = []
        for scene in many:
            own = pdf if scene is None else pdf[pdf.scene == scene]
            image = np.zeros((len(channels), bottom - top, right - left))
            image[:, own.row - top, own.col - left] = np.nan_to_num(own[channels].to_numpy(float)).T
            dense = stretch(np.asarray(extract(image), float), bottom - top, right - left)
            maps.append(dense[:, r0 - top : r1 - top, c0 - left : c1 - left])
        flat = np.concatenate(maps).reshape(len(names), -1)
        rows, cols = np.divmod(np.arange(flat.shape[1]), c1 - c0)
        return pd.DataFrame({"row": (rows + r0).astype("int32"), "col": (cols + c0).astype("int32"), **dict(zip(names, flat, strict=True))})

    schema = "row int, col int" + "".join(f", {n} double" for n in names)
    return keyed.groupBy("tile_row", "tile_col").applyInPandas(run, schema)


def fit_components(features: DataFrame, height: int, width: int, tile: int = 512, components: int = 16, sample: int = 50_000, seed: int = SEED) -> PipelineModel:
    """Principal components of about ``sample`` pixels, as many from each tile."""
    columns = [c for c in features.columns if c not in PIXEL]
    count = -(-height // tile) * -(-width // tile)
    picked = sample_per_tile(tiles(features, tile), sample, count, seed=seed)
    return fit_pca(picked, columns, components)


def add_deep_features(stack: DataFrame, features: DataFrame, model: PipelineModel) -> DataFrame:
    """The stack with ``deep_pca_00`` and so on behind its bands; bands of these names are replaced."""
    columns = [c for c in features.columns if c not in PIXEL]
    return append_bands(stack, apply_pca(model, features).drop(*columns))
