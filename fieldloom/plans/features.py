"""The feature stack: spectral, index, texture and season features of every pixel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.bands import is_bad, masked, ndvi, reflectance
from ..operators.neighbourhood import with_local_std
from ..operators.pixels import PIXEL, densify


def feature_names(scenes: list, bands: list[str], size: int = 5, spectral: bool = True, spatial: bool = True, temporal: bool = True) -> list[str]:
    """The columns of a feature stack, in their fixed order."""
    out = []
    for s in scenes:
        out += [f"{b}_{s}" for b in bands] if spectral else []
        out += [f"ndvi_{s}"] + ([f"ndvi_std{size}_{s}"] if spatial else [])
    return out + (["ndvi_mean", "ndvi_min", "ndvi_max", "ndvi_amplitude"] + (["ndvi_slope"] if len(scenes) > 1 else []) if temporal else [])


def filled_cells(obs: DataFrame, height: int, width: int, scenes: list, bands: dict[str, str], red: str, nir: str, scl: str | None = "scl") -> DataFrame:
    """Dense cells with masked, gap-filled reflectances and index.

    ``bands`` maps feature names to columns; red and nir are read for the index even if not among them.
    A band without a column is missing in all scenes; without red or nir this is an error.
    """
    for c in (red, nir):
        if c not in obs.columns:
            raise ValueError(f"no band {c}")
    obs = obs.withColumns({c: F.lit(None).cast("double") for c in bands.values() if c not in obs.columns})
    cells = densify(obs, height, width, scenes)
    bad = is_bad(F.col(scl)) if scl else F.lit(False)
    values = {name: masked(reflectance(F.col(c)), bad) for name, c in bands.items()}
    values["ndvi"] = masked(ndvi(reflectance(F.col(red)), reflectance(F.col(nir))), bad)
    cells = cells.select(*PIXEL, "scene", *[v.alias(k) for k, v in values.items()])
    whole = W.partitionBy(*PIXEL)
    return cells.select(*PIXEL, "scene", *[F.coalesce(F.col(k), F.median(k).over(whole), F.lit(0.0)).alias(k) for k in values])


def feature_stack(obs: DataFrame, height: int, width: int, scenes: list, bands: dict[str, str], red: str, nir: str, scl: str | None = "scl", size: int = 5, spectral: bool = True, spatial: bool = True, temporal: bool = True) -> DataFrame:
    """One row per pixel with the columns of :func:`feature_names`.

    Gap-filling shuffles on (row, col); texture slides along rows and columns, and nothing is computed twice.
    """
    cells = filled_cells(obs, height, width, scenes, bands if spectral else {}, red, nir, scl)
    if spatial:
        cells = with_local_std(cells, "ndvi", size, height, width)
    at = lambda column, s: F.max(F.when(F.col("scene") == F.lit(s), F.col(column)))
    parts = []
    for s in scenes:
        parts += [at(b, s).alias(f"{b}_{s}") for b in bands] if spectral else []
        parts.append(at("ndvi", s).alias(f"ndvi_{s}"))
        parts += [at(f"ndvi_std{size}", s).alias(f"ndvi_std{size}_{s}")] if spatial else []
    if temporal:
        index = F.array_position(F.array(*[F.lit(s) for s in scenes]), F.col("scene")).cast("double") - 1
        parts += [F.avg("ndvi").alias("ndvi_mean"), F.min("ndvi").alias("ndvi_min"), F.max("ndvi").alias("ndvi_max"), (F.max("ndvi") - F.min("ndvi")).alias("ndvi_amplitude")]
        parts += [F.regr_slope(F.col("ndvi"), index).alias("ndvi_slope")] if len(scenes) > 1 else []
    return cells.groupBy(*PIXEL).agg(*parts).select(*PIXEL, *feature_names(scenes, list(bands), size, spectral, spatial, temporal))
