"""Neighbourhoods: local deviation, tiles and halos."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _reach(size: int) -> tuple[int, int]:
    """Offsets of a box; even sizes reach one further down."""
    return -(size // 2), size - size // 2 - 1


def with_local_std(cells: DataFrame, value: str, size: int, height: int, width: int, by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """Append sqrt(max(0, E[x^2] - E[x]^2)) over a size x size box, edges mirrored.

    Two sliding sums, along rows and then along columns, over cells that only the edges' mirror images
    add to: two shuffles, no join, and all other columns pass through.
    """
    low, high = _reach(size)
    v, xx, at, name = "__v", "__xx", "__at", f"{value}_std{size}"

    def slide(df: DataFrame, axis: str, extent: int) -> DataFrame:
        other = "col" if axis == "row" else "row"
        turns = range(-1 - size // (2 * extent), 2 + size // (2 * extent))
        images = [x for t in turns for x in (F.col(axis) + 2 * extent * t, -1 - F.col(axis) + 2 * extent * t)]
        spots = F.filter(F.array(*images), lambda p: (p >= low) & (p < extent + high))
        frame = W.partitionBy(*by, other).orderBy(at).rangeBetween(low, high)
        moved = df.withColumn(at, F.explode(spots)).withColumns({v: F.sum(v).over(frame), xx: F.sum(xx).over(frame)})
        return moved.where(F.col(at) == F.col(axis)).drop(at)

    x = F.col(value).cast("double")
    both = slide(slide(cells.withColumns({v: x, xx: x * x}), "col", width), "row", height)
    n = float(size * size)
    mean = F.col(v) / n
    return both.withColumn(name, F.sqrt(F.greatest(F.col(xx) / n - mean * mean, F.lit(0.0)))).drop(v, xx)


def local_std(cells: DataFrame, value: str, size: int, height: int, width: int, by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """(by, row, col, <value>_std<size>) of :func:`with_local_std`."""
    out = with_local_std(cells.select(*by, "row", "col", value), value, size, height, width, by)
    return out.select(*by, "row", "col", f"{value}_std{size}")


def local_std_tiled(cells: DataFrame, value: str, size: int, height: int, width: int, tile: int = 512, by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """The same on tiles with halos, as numpy box sums: one shuffle, for large boxes and dense rasters.

    A task holds (tile + size)^2 cells of one image at a time.
    """
    low, high = _reach(size)
    halo = max(-low, high)
    keyed = halo_tiles(cells.select(*by, "row", "col", F.col(value).cast("double").alias("__v")), tile, halo, height, width)
    types = dict(cells.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in by) + f", row int, col int, `{value}_std{size}` double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf.tile_row.iloc[0]) * tile, int(pdf.tile_col.iloc[0]) * tile
        r1, c1 = min(height, r0 + tile), min(width, c0 + tile)
        top, left = max(0, r0 - halo), max(0, c0 - halo)
        image = np.zeros((min(height, r1 + halo) - top, min(width, c1 + halo) - left))
        image[pdf.row - top, pdf.col - left] = pdf["__v"]
        pick = lambda a, b, off, extent, base: np.array([_mirror(i + o, extent) - base for i in range(a, b) for o in range(off[0], off[1] + 1)])
        ri, ci = pick(r0, r1, (low, high), height, top), pick(c0, c1, (low, high), width, left)

        def box(x: np.ndarray) -> np.ndarray:
            return x[ri].reshape(r1 - r0, size, -1).sum(1)[:, ci].reshape(r1 - r0, c1 - c0, size).sum(2) / size**2

        std = np.sqrt(np.maximum(box(image * image) - box(image) ** 2, 0))
        own = pdf[(pdf.row >= r0) & (pdf.row < r1) & (pdf.col >= c0) & (pdf.col < c1)]
        out = own[[*by, "row", "col"]].copy()
        out[f"{value}_std{size}"] = std[own.row - r0, own.col - c0]
        return out

    return keyed.groupBy(*by, "tile_row", "tile_col").applyInPandas(run, schema)


def _mirror(i: int, n: int) -> int:
    i %= 2 * n
    return i if i < n else 2 * n - 1 - i


def tiles(cells: DataFrame, size: int) -> DataFrame:
    """Append ``tile_row`` and ``tile_col``, row-major tiles clipped at the edges."""
    return cells.withColumns({"tile_row": F.floor(F.col("row") / size).cast("int"), "tile_col": F.floor(F.col("col") / size).cast("int")})


def tile_windows(height: int, width: int, size: int, halo: int) -> Iterator[dict[str, int]]:
    """Core and read windows of all tiles, and the core's offset inside the read window."""
    for row in range(0, height, size):
        for col in range(0, width, size):
            h, w = min(size, height - row), min(size, width - col)
            top, left = max(0, row - halo), max(0, col - halo)
            yield {"row": row, "col": col, "height": h, "width": w, "read_row": top, "read_col": left, "read_height": min(height, row + h + halo) - top, "read_width": min(width, col + w + halo) - left, "off_row": row - top, "off_col": col - left}


def halo_tiles(cells: DataFrame, size: int, halo: int, height: int, width: int) -> DataFrame:
    """Copy every cell to each tile whose core or halo holds it: (tile_row, tile_col, in_core, ...)."""
    def span(place: str, extent: int) -> Column:
        last = (extent - 1) // size
        low = F.greatest(F.floor((F.col(place) - halo) / size), F.lit(0))
        high = F.least(F.floor((F.col(place) + halo) / size), F.lit(last))
        return F.explode(F.sequence(low.cast("int"), high.cast("int")))

    out = cells.withColumn("tile_row", span("row", height)).withColumn("tile_col", span("col", width))
    core = (F.floor(F.col("row") / size) == F.col("tile_row")) & (F.floor(F.col("col") / size) == F.col("tile_col"))
    return out.withColumn("in_core", core)
