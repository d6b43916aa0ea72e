"""From grid to grid: nearest cells, and bilinear reprojection that skips missing neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import nearest_cell
from ..functions.geo import Grid, transform


def attach_nearest(cells: DataFrame, coarse: DataFrame, value: str, size: tuple[int, int], coarse_size: tuple[int, int], by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """Give every cell the value of the nearest cell of a coarser grid over the same extent (a left join)."""
    keyed = cells.withColumns({"__r": nearest_cell(F.col("row"), coarse_size[0], size[0]), "__c": nearest_cell(F.col("col"), coarse_size[1], size[1])})
    right = coarse.select(*by, F.col("row").alias("__r"), F.col("col").alias("__c"), value)
    return keyed.join(right, [*by, "__r", "__c"], "left").drop("__r", "__c")


def resample_nearest(cells: DataFrame, size: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """All columns of the nearest source cell for every cell of a target grid.

    Target cells come from a range of ids, so neither side is collected.
    """
    h, w = target
    grid = cells.sparkSession.range(h * w).select((F.col("id") / w).cast("int").alias("row"), (F.col("id") % w).cast("int").alias("col"))
    grid = grid.withColumns({"__r": nearest_cell(F.col("row"), size[0], h), "__c": nearest_cell(F.col("col"), size[1], w)})
    rest = [c for c in cells.columns if c not in ("row", "col")]
    return grid.join(cells.select(F.col("row").alias("__r"), F.col("col").alias("__c"), *rest), ["__r", "__c"], "left").select("row", "col", *rest)


def bilinear_at(points: DataFrame, cells: DataFrame, value: str, keys: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Value of fractional places (__y, __x) of ``points``, from up to four neighbours.

    Missing neighbours drop out and the weights of the others are scaled up; without any the value
    is NULL.  ``keys`` identify a point.  With ``by``, each group of cells gives its own value, and a
    point that no cell of a group is near has no row for it.
    """
    y, x = F.floor("__y"), F.floor("__x")
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("__n")
    four = points.select(*keys, "__y", "__x", near).select(
        *keys,
        (y + F.col("__n.i")).cast("int").alias("__r"),
        (x + F.col("__n.j")).cast("int").alias("__c"),
        (_share(F.col("__y") - y, F.col("__n.i")) * _share(F.col("__x") - x, F.col("__n.j"))).alias("__w"),
    )
    source = cells.select(*by, F.col("row").alias("__r"), F.col("col").alias("__c"), F.col(value).alias("__v"))
    joined = four.where("__w > 0").join(source, ["__r", "__c"], "inner" if by else "left")
    weight = F.when(F.col("__v").isNotNull(), F.col("__w"))
    return joined.groupBy(*by, *keys).agg((F.sum(F.col("__w") * F.col("__v")) / F.sum(weight)).alias(value))


def _share(part: Column, upper: Column) -> Column:
    return F.when(upper == 1, part).otherwise(1 - part)


def reproject(cells: DataFrame, value: str, source: Grid, target: Grid, by: tuple[str, ...] = ()) -> DataFrame:
    """Bilinear values on the target grid, also in another CRS; the same grid is returned as is."""
    if source.same_as(target):
        return cells.select(*by, "row", "col", value)
    grid = cells.sparkSession.range(target.height * target.width).select((F.col("id") / target.width).cast("int").alias("row"), (F.col("id") % target.width).cast("int").alias("col"))
    gx, gy = target.to_ground(F.col("row"), F.col("col"))
    py, px = source.to_pixel(*transform(gx, gy, target.epsg, source.epsg))
    return bilinear_at(grid.withColumns({"__y": py, "__x": px}), cells, value, ["row", "col"], by)


def upsample(cells: DataFrame, value: str, size: tuple[int, int], target: tuple[int, int]) -> DataFrame:
    """Bilinear upsampling with half-pixel centres and clamped edges."""
    h, w = target
    grid = cells.sparkSession.range(h * w).select((F.col("id") / w).cast("int").alias("row"), (F.col("id") % w).cast("int").alias("col"))
    place = lambda c, n, t: F.least(F.greatest((F.col(c) + 0.5) * n / t - 0.5, F.lit(0.0)), F.lit(float(n - 1)))
    return bilinear_at(grid.withColumns({"__y": place("row", size[0], h), "__x": place("col", size[1], w)}), cells, value, ["row", "col"])
