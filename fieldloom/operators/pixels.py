"""Pixels in time: rows (row, col, scene, ...), one per pixel and acquisition.

All temporal operators share the key (row, col), so a plan that chains them shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.bands import is_bad, masked, ndvi, reflectance

PIXEL = ("row", "col")


def densify(obs: DataFrame, height: int, width: int, scenes: list | None = None) -> DataFrame:
    """Every cell of the grid in every scene; cells without an observation are NULL.

    The scenes come from ``obs`` unless given; they are few, one per acquisition.
    """
    if scenes is None:
        scenes = [r[0] for r in scenes_of(obs).collect()]
    kind = obs.schema["scene"].dataType
    spark = obs.sparkSession
    cells = spark.range(height * width).select((F.col("id") / width).cast("int").alias("row"), (F.col("id") % width).cast("int").alias("col"))
    grid = cells.withColumn("scene", F.explode(F.array(*[F.lit(s).cast(kind) for s in scenes]))) if scenes else cells.withColumn("scene", F.lit(None).cast(kind)).where("false")
    return grid.join(obs, [*PIXEL, "scene"], "left")


def with_ndvi(obs: DataFrame, red: str = "red_dn", nir: str = "nir_dn", scl: str | None = "scl") -> DataFrame:
    """Append ``ndvi``, NULL on bad pixels; without a class column nothing is masked."""
    value = ndvi(reflectance(F.col(red)), reflectance(F.col(nir)))
    return obs.withColumn("ndvi", masked(value, is_bad(F.col(scl))) if scl else value)


def mask_bands(obs: DataFrame, bands: list[str], scl: str = "scl", mask_first: bool = True) -> DataFrame:
    """Reflectances of ``bands``, NULL on bad pixels (``mask_first=False`` leaves them)."""
    bad = is_bad(F.col(scl))
    return obs.withColumns({b: masked(reflectance(F.col(b)), bad) if mask_first else reflectance(F.col(b)) for b in bands})


def fill_gaps(cells: DataFrame, *values: str) -> DataFrame:
    """NULL becomes the pixel's own temporal median; 0 where the pixel has no value at all."""
    whole = W.partitionBy(*PIXEL)
    return cells.withColumns({v: F.coalesce(F.col(v), F.median(v).over(whole), F.lit(0.0)) for v in values})


def time_index(cells: DataFrame) -> DataFrame:
    """Append ``t``: 0 for a pixel's first scene, then 1, 2, ..."""
    return cells.withColumn("t", F.row_number().over(W.partitionBy(*PIXEL).orderBy("scene")) - 1)


def temporal_summary(cells: DataFrame, value: str = "ndvi") -> DataFrame:
    """(row, col, mean, min, max, amplitude, slope); the slope is by date index and needs two scenes."""
    return time_index(cells).groupBy(*PIXEL).agg(
        F.avg(value).alias(f"{value}_mean"),
        F.min(value).alias(f"{value}_min"),
        F.max(value).alias(f"{value}_max"),
        (F.max(value) - F.min(value)).alias(f"{value}_amplitude"),
        F.regr_slope(F.col(value), F.col("t").cast("double")).alias(f"{value}_slope"),
    )


# Quadratic weights over five points, by place in the series, in 35ths.
SAVGOL = {0: (31, 9, -3, -5, 3), 1: (9, 13, 12, 6, -5), 2: (-3, 12, 17, 12, -3), 3: (-5, 6, 12, 13, 9), 4: (3, -5, -3, 9, 31)}


def smooth(cells: DataFrame, value: str = "ndvi") -> DataFrame:
    """Savitzky-Golay smoothing along time: window 5, order 2, ends from the end polynomials.

    Series of up to four scenes stay as they are (with four, the window is 3 and the fit exact).
    """
    series = cells.groupBy(*PIXEL).agg(F.sort_array(F.collect_list(F.struct("scene", F.col(value).alias("v")))).alias("s"))
    n = F.size("s")

    def weigh(place: int, first: Column) -> Column:
        total = F.lit(0.0)
        for k, w in enumerate(SAVGOL[place]):
            total = total + F.lit(float(w)) * F.try_element_at(F.col("s.v"), (first + (k + 1)).cast("int"))
        return total / 35.0

    def at(item: Column, i: Column) -> Column:
        v = (
            F.when(n < 5, item["v"])
            .when(i == 0, weigh(0, F.lit(0)))
            .when(i == 1, weigh(1, F.lit(0)))
            .when(i == n - 1, weigh(4, n - 5))
            .when(i == n - 2, weigh(3, n - 5))
            .otherwise(weigh(2, i - 2))
        )
        return F.struct(item["scene"].alias("scene"), v.alias(value))

    return series.select(*PIXEL, F.explode(F.transform("s", at)).alias("x")).select(*PIXEL, "x.scene", f"x.{value}")


def zscore(cells: DataFrame, value: str, by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """(x - mean) / (population deviation + 1e-6) within each image; partial sums, then a join of a row per image."""
    stats = cells.groupBy(*by).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return cells.join(F.broadcast(stats), list(by)).withColumn(value, (F.col(value) - F.col("__m")) / (F.col("__s") + 1e-6)).drop("__m", "__s")


def append_bands(stack: DataFrame, more: DataFrame) -> DataFrame:
    """The stack with the bands of ``more`` behind its own; bands of the same name are replaced."""
    new = [c for c in more.columns if c not in PIXEL]
    return stack.drop(*new).join(more, list(PIXEL))


def temporal_median(cells: DataFrame, *values: str) -> DataFrame:
    """Median of a pixel's present values; NULL where there is none."""
    return cells.groupBy(*PIXEL).agg(*[F.median(v).alias(v) for v in values])


def missing_flags(cells: DataFrame, value: str) -> DataFrame:
    """(row, col, any_missing, all_missing, valid) over a pixel's scenes."""
    none = F.col(value).isNull()
    return cells.groupBy(*PIXEL).agg(F.bool_or(none).alias("any_missing"), F.bool_and(none).alias("all_missing"), F.count(value).alias("valid"))


def scenes_of(obs: DataFrame) -> DataFrame:
    """The distinct scenes in order."""
    return obs.select("scene").distinct().orderBy("scene")


def scene_list(obs: DataFrame) -> list:
    """The scenes, a row per acquisition; an error if there are none."""
    out = [r[0] for r in scenes_of(obs).collect()]
    if not out:
        raise ValueError("no scenes")
    return out


def composite(cells: DataFrame, *values: str) -> DataFrame:
    """Temporal median of each channel; 0 where there is none."""
    return cells.groupBy(*PIXEL).agg(*[F.coalesce(F.median(v), F.lit(0.0)).alias(v) for v in values])


def wide_by_scene(cells: DataFrame, values: list[str], scenes: list) -> DataFrame:
    """One row per pixel with columns ``<value>_<scene>``, in one aggregation (no joins)."""
    parts = [F.max(F.when(F.col("scene") == F.lit(s), F.col(v))).alias(f"{v}_{s}") for s in scenes for v in values]
    return cells.groupBy(*PIXEL).agg(*parts)
