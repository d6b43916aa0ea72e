"""Catalogue items: search, the least cloudy item, the scene to keep for a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def parse_interval(text: Column) -> tuple[Column, Column]:
    """``start/end`` as two dates; both ends count."""
    parts = F.split(text, "/")
    return F.to_date(F.get(parts, F.lit(0))), F.to_date(F.get(parts, F.lit(1)))


def overlaps(box: Column, west: float, south: float, east: float, north: float) -> Column:
    """Whether a (w, s, e, n) struct touches the box."""
    return (box["w"] <= east) & (box["e"] >= west) & (box["s"] <= north) & (box["n"] >= south)


def resolve_bbox(explicit: Column, aoi: Column) -> Column:
    """The explicit box, else the extent of the area of interest, else an error."""
    return F.coalesce(explicit, aoi, F.raise_error(F.lit("neither a box nor an area of interest is given")).cast(aoi_type()))


def aoi_type() -> str:
    return "struct<w: double, s: double, e: double, n: double>"


def search(items: DataFrame, start: str, end: str, max_cloud: float = 20.0, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Items (id, datetime, cloud[, box]) in the interval with cloud below the limit; pushed to the scan."""
    out = items.where((F.col("datetime") >= F.to_timestamp(F.lit(start))) & (F.col("datetime") < F.to_timestamp(F.lit(end)) + F.expr("interval 1 day")) & (F.col("cloud") < max_cloud))
    return out.where(overlaps(F.col("box"), *bbox)) if bbox else out


def in_windows(items: DataFrame, windows: DataFrame, max_cloud: float | None = None) -> DataFrame:
    """Items of each window (window_id, start, end), dates inclusive; windows without items vanish.

    A window becomes the days that it holds, so containment is an equi-join on the day.
    """
    days = windows.withColumn("__day", F.explode(F.sequence("start", "end")))
    own = items if max_cloud is None else items.where(F.col("cloud") < max_cloud)
    return own.withColumn("__day", F.to_date("datetime")).join(days, "__day").drop("__day")


def least_cloudy(items: DataFrame, windows: DataFrame, max_cloud: float = 20.0) -> DataFrame:
    """One item per window: the least cloud (missing counts as 100), then the earliest, then the least id."""
    rank = [F.coalesce("cloud", F.lit(100.0)), F.col("datetime"), F.col("id")]
    best = in_windows(items, windows, max_cloud).groupBy("window_id").agg(F.min_by(F.struct("id", "datetime", "cloud"), F.struct(*rank)).alias("b"))
    return best.select("window_id", "b.id", F.date_format("b.datetime", "yyyy-MM-dd").alias("scene_date"), "b.cloud")


def first_slice(rows: DataFrame, by: list[str], time: str) -> DataFrame:
    """The earliest time slice of each group."""
    return rows.withColumn("__k", F.dense_rank().over(W.partitionBy(*by).orderBy(time))).where("__k = 1").drop("__k")


def require_bands(files: DataFrame, scenes: list, bands: list[str]) -> DataFrame:
    """The chosen files (scene, band, path); an error that names the first missing ones."""
    held = {(r["scene"], r["band"]) for r in files.select("scene", "band").collect()}  # a row per scene and band
    missing = [f"{s}/{b}" for s in scenes for b in bands if (s, b) not in held]
    if missing:
        raise FileNotFoundError(f"no band file for {', '.join(missing[:5])}")
    return files.where(F.col("band").isin(bands))


def band_files(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    """The file of each (scene, band) by the order of ``extensions``; others do not count."""
    rank = F.array_position(F.array(*[F.lit(x) for x in extensions]), F.col("extension"))
    return files.withColumn("__rank", rank).where("__rank > 0").groupBy("scene", "band").agg(F.min_by("path", "__rank").alias("path"))
