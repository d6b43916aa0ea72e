"""Scene folders as observations, and stacks as tables or TIFF files with a sidecar."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bands import BAND_EXTENSIONS, BANDS
from ..functions.geo import Grid
from ..operators.catalogue import band_files
from ..operators.resample import attach_nearest, reproject
from ..sources.files import read_binary, write_binary
from ..sources.tiff import read_pixels, read_profiles, write_rasters
from ..sources.vector import sidecar_json

SCENE = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/([^/]+)(\.[^./]+)$"


def scene_files(spark: SparkSession, folder: str) -> DataFrame:
    """(scene, band, path) of a store scenes/<date>/<band>.<extension>, one file for each scene and band."""
    files = read_binary(spark, folder, "*").select("path")
    part = lambda k: F.regexp_extract("path", SCENE, k)
    named = files.select("path", part(1).alias("scene"), F.upper(part(2)).alias("band"), F.lower(part(3)).alias("extension")).where("scene <> ''")
    return band_files(named, BAND_EXTENSIONS)


def load_scenes(spark: SparkSession, folder: str, bands: tuple[str, ...] = tuple(BANDS)) -> tuple[DataFrame, Grid, list[str]]:
    """((row, col, scene, B02, ..., scl), reference grid, scenes) of a scene store.

    The grid is that of the first scene's B04.  Bands on another grid are resampled bilinearly, scene
    classes by the nearest cell; a band without a file in any scene is left out.  An error without
    scenes or without B04 in the first.
    """
    files = scene_files(spark, folder)
    # A row per file: a scene has seven.
    profiles = {r["path"]: r for r in read_profiles(spark, folder).collect()}
    held = [(r["scene"], r["band"], r["path"]) for r in files.collect() if r["band"] in (*bands, "SCL")]
    scenes = sorted({s for s, _, _ in held})
    if not scenes:
        raise ValueError(f"no scene folders with bands in {folder}")
    first = next((p for s, b, p in held if (s, b) == (scenes[0], "B04")), None)
    if first is None:
        raise ValueError(f"scene {scenes[0]} has no B04")

    def grid_of(path: str) -> Grid:
        r = profiles[path]
        return Grid(r["width"], r["height"], a=r["dx"], c=r["x0"], e=r["dy"], f=r["y0"], epsg=r["epsg"] or 0)

    reference = grid_of(first)
    values = read_pixels(spark, folder).where("band = 1").select("path", "row", "col", "value")
    keys = spark.createDataFrame([(s, b, p) for s, b, p in held], "scene string, band string, path string")
    values = values.join(F.broadcast(keys), "path")  # a row per file
    groups: dict[tuple[Grid, bool], list[tuple[str, str]]] = {}
    for s, b, p in held:
        groups.setdefault((grid_of(p), b == "SCL"), []).append((s, b))
    parts = []
    for (grid, classes), own in groups.items():
        mine = values.where(F.concat_ws("/", "scene", "band").isin([f"{s}/{b}" for s, b in own])).select("scene", "band", "row", "col", "value")
        if grid == reference:
            parts.append(mine)
        elif classes:
            cells = spark.range(reference.height * reference.width).select((F.col("id") / reference.width).cast("int").alias("row"), (F.col("id") % reference.width).cast("int").alias("col"))
            cells = cells.withColumn("scene", F.explode(F.array(*[F.lit(s) for s, _ in own]))).withColumn("band", F.lit("SCL"))
            parts.append(attach_nearest(cells, mine, "value", (reference.height, reference.width), (grid.height, grid.width), ("scene", "band")).select("scene", "band", "row", "col", "value"))
        else:
            parts.append(reproject(mine, "value", grid, reference, ("scene", "band")).select("scene", "band", "row", "col", "value"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    present = [b for b in bands if any(b == x for _, x, _ in held)]
    pick = lambda b: F.max(F.when(F.col("band") == b, F.col("value")))
    wide = rows.groupBy("row", "col", "scene").agg(*[pick(b).alias(b) for b in present], pick("SCL").cast("int").alias("scl"))
    return wide, reference, scenes


def write_stack(stack: DataFrame, path: str, grid: Grid, scenes: list[str]) -> None:
    """A Parquet table, or one TIFF file if the path says so, and ``<path>.json`` with its bands and grid."""
    names = [c for c in stack.columns if c not in ("row", "col")]
    if path.endswith((".tif", ".tiff")):
        folder, _, name = path.rpartition("/")
        write_rasters(stack.withColumn("file", F.lit(name)), folder or ".", grid.height, grid.width, names, origin=(grid.c, grid.f), pixel=(grid.a, grid.e), epsg=grid.epsg or None)
    else:
        stack.write.mode("overwrite").parquet(path)
    side = json.loads(sidecar_json(names, scenes)) | {"grid": [grid.width, grid.height, grid.a, grid.b, grid.c, grid.d, grid.e, grid.f, grid.epsg]}
    write_text(stack.sparkSession, path + ".json", json.dumps(side, indent=2))


def read_stack(spark: SparkSession, path: str) -> tuple[DataFrame, Grid, dict]:
    """((row, col, bands...), grid, sidecar) of a written stack."""
    side = json.loads(spark.read.text(path + ".json", wholetext=True).first()[0])
    grid = Grid(*side["grid"])
    if not path.endswith((".tif", ".tiff")):
        return spark.read.parquet(path), grid, side
    rows = read_pixels(spark, path)
    wide = rows.groupBy("row", "col").agg(*[F.max(F.when(F.col("band") == k, F.col("value"))).alias(n) for k, n in enumerate(side["features"], 1)])
    return wide, grid, side


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written from a task."""
    folder, _, name = path.rpartition("/")
    write_binary(spark.createDataFrame([(name, bytearray(text.encode()))], "file string, content binary"), folder or ".")
