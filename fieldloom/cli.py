"""The command line: ``python -m fieldloom.cli <command> ...``, one command for each stage and one for all.

Stacks are Parquet tables, or TIFF files where a path ends in .tif; scenes are folders <date>/<band>.tif.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.bands import BANDS, RGB
from .functions.geo import Grid, transform, utm_forward
from .functions.tags import overpass_query
from .operators import catalogue, classify, deep, export, pixels, samples, vectors
from .plans.features import feature_stack, filled_cells
from .plans.runner import GateError, active_stages
from .plans.scenes import load_scenes, read_stack, write_stack, write_text
from .sources import vector
from .sources.files import read_binary, write_binary
from .sources.shapefile import read_shapefile


def read_layer(spark: SparkSession, path: str, class_field: str = "class_name") -> DataFrame:
    """(fid, class_name, rings) of a GeoPackage, a shapefile or a Parquet table."""
    if path.endswith(".gpkg"):
        layer = vector.read_geopackage(spark, path, class_field)
    elif path.endswith(".shp"):
        layer = read_shapefile(spark, path.removesuffix(".shp") + ".{shp,dbf}", class_field)
    else:
        layer = spark.read.parquet(path).withColumnRenamed(class_field, "class_name")
    return layer.select("fid", "class_name", "rings")


def centres(spark: SparkSession, grid: Grid) -> DataFrame:
    cells = spark.range(grid.height * grid.width).select((F.col("id") / grid.width).cast("int").alias("row"), (F.col("id") % grid.width).cast("int").alias("col"))
    x, y = grid.to_ground(F.col("row"), F.col("col"))
    return cells.withColumns({"x": x, "y": y})


def download(spark: SparkSession, a: argparse.Namespace) -> None:
    """The least cloudy item of each window: its band files are copied to <output>/<date>/<band>.

    Items come from a STAC feature collection in a file (``--items``), with assets named by band.
    """
    if not a.items:
        raise GateError("download needs --items: a STAC feature collection, as this package calls no catalogue by itself")
    if not a.windows:
        raise ValueError("at least one --window start/end")
    box = a.bbox
    if box is None and a.aoi:
        box = list(vectors.extent(read_layer(spark, a.aoi)).first())
    schema = "features array<struct<id: string, bbox: array<double>, properties: map<string,string>, assets: map<string,struct<href: string>>>>"
    rows = spark.read.text(a.items, wholetext=True).select(F.explode(F.from_json("value", schema)["features"]).alias("f"))
    items = rows.select("f.id", F.to_timestamp(F.col("f.properties")["datetime"]).alias("datetime"), F.col("f.properties")["eo:cloud_cover"].cast("double").alias("cloud"), F.struct(*[F.col("f.bbox")[k].alias(n) for k, n in enumerate("wsen")]).alias("box"), "f.assets")
    if box:
        items = items.where(catalogue.overlaps(F.col("box"), *box))
    wanted = spark.createDataFrame([(k, *w.split("/")) for k, w in enumerate(a.windows)], "window_id int, start string, end string").select("window_id", F.to_date("start").alias("start"), F.to_date("end").alias("end"))
    chosen = catalogue.least_cloudy(items.select("id", "datetime", "cloud"), wanted, a.max_cloud).join(items.select("id", "assets"), "id")
    assets = chosen.select("scene_date", F.explode("assets").alias("band", "asset")).where(F.col("band").isin(*BANDS, "SCL"))
    for r in assets.select("scene_date", "band", "asset.href").collect():  # seven small rows per window
        end = "." + r["href"].rpartition(".")[2]
        write_binary(read_binary(spark, r["href"]).select(F.lit(f"{r['scene_date']}/{r['band']}{end}").alias("file"), "content"), a.output_dir)


def ndvi_stack(spark: SparkSession, a: argparse.Namespace) -> None:
    obs, grid, scenes = load_scenes(spark, a.scenes_dir, ("B04", "B08"))
    cells = filled_cells(obs, grid.height, grid.width, scenes, {}, "B04", "B08")
    cells = pixels.smooth(cells) if a.smooth == "savgol" else cells
    write_stack(pixels.wide_by_scene(cells, ["ndvi"], scenes), a.output, grid, scenes)


def build_features(spark: SparkSession, a: argparse.Namespace) -> None:
    obs, grid, scenes = load_scenes(spark, a.scenes_dir)
    bands = {name: band for band, name in BANDS.items() if band in obs.columns}
    out = feature_stack(obs, grid.height, grid.width, scenes, bands, "B04", "B08", "scl", a.window_size, a.spectral, a.spatial, a.temporal)
    write_stack(out, a.output, grid, scenes)


def deep_features(spark: SparkSession, a: argparse.Namespace) -> None:
    """Append principal components of block means; networks run through operators.deep with any extractor."""
    if a.weights or a.checkpoint:
        raise GateError("no network comes with this package: call operators.deep.tile_features with an extractor")
    obs, grid, scenes = load_scenes(spark, a.scenes_dir, RGB)
    stack, own, side = read_stack(spark, a.stack_path)
    deep.check_shape((own.height, own.width), (grid.height, grid.width))
    cells = pixels.densify(obs, grid.height, grid.width, scenes)
    stride = deep.STRIDES[a.cut_layer]
    images = pixels.zscore(cells, RGB[0]) if a.per_date else pixels.composite(cells, *RGB)
    maps = deep.tile_features(images, list(RGB), deep.block_means(stride), len(RGB), grid.height, grid.width, a.tile_size, 4 * stride, scenes if a.per_date else None)
    model = deep.fit_components(maps, grid.height, grid.width, a.tile_size, a.components)
    target = a.stack_path if not a.stack_path.endswith((".tif", ".tiff")) else a.stack_path.rpartition(".")[0]
    write_stack(deep.add_deep_features(stack, maps, model), target + "_deep" + a.stack_path[len(target) :], grid, side["band_dates"])


def fetch_osm_labels(spark: SparkSession, a: argparse.Namespace) -> None:
    _, grid, _ = read_stack(spark, a.stack_path)
    corners = spark.createDataFrame([(float(x), float(y)) for x in (0, grid.width) for y in (0, grid.height)], "i double, j double").select((F.col("i") * grid.a + grid.c).alias("x"), (F.col("j") * grid.e + grid.f).alias("y"))
    if a.bbox:
        west, south, east, north = a.bbox
    else:
        lon, lat = transform(F.col("x"), F.col("y"), grid.epsg, 4326)
        west, south, east, north = corners.select(lon.alias("x"), lat.alias("y")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    box = spark.createDataFrame([(west, south, east, north)], "w double, s double, e double, n double")
    text = vector.fetch(box.select(overpass_query(*[F.col(c) for c in "wsen"])).first()[0])
    write_layer(osm_polygons(spark, text, grid, a.road_buffer, a.max_per_class), a.output, grid.epsg)


def osm_polygons(spark: SparkSession, text: str, grid: Grid, buffer: float = 8.0, most: int | None = None) -> DataFrame:
    """(fid, class_name, rings) in the grid's CRS of a GeoJSON answer; lines become thin polygons."""
    rows = vector.features(spark.createDataFrame([(text,)], "value string")).withColumn("fid", F.monotonically_increasing_id())
    zone = grid.epsg % 100

    def ground(p):
        x, y = utm_forward(p["x"], p["y"], zone, grid.epsg < 32700)
        return F.struct(x.alias("x"), y.alias("y"))

    rows = rows.withColumn("rings", F.transform("rings", lambda r: F.transform(r, ground)))
    line = F.col("geometry_type").isin("LineString", "MultiLineString")
    areas, lines = (rows.where(c).select("fid", "class_name", "rings") for c in (~line, line))
    out = areas.unionByName(vectors.buffer_lines(lines, buffer).select("fid", "class_name", "rings"))
    return samples.cap_per_class(out, most) if most else out


def write_layer(polygons: DataFrame, path: str, epsg: int) -> None:
    if path.endswith(".gpkg"):
        vector.write_geopackage(polygons, path, epsg)
    else:
        polygons.write.mode("overwrite").parquet(path)


def run_classify(spark: SparkSession, a: argparse.Namespace) -> None:
    stack, grid, side = read_stack(spark, a.stack_path)
    polygons = read_layer(spark, a.ground_truth, a.class_field).where(F.col("class_name").isNotNull())
    classes = vectors.class_ids(polygons)
    labels = vectors.rasterize(polygons, centres(spark, grid), classes)
    names = side["features"]
    rows = samples.drop_incomplete(samples.training_samples(labels, stack), names)
    split = samples.stratified_split(rows.withColumn("__cell", F.col("row").cast("long") * grid.width + F.col("col")), "class_id", "__cell")
    model = classify.train_forest(split.where("not held_out"), names, a.trees)
    held = classify.predict(model, split.where("held_out").select("row", "col", *names), names).withColumnRenamed("class_id", "predicted")
    samples.report(held.join(labels, ["row", "col"]), "class_id", "predicted").show(100, False)
    if a.model_out:
        classify.save_forest(model, classes, a.model_out)
    out = classify.predict(model, stack, names)
    out.write.mode("overwrite").parquet(a.output)
    legend = vector.legend_json(classes).first()[0]
    write_text(spark, a.output + ".json", json.dumps({"classes": json.loads(legend), "size": [grid.height, grid.width]}))


def export_weightmaps(spark: SparkSession, a: argparse.Namespace) -> None:
    side = json.loads(spark.read.text(a.class_map or a.classified + ".json", wholetext=True).first()[0])
    classes = spark.createDataFrame([(int(k), v) for k, v in side["classes"].items()], "class_id int, class_name string")
    cells, size = spark.read.parquet(a.classified), tuple(side["size"])
    target = a.target_size or export.valid_size_of(max(size))
    export.write_masks(export.mask_images(export.to_square(cells, size, target), classes, target, a.bit_depth), a.output_dir)
    export.coverage(cells, classes).show(300, False)


def run_pipeline(spark: SparkSession, a: argparse.Namespace) -> None:
    """All stages from ``--start-from`` to ``--stop-after``; stops for ground truth to be completed."""
    out = a.output_dir.rstrip("/")
    a.stack_path = a.output = f"{out}/feature_stack"
    for stage in active_stages(a.start_from, a.stop_after):
        if stage == "download":
            download(spark, argparse.Namespace(**vars(a) | {"output_dir": a.scenes_dir}))
        elif stage == "ndvi":
            (build_features if a.features == "full" else ndvi_stack)(spark, a)
            if a.deep_features:
                deep_features(spark, argparse.Namespace(**vars(a) | {"weights": None, "checkpoint": a.deep_checkpoint, "components": a.deep_components, "tile_size": a.deep_tile_size, "cut_layer": "layer2", "per_date": False}))
        elif stage == "classify":
            if not exists(spark, a.ground_truth):
                if not a.bootstrap_osm:
                    raise GateError(f"{a.ground_truth} is missing: digitise it or give --bootstrap-osm")
                fetch_osm_labels(spark, argparse.Namespace(**vars(a) | {"output": a.ground_truth, "road_buffer": 8.0, "bbox": None}))
                print(f"{a.ground_truth} holds a first version: complete it, then run again with --start-from classify")
                return
            deep_stack = a.stack_path + "_deep"
            stack = deep_stack if a.deep_features and exists(spark, deep_stack) else a.stack_path
            run_classify(spark, argparse.Namespace(**vars(a) | {"stack_path": stack, "output": f"{out}/classified", "model_out": f"{out}/model"}))
        else:
            export_weightmaps(spark, argparse.Namespace(**vars(a) | {"classified": f"{out}/classified", "class_map": None, "output_dir": f"{out}/weightmaps"}))


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fieldloom")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *places: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=(run.__doc__ or "").partition("\n")[0])
        p.set_defaults(run=run)
        for place in places:
            p.add_argument(place)
        return p

    def source(p: argparse.ArgumentParser) -> None:
        p.add_argument("--bbox", nargs=4, type=float)
        p.add_argument("--aoi")
        p.add_argument("--items", help="STAC feature collection as a file")
        p.add_argument("--window", action="append", dest="windows", default=[])
        p.add_argument("--max-cloud", type=float, default=20.0)

    source(command("download", download, "output_dir"))
    command("ndvi_stack", ndvi_stack, "scenes_dir", "output").add_argument("--smooth", choices=["median", "savgol"], default="median")
    p = command("build_features", build_features, "scenes_dir", "output")
    p.add_argument("--window-size", type=int, default=5)
    for group in ("spectral", "spatial", "temporal"):
        p.add_argument(f"--no-{group}", dest=group, action="store_false")
    p = command("deep_features", deep_features, "scenes_dir", "stack_path")
    for flag in ("--weights", "--checkpoint", "--device"):
        p.add_argument(flag)
    p.add_argument("--components", type=int, default=16)
    p.add_argument("--tile-size", type=int, default=512)
    p.add_argument("--cut-layer", choices=list(deep.STRIDES), default="layer2")
    p.add_argument("--per-date", action="store_true")
    p = command("fetch_osm_labels", fetch_osm_labels, "stack_path", "output")
    p.add_argument("--bbox", nargs=4, type=float)
    p.add_argument("--road-buffer", type=float, default=8.0)
    p.add_argument("--max-per-class", type=int)
    p = command("classify", run_classify, "stack_path", "ground_truth", "output")
    p.add_argument("--class-field", default="class_name")
    p.add_argument("--model-out")
    p.add_argument("--tile-size", type=int, default=1024, help="kept for callers: Spark partitions the stack itself")
    p.add_argument("--trees", type=int, default=300)
    p = command("export_weightmaps", export_weightmaps, "classified", "class_map", "output_dir")
    p.add_argument("--bit-depth", type=int, choices=[8, 16], default=8)
    p.add_argument("--target-size", type=int)
    p = command("run_pipeline", run_pipeline)
    source(p)
    p.add_argument("--scenes-dir", default="scenes")
    p.add_argument("--output-dir", default="output")
    p.add_argument("--ground-truth", default="ground_truth.gpkg")
    p.add_argument("--features", choices=["full", "ndvi"], default="full")
    p.add_argument("--window-size", type=int, default=5)
    p.add_argument("--deep-features", action="store_true")
    p.add_argument("--deep-checkpoint")
    p.add_argument("--deep-components", type=int, default=16)
    p.add_argument("--deep-tile-size", type=int, default=512)
    p.add_argument("--smooth", choices=["median", "savgol"], default="median")
    p.add_argument("--class-field", default="class_name")
    p.add_argument("--tile-size", type=int, default=1024)
    p.add_argument("--trees", type=int, default=300)
    p.add_argument("--bit-depth", type=int, choices=[8, 16], default=8)
    p.add_argument("--target-size", type=int)
    p.add_argument("--bootstrap-osm", action="store_true")
    p.add_argument("--max-per-class", type=int)
    p.add_argument("--start-from", choices=["download", "ndvi", "classify", "weightmaps"], default="download")
    p.add_argument("--stop-after", choices=["download", "ndvi", "classify", "weightmaps"], default="weightmaps")
    p.set_defaults(spectral=True, spatial=True, temporal=True)
    return top


def main(words: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(words)
    a.run(spark or SparkSession.builder.appName("fieldloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
