"""Raster operators on hand-made rasters; the queries' oracles cover the tables."""

import inspect
import math
import struct
from datetime import datetime

import numpy as np

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom import queries
from fieldloom.functions import bands, geo, tags
from fieldloom.operators import catalogue, classify, export, neighbourhood, pixels, resample, samples, vectors
from fieldloom.plans.features import feature_names, feature_stack
from fieldloom.plans.runner import GateError, Runner, active_stages
from fieldloom.sources import tiff, vector
from fieldloom.streaming import scenes


def cells(spark, image, name="v", scene=1):
    rows = [(r, c, scene, None if v is None or math.isnan(v) else float(v)) for r, line in enumerate(image) for c, v in enumerate(line)]
    return spark.createDataFrame(rows, f"row int, col int, scene int, {name} double")


def image_of(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["row"], r["col"]] = np.nan if r[name] is None else r[name]
    return out


def test_ndvi_and_masks(spark):
    df = spark.createDataFrame([(1000.0, 3000.0, 4), (0.0, 0.0, 4), (1000.0, 3000.0, 9), (1000.0, 3000.0, None)], "red_dn double, nir_dn double, scl int")
    assert [r.ndvi and round(r.ndvi, 12) for r in pixels.with_ndvi(df).collect()] == [0.5, None, None, 0.5]
    assert [r.x for r in spark.createDataFrame([(float("nan"),), (2.0,)], "v double").select(bands.no_nan(F.col("v")).alias("x")).collect()] == [None, 2.0]


def test_gap_fill_and_summary(spark):
    rows = [(0, 0, t, v) for t, v in enumerate([0.1, None, 0.5, 0.2])] + [(0, 1, t, None) for t in range(4)]
    df = pixels.fill_gaps(spark.createDataFrame(rows, "row int, col int, scene int, ndvi double"), "ndvi")
    got = {(r.col, r.scene): r.ndvi for r in df.collect()}
    assert got[0, 1] == 0.2 and all(got[1, t] == 0 for t in range(4))
    s = pixels.temporal_summary(df).where("col = 0").first()
    assert abs(s.ndvi_slope - np.polyfit(range(4), [0.1, 0.2, 0.5, 0.2], 1)[0]) < 1e-12 and abs(s.ndvi_amplitude - 0.4) < 1e-12


@pytest.mark.parametrize("n", [1, 3, 4, 5, 6, 9])
def test_smoothing_keeps_quadratics(spark, n):
    y = [0.3 - 0.2 * t + 0.05 * t * t for t in range(n)]
    df = spark.createDataFrame([(0, 0, t, v) for t, v in enumerate(y)], "row int, col int, scene int, ndvi double")
    got = [r.ndvi for r in pixels.smooth(df).orderBy("scene").collect()]
    assert np.allclose(got, y)


@pytest.mark.parametrize("size", [2, 3, 5])
def test_texture(spark, size):
    image = np.random.default_rng(size).random((7, 9))
    low, high = -(size // 2), size - size // 2 - 1
    padded = np.pad(image, 8, mode="symmetric")
    want = np.array([[padded[8 + r + low : 8 + r + high + 1, 8 + c + low : 8 + c + high + 1].std() for c in range(9)] for r in range(7)])
    for df in (neighbourhood.local_std(cells(spark, image), "v", size, 7, 9), neighbourhood.local_std_tiled(cells(spark, image), "v", size, 7, 9, tile=4)):
        assert np.allclose(image_of(df, f"v_std{size}", (7, 9)), want)


def test_feature_stack_has_29_columns(spark):
    names = ["blue", "green", "red", "nir", "swir1", "swir2"]
    rng = np.random.default_rng(0)
    rows = [(r, c, s, *map(float, rng.integers(1, 9000, 6)), int(rng.integers(0, 12))) for s in (1, 2, 3) for r in range(4) for c in range(5)]
    obs = spark.createDataFrame(rows, "row int, col int, scene int, " + ", ".join(f"{n}_dn double" for n in names) + ", scl int")
    out = feature_stack(obs, 4, 5, [1, 2, 3], {n: f"{n}_dn" for n in names}, "red_dn", "nir_dn")
    assert out.columns[2:] == feature_names([1, 2, 3], names) and len(out.columns) - 2 == 29
    rows = out.collect()
    assert len(rows) == 20 and all(v is not None for r in rows for v in r)
    plain = feature_stack(obs, 4, 5, [1, 2, 3], {}, "red_dn", "nir_dn", spectral=False, spatial=False, temporal=False)
    assert plain.columns[2:] == ["ndvi_1", "ndvi_2", "ndvi_3"]


def test_resampling(spark):
    image = np.arange(12.0).reshape(3, 4)
    image[1, 1] = np.nan
    near = resample.resample_nearest(cells(spark, image), (3, 4), (7, 7))
    want = image[[int((i + 0.5) * 3 / 7) for i in range(7)]][:, [int((i + 0.5) * 4 / 7) for i in range(7)]]
    assert np.array_equal(image_of(near, "v", (7, 7)), want, equal_nan=True)
    shifted = resample.reproject(cells(spark, image), "v", geo.Grid(4, 3), geo.Grid(4, 3, c=0.5))
    got = image_of(shifted, "v", (3, 4))
    assert got[0].tolist() == [0.5, 1.5, 2.5, 3.0] and got[1].tolist() == [4.0, 6.0, 6.5, 7.0]  # missing neighbours drop out
    far = resample.reproject(cells(spark, image), "v", geo.Grid(4, 3), geo.Grid(4, 3, c=100.0))
    assert np.isnan(image_of(far, "v", (3, 4))).all()


def test_utm_round_trip(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.uniform(24, 30, 50), rng.uniform(-75, 80, 50), strict=True)], "lon double, lat double")
    x, y = geo.utm_forward(F.col("lon"), F.col("lat"), 35)
    lon, lat = geo.utm_inverse(F.col("x"), F.col("y"), 35)
    for r in df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect():
        assert abs(r.lon - r.lon2) < 1e-9 and abs(r.lat - r.lat2) < 1e-9
    on_meridian = spark.createDataFrame([(27.0, 0.0)], "lon double, lat double").select(x.alias("x"), y.alias("y")).first()
    assert abs(on_meridian.x - 500000) < 1e-6 and abs(on_meridian.y) < 1e-6


SQUARE = [[{"x": 1.2, "y": 1.2}, {"x": 6.3, "y": 1.2}, {"x": 6.3, "y": 6.3}, {"x": 1.2, "y": 6.3}, {"x": 1.2, "y": 1.2}]]


def test_vectors(spark):
    polygons = spark.createDataFrame([(1, "b", SQUARE), (2, "a", [[{k: v + 2 for k, v in p.items()} for p in SQUARE[0]]])], f"fid int, class_name string, rings {vectors.RINGS}")
    grid = spark.range(100).select((F.col("id") / 10).cast("int").alias("row"), (F.col("id") % 10).cast("int").alias("col")).withColumns({"x": F.col("col") + 0.5, "y": F.col("row") + 0.5})
    got = image_of(vectors.rasterize(polygons, grid, vectors.class_ids(polygons)), "class_id", (10, 10))
    want = np.zeros((10, 10))
    want[1:6, 1:6] = 2
    want[3:8, 3:8] = 1  # the later polygon wins
    assert np.array_equal(got, want)
    cut = vectors.clip(polygons, 0.0, 0.0, 4.1, 9.0)
    inside = {(r.fid, r.row, r.col) for r in vectors.cover(cut, grid).collect()}
    assert inside == {(f, r, c) for f, r, c in ((x.fid, x.row, x.col) for x in vectors.cover(polygons, grid).collect()) if c + 0.5 <= 4.1}
    assert vectors.clip(polygons, 50.0, 50.0, 60.0, 60.0).count() == 0
    line = spark.createDataFrame([(7, "road", [[{"x": 1.0, "y": 1.0}, {"x": 8.0, "y": 8.0}]])], f"fid int, class_name string, rings {vectors.RINGS}")
    near = {(r.row, r.col) for r in vectors.near_line(line, grid, 1.1).collect()}
    shape = {(r.row, r.col) for r in vectors.cover(vectors.buffer_lines(line, 1.1, 32), grid).collect()}
    assert near == shape and (4, 4) in near


def test_tags_priority(spark):
    rows = [({"landuse": "vineyard", "natural": "water"}, "vineyard"), ({"landuse": "reservoir"}, "non_agri"), ({"natural": "water"}, "non_agri"), ({"highway": "primary", "landuse": "orchard"}, "orchard"), ({"highway": ""}, None), ({}, None)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t map<string,string>")
    assert [r.c for r in df.select(tags.tag_class(F.col("t")).alias("c")).collect()] == [c for _, c in rows]


def test_catalogue(spark):
    items = spark.createDataFrame([("a", "2024-01-02 10:00:00", 9.0), ("b", "2024-01-05 23:59:00", 9.0), ("c", "2024-01-04 00:00:00", 30.0), ("d", "2024-01-06 00:00:00", 1.0)], "id string, datetime string, cloud double").withColumn("datetime", F.to_timestamp("datetime"))
    windows = spark.createDataFrame([(1, "2024-01-01/2024-01-05"), (2, "2025-01-01/2025-01-02")], "window_id int, t string")
    start, end = catalogue.parse_interval(F.col("t"))
    best = catalogue.least_cloudy(items, windows.select("window_id", start.alias("start"), end.alias("end"))).collect()
    assert [(r.window_id, r.id, r.scene_date) for r in best] == [(1, "a", "2024-01-02")]
    assert {r.id for r in catalogue.search(items, "2024-01-01", "2024-01-05").collect()} == {"a", "b"}


def test_split_and_report(spark):
    rows = spark.createDataFrame([(k, "a" if k < 41 else "b") for k in range(60)], "k long, cls string")
    split = samples.stratified_split(rows, "cls", "k")
    assert {r.cls: r.n for r in split.where("held_out").groupBy("cls").agg(F.count("*").alias("n")).collect()} == {"a": 10, "b": 5}
    report = {r.label: r for r in samples.report(spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "t int, p int"), "t", "p").collect()}
    assert report["2"].precision == pytest.approx(1 / 3) and report["3"].f1 == 0 and report["accuracy"].f1 == 0.5


def test_forest_and_pca(spark):
    rng = np.random.default_rng(1)
    rows = [(k, 0, float(x), float(y), 1 if x > 0.5 else 2) for k, (x, y) in enumerate(rng.random((200, 2)))]
    df = spark.createDataFrame(rows, "row int, col int, a double, b double, class_id int")
    model = classify.train_forest(df, ["a", "b"], trees=10, depth=5)
    asked = df.select("row", "col", F.when(F.col("row") > 4, F.col("a")).alias("a"), "b")
    got = {r["row"]: r.class_id for r in classify.predict(model, asked, ["a", "b"]).collect()}
    assert all(got[k] == 0 for k in range(5)) and np.mean([got[r[0]] == r[4] for r in rows[5:]]) > 0.97
    pca = classify.fit_pca(df, ["a", "b"], 16)
    out = classify.apply_pca(pca, df).agg(F.avg("deep_pca_00"), F.avg("deep_pca_01")).first()
    assert max(map(abs, out)) < 1e-9 and classify.explained_variance(pca) == pytest.approx(1)


def test_forest_query_trains_the_whole_forest(spark, monkeypatch):
    asked, train = [], classify.train_forest

    def small(*args, **kwargs):
        call = inspect.signature(train).bind(*args, **kwargs)
        call.apply_defaults()
        asked.append((call.arguments["trees"], call.arguments["depth"]))
        return train(*args, **kwargs | {"trees": 3, "depth": 3})

    monkeypatch.setattr(classify, "train_forest", small)
    assert queries.j1_j2_forest(spark, "/root/testdata/sf0.001").count() == 1600
    assert asked == [(300, 30)]


def test_pca_query_reads_whole_embeddings(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    x -= x.mean(axis=0)
    axes = np.linalg.svd(x, full_matrices=False)[2][:2]
    axes *= np.sign(axes[np.arange(2), np.abs(axes).argmax(axis=1)])[:, None]
    got = np.array([tuple(r)[1:] for r in queries.j4_pca(spark, sf_dir).orderBy("vec_id").collect()])
    assert x.shape[1] == 64 and np.allclose(got, x @ axes.T, atol=2e-6)


def test_masks_partition_the_map(spark):
    image = np.array([[0, 1, 1], [2, 2, 1], [0, 3, 3]])
    square = export.to_square(cells(spark, image, "class_id").withColumn("class_id", F.col("class_id").cast("int")).drop("scene"), (3, 3))
    classes = spark.createDataFrame([(1, "a/b"), (2, "c"), (3, "d"), (4, "none")], "class_id int, class_name string")
    total = np.zeros((127, 127), int)
    for r in export.mask_images(square, classes, 127, 16).collect():
        width, height, depth = struct.unpack_from(">IIB", r.png, 16)
        assert (width, height, depth) == (127, 127, 16)
        import zlib

        at = r.png.index(b"IDAT")
        raw = np.frombuffer(zlib.decompress(r.png[at + 4 : at + 4 + struct.unpack_from(">I", r.png, at - 4)[0]]), np.uint8).reshape(127, -1)[:, 1:].copy().view(">u2")
        total += (raw == 65535) * 1
    assert total.max() == 1 and total.sum() == square.where("class_id > 0").count()
    assert export.file_name("a/b") == "weightmap_a_b.png" and [export.valid_size_of(n) for n in (1, 127, 128, 9000)] == [127, 127, 253, 8129]


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 3), st.integers(1, 40), st.integers(1, 40), st.sampled_from(["float32", "float64", "uint8", "uint16", "int32"]), st.sampled_from([1, 2, 3]))
def test_tiff_round_trip(bands_n, h, w, dtype, predictor):
    x = np.random.default_rng(h * w).integers(0, 200, (bands_n, h, w)).astype(dtype)
    predictor = predictor if (predictor == 3) == (np.dtype(dtype).kind == "f") else 1
    r = tiff.decode(tiff.encode(tiff.Raster(x, (600000.0, 4.1e6), (10.0, -10.0), 32635, None, [f"b{k}" for k in range(bands_n)]), predictor, rows=7))
    assert np.array_equal(r.samples, x) and r.origin == (600000.0, 4.1e6) and r.pixel == (10.0, -10.0) and r.epsg == 32635 and r.names[0] == "b0"


def test_rasters_through_spark(spark, tmp_path):
    image = np.array([[0.5, None, 2.0], [3.0, 4.0, 5.0]], dtype=object)
    df = cells(spark, [[math.nan if v is None else v for v in line] for line in image]).withColumn("file", F.lit("s/B04.tif"))
    assert tiff.write_rasters(df, str(tmp_path), 2, 3, ["v"]) == 1
    got = tiff.read_pixels(spark, str(tmp_path))
    assert np.array_equal(image_of(got, "value", (2, 3)), np.array([[0.5, np.nan, 2], [3, 4, 5]]), equal_nan=True)
    assert tiff.read_pixels(spark, str(tmp_path), window=(1, 1, 1, 2)).count() == 2
    assert tiff.read_profiles(spark, str(tmp_path)).first().width == 3


def test_geopackage_round_trip(spark, tmp_path):
    polygons = spark.createDataFrame([(1, "wheat", SQUARE), (2, "corn", SQUARE)], f"fid long, class_name string, rings {vectors.RINGS}")
    vector.write_geopackage(polygons, str(tmp_path / "l.gpkg"), 32635)
    got = vector.read_geopackage(spark, str(tmp_path))
    assert sorted((r.fid, r.class_name, r.srid, len(r.rings[0])) for r in got.collect()) == [(1, "wheat", 32635, 5), (2, "corn", 32635, 5)]


def test_fetch_tries_mirrors():
    calls, waits = [], []

    def send(url, body):
        calls.append(url)
        if len(calls) < 5:
            raise OSError("busy")
        return b"{}"

    assert vector.fetch("q", send, waits.append) == "{}"
    assert calls == [vector.MIRRORS[0]] * 3 + [vector.MIRRORS[1]] * 2 and waits == [5.0, 10.0, 5.0]


def test_runner(spark, tmp_path):
    one = spark.range(3)
    stages = {k: (lambda s, r, k=k: {k: one}) for k in ("download", "ndvi", "classify", "weightmaps")}
    runner = Runner(str(tmp_path), stages, bootstrap=lambda s, r: one)
    assert runner.run(spark) == ["download", "ndvi"]  # stops for the ground truth to be completed
    assert runner.run(spark, "classify") == ["download", "ndvi", "classify", "weightmaps"]
    with pytest.raises(GateError):
        Runner(str(tmp_path / "x"), stages).run(spark, "classify")
    with pytest.raises(ValueError):
        active_stages("classify", "ndvi")


def test_scene_stream(spark, tmp_path):
    schema = "scene_time timestamp, row int, col int, red_dn double, nir_dn double, scl int"
    rows = [(datetime(2024, 5, 1), 0, 0, 1000.0, 3000.0, 4)] * 2 + [(datetime(2024, 5, 1), 0, 1, 1000.0, 3000.0, 9)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    scenes.append_to(scenes.scene_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("col").collect()
    assert [r.ndvi and round(r.ndvi, 12) for r in got] == [0.5, None]
