"""Files, models, deep features and the command line, on small scenes."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom import cli
from fieldloom.functions import geo, tags
from fieldloom.operators import catalogue, classify, deep, neighbourhood, pixels, resample, samples
from fieldloom.plans.features import feature_stack
from fieldloom.plans.runner import GateError, Runner
from fieldloom.sources import shapefile, tiff, vector
from fieldloom.sources.files import write_binary


def grid_rows(spark, image, **more):
    h, w = image.shape
    rows = [(r, c, float(image[r, c])) for r in range(h) for c in range(w)]
    return spark.createDataFrame(rows, "row int, col int, v double").withColumns({k: F.lit(v) for k, v in more.items()})


@pytest.mark.parametrize(("size", "shape"), [(3, (7, 9)), (4, (6, 5)), (9, (3, 4))])  # also boxes larger than the image
def test_texture_by_sliding_sums(spark, size, shape):
    image = np.random.default_rng(size).random(shape)
    h, w = shape
    lo, hi = -(size // 2), size - size // 2 - 1
    mirror = lambda i, n: i % (2 * n) if i % (2 * n) < n else 2 * n - 1 - i % (2 * n)
    want = np.array([[np.std([image[mirror(r + a, h), mirror(c + b, w)] for a in range(lo, hi + 1) for b in range(lo, hi + 1)]) for c in range(w)] for r in range(h)])
    cells = grid_rows(spark, image, scene=1, other="kept")
    for out in (neighbourhood.with_local_std(cells, "v", size, h, w), neighbourhood.local_std_tiled(cells, "v", size, h, w, tile=4)):
        got = np.zeros(shape)
        for r in out.collect():
            got[r["row"], r["col"]] = r[f"v_std{size}"]
        assert np.allclose(got, want, atol=1e-7)
    assert neighbourhood.with_local_std(cells, "v", size, h, w).where("other = 'kept'").count() == h * w


def test_split_without_class_tasks(spark, monkeypatch):
    for buckets in (1, 8, 1 << 14):
        monkeypatch.setattr(samples, "BUCKETS", buckets)
        rows = spark.range(1000).select(F.col("id").alias("fid"), F.when(F.col("id") < 700, "a").when(F.col("id") < 999, "b").alias("class_name"))
        split = {r.class_name: (r.n, r.h) for r in samples.stratified_split(rows, "class_name", "fid").groupBy("class_name").agg(F.count("*").alias("n"), F.count_if("held_out").alias("h")).collect()}
        assert split == {"a": (700, 175), "b": (299, 75), None: (1, 0)}
        order = lambda k: (((k * 48271 + 42 * 16807 + 11) % 2147483647) * 69621 + 7) % 2147483647
        capped = {r.fid for r in samples.cap_per_class(rows, 20).where("class_name = 'a'").collect()}
        assert capped == set(sorted(range(700), key=lambda k: (order(k), k))[:20])
        assert samples.cap_per_class(rows, 5000).count() == 1000 and samples.cap_per_class(rows.where("false"), 5).count() == 0


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(k, 0, float(k), 1 if k < 50 else 2) for k in range(100)], "row int, col int, a double, class_id int")
    model = classify.train_forest(df, ["a"], trees=3, depth=3)
    classes = spark.createDataFrame([(1, "x"), (2, "y")], "class_id int, class_name string")
    classify.save_forest(model, classes, str(tmp_path / "m"))
    again, legend = classify.load_forest(spark, str(tmp_path / "m"))
    asked = df.select("row", "col", F.when(F.col("row") != 3, F.col("a")).alias("a"))
    assert sorted(classify.predict(again, asked, ["a"]).collect()) == sorted(classify.predict(model, asked, ["a"]).collect())
    assert {r["row"]: r.class_id for r in classify.predict(again, asked, ["a"]).collect()}[3] == 0 and legend.count() == 2


def test_deep_features(spark):
    image = np.random.default_rng(2).random((20, 23))
    want = deep.stretch(deep.block_means(4)(image[None]), 20, 23)[0]
    got = np.zeros((20, 23))
    for r in deep.tile_features(grid_rows(spark, image), ["v"], deep.block_means(4), 1, 20, 23, tile=8, halo=8).collect():
        got[r["row"], r["col"]] = r.f0
    assert np.allclose(got[:16, :16], want[:16, :16], atol=0.05)  # block edges differ only where the image ends
    both = grid_rows(spark, image, scene=1).unionByName(grid_rows(spark, image * 2, scene=2))
    maps = deep.tile_features(both, ["v"], deep.block_means(4), 1, 20, 23, tile=8, halo=8, scenes=[1, 2])
    assert all(abs(r.f1 - 2 * r.f0) < 1e-9 for r in maps.collect())
    model = deep.fit_components(maps, 20, 23, 8, 2, sample=200)
    stack = grid_rows(spark, image).withColumn("deep_pca_00", F.lit(9.0))
    out = deep.add_deep_features(stack, maps, model)
    assert out.columns == ["row", "col", "v", "deep_pca_00", "deep_pca_01"] and out.count() == 460 and out.where("deep_pca_00 = 9").count() == 0
    with pytest.raises(ValueError):
        deep.check_shape((3, 4), (4, 3))


def big(content: bytes) -> bytes:
    """A classic little-endian file with 64-bit offsets instead."""
    at, (count,) = struct.unpack_from("<I", content, 4)[0], struct.unpack_from("<H", content, struct.unpack_from("<I", content, 4)[0])
    out = bytearray(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)) + struct.pack("<Q", count)
    extra, base = bytearray(), 16 + 8 + 20 * count + 8
    tags_ = []
    for k in range(count):
        tag, kind, n = struct.unpack_from("<HHI", content, at + 2 + 12 * k)
        size = tiff._SIZES[kind] * n
        spot = at + 10 + 12 * k if size <= 4 else struct.unpack_from("<I", content, at + 10 + 12 * k)[0]
        tags_.append([tag, kind, n, content[spot : spot + size]])
    shift = base + sum(len(v) for *_, v in tags_ if len(v) > 8)
    for tag, kind, n, raw in tags_:
        if tag == tiff.STRIPS:
            raw = struct.pack(f"<{n}I", *[x + shift for x in struct.unpack(f"<{n}I", raw)])
        if len(raw) <= 8:
            out += struct.pack("<HHQ", tag, kind, n) + raw.ljust(8, b"\0")
        else:
            out += struct.pack("<HHQQ", tag, kind, n, base + len(extra))
            extra += raw
    return bytes(out + struct.pack("<Q", 0) + extra) + content


def test_windows_profiles_and_large_files(monkeypatch):
    x = np.random.default_rng(3).integers(0, 999, (2, 50, 30)).astype("uint16")
    data = tiff.encode(tiff.Raster(x, (5.0, 6.0), (10.0, -10.0), 32635, 7.0, ["a", "b"]), rows=8)
    opened, plain = [], tiff.zlib.decompress
    monkeypatch.setattr(tiff.zlib, "decompress", lambda raw: opened.append(1) or plain(raw))
    assert np.array_equal(tiff.decode(data, (9, 4, 6, 5)).samples, x[:, 9:15, 4:9]) and len(opened) == 2  # one strip of each band
    assert np.array_equal(tiff.decode(big(data)).samples, x)
    opened.clear()
    p = tiff.profile(data)
    assert (p.width, p.height, p.bands, p.dtype.name, p.epsg, p.nodata, p.names) == (30, 50, 2, "uint16", 32635, 7.0, ["a", "b"]) and not opened


def shp(rings):
    body = b""
    for k, own in enumerate(rings, 1):
        points = [p for r in own for p in r]
        first = np.cumsum([0, *map(len, own[:-1])]).tolist() if own else []
        record = struct.pack("<i4dii", 5, 0, 0, 0, 0, len(own), len(points)) + struct.pack(f"<{len(own)}i", *first) + b"".join(struct.pack("<dd", *p) for p in points) if own else struct.pack("<i", 0)
        body += struct.pack(">ii", k, len(record) // 2) + record
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8) + body


def dbf(values):
    head = struct.pack("<4BIHH20x", 3, 1, 1, 1, len(values), 32 + 32 + 1, 11) + b"class_name\0C" + bytes(4) + bytes([10]) + bytes(15) + b"\r"
    return head + b"".join(b" " + v.encode("utf-8").ljust(10) for v in values)


def test_shapefile(spark, tmp_path):
    square = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (0.0, 0.0)]
    (tmp_path / "l.shp").write_bytes(shp([[square, square[::-1]], [], [square]]))
    (tmp_path / "l.dbf").write_bytes(dbf(["wheat", "none", "maïs"]))
    got = shapefile.read_shapefile(spark, str(tmp_path)).orderBy("fid").collect()
    assert [(r.fid, r.class_name, r.geometry_type, [len(x) for x in r.rings]) for r in got] == [(1, "wheat", "Polygon", [4, 4]), (3, "maïs", "Polygon", [4])]
    with pytest.raises(ValueError):
        shapefile.shapes(b"\0" * 200)


def test_reprojection_between_zones(spark):
    source = geo.Grid(60, 60, a=1000.0, c=690000.0, e=-1000.0, f=4130000.0, epsg=32635)
    cells = spark.range(3600).select((F.col("id") / 60).cast("int").alias("row"), (F.col("id") % 60).cast("int").alias("col"))
    x, y = source.to_ground(F.col("row"), F.col("col"))
    lon, lat = geo.transform(x, y, 32635, 4326)
    cells = cells.withColumns({"lon": lon, "lat": lat})
    corner = cells.where("row = 30 and col = 30").select(*[c.alias(n) for c, n in zip(geo.transform(F.col("lon"), F.col("lat"), 4326, 32636), "xy", strict=True)]).first()
    target = geo.Grid(8, 8, a=1000.0, c=corner.x - 4000, e=-1000.0, f=corner.y + 4000, epsg=32636)
    out = resample.reproject(cells, "lon", source, target)
    gx, gy = target.to_ground(F.col("row"), F.col("col"))
    want = geo.transform(gx, gy, 32636, 4326)[0]
    assert out.count() == 64 and out.select(F.max(F.abs(F.col("lon") - want))).first()[0] < 1e-5
    with pytest.raises(ValueError):
        geo.transform(F.lit(0.0), F.lit(0.0), 3857, 4326)


def test_selectors_and_mirrors(spark):
    rows = [("way", {"highway": "trunk_link"}), ("relation", {"highway": "trunk"}), ("relation", {"landuse": "orchard"}), ("way", {"landuse": "reservoir"}), ("relation", {"landuse": "reservoir"}), ("way", None)]
    df = spark.createDataFrame(rows, "kind string, tags map<string,string>")
    assert [r[0] for r in df.select(tags.selected(F.col("kind"), F.col("tags"))).collect()] == [True, False, True, True, False, False]
    answers = iter([b"<html>busy</html>", b'{"features": []}'])
    assert vector.fetch("q", lambda url, body: next(answers), lambda s: None) == '{"features": []}'
    assert "fieldloom" in vector.HEADERS["User-Agent"]


def test_missing_bands_and_scenes(spark):
    obs = spark.createDataFrame([(0, 0, 1, 1000.0, 3000.0, 4)], "row int, col int, scene int, red_dn double, nir_dn double, scl int")
    out = feature_stack(obs, 1, 1, [1], {"red": "red_dn", "swir1": "swir_dn"}, "red_dn", "nir_dn", spatial=False, temporal=False)
    assert {k: round(v, 9) for k, v in out.first().asDict().items()} == {"row": 0, "col": 0, "red_1": 0.1, "swir1_1": 0.0, "ndvi_1": 0.5}
    with pytest.raises(ValueError):
        feature_stack(obs.drop("nir_dn"), 1, 1, [1], {}, "red_dn", "nir_dn")
    with pytest.raises(ValueError):
        pixels.scene_list(obs.where("false"))
    files = spark.createDataFrame([("s", "B04", "p")], "scene string, band string, path string")
    assert catalogue.require_bands(files, ["s"], ["B04"]).count() == 1
    with pytest.raises(FileNotFoundError):
        catalogue.require_bands(files, ["s"], ["B04", "B08"])


def test_runner_keeps_a_table_at_all_times(spark, tmp_path):
    runner = Runner(str(tmp_path), {})
    runner.write("t", spark.range(3))
    runner.write("t", runner.table(spark, "t").where("id > 0"))
    assert runner.table(spark, "t").count() == 2 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_command_line(spark, tmp_path):
    rng = np.random.default_rng(8)
    h = w = 24
    red, nir = rng.integers(500, 1500, (h, w)), rng.integers(2000, 4000, (h, w))
    nir[:, 12:] = rng.integers(600, 1400, (h, 12))  # two halves that differ
    items = []
    for k, date in enumerate(("2024-04-03", "2024-05-03")):
        for band, image, step in (("B02", red, 10), ("B03", red, 10), ("B04", red, 10), ("B08", nir + k, 10), ("B11", nir[::2, ::2], 20), ("SCL", np.full((12, 12), 4), 20)):
            raster = tiff.Raster(np.asarray(image)[None].astype("uint16"), (600000.0, 4100000.0), (float(step), -float(step)), 32635)
            write_binary(spark.createDataFrame([(f"{date}/{band}.tif", bytearray(tiff.encode(raster)))], "file string, content binary"), str(tmp_path / "store"))
        assets = {b: {"href": f"{tmp_path}/store/{date}/{b}.tif"} for b in ("B02", "B03", "B04", "B08", "B11", "SCL")}
        items.append({"id": f"i{k}", "bbox": [30, 36, 31, 38], "properties": {"datetime": f"{date}T10:00:00Z", "eo:cloud_cover": 5}, "assets": assets})
        items.append({"id": f"c{k}", "bbox": [30, 36, 31, 38], "properties": {"datetime": f"{date}T11:00:00Z", "eo:cloud_cover": 15}, "assets": {}})
    (tmp_path / "items.json").write_text(json.dumps({"features": items}))
    ring = lambda c: [[{"x": 600000.0 + 10 * (c + a) + 1, "y": 4100000.0 - 10 * b - 1} for a, b in ((0, 1), (9, 1), (9, 22), (0, 22), (0, 1))]]
    truth = spark.createDataFrame([(1, "crop", ring(1)), (2, "soil", ring(13))], "fid long, class_name string, rings array<array<struct<x: double, y: double>>>")
    run = lambda *words: cli.main([str(x) for x in words], spark)
    args = ["run_pipeline", "--items", tmp_path / "items.json", "--window", "2024-04-01/2024-04-30", "--window", "2024-05-01/2024-05-31", "--scenes-dir", tmp_path / "scenes", "--output-dir", tmp_path / "out", "--ground-truth", tmp_path / "truth", "--trees", 5, "--deep-features", "--deep-components", 2]
    with pytest.raises(GateError):
        run(*args)
    truth.write.parquet(str(tmp_path / "truth"))
    run(*args, "--start-from", "classify")
    classes = {(r["row"], r["col"]): r.class_id for r in spark.read.parquet(str(tmp_path / "out/classified")).collect()}
    right = np.mean([classes[r, c] == (1 if c < 12 else 2) for r in range(h) for c in range(w)])
    assert len(classes) == h * w and right > 0.9
    assert sorted(p.name for p in (tmp_path / "out/weightmaps").iterdir()) == ["weightmap_crop.png", "weightmap_soil.png"]
    side = json.loads((tmp_path / "out/feature_stack_deep.json").read_text())
    assert side["features"][-2:] == ["deep_pca_00", "deep_pca_01"] and side["n_features"] == 2 * 7 + 5 + 2
    run("ndvi_stack", tmp_path / "scenes", tmp_path / "ndvi.tif", "--smooth", "savgol")
    run("classify", tmp_path / "ndvi.tif", tmp_path / "truth", tmp_path / "map", "--trees", 3)
    run("export_weightmaps", tmp_path / "map", tmp_path / "map.json", tmp_path / "masks", "--bit-depth", 16, "--target-size", 127)
    assert len(list((tmp_path / "masks").iterdir())) == 2
    answer = json.dumps({"features": [{"geometry": {"type": "LineString", "coordinates": [[28.1, 37.03], [28.11, 37.03]]}, "properties": {"tags": {"highway": "primary"}}}]})
    road = cli.osm_polygons(spark, answer, geo.Grid(h, w, epsg=32635), 8.0, 5).collect()
    assert len(road) == 1 and road[0].class_name == "non_agri" and len(road[0].rings) == 1
    with pytest.raises(GateError):
        run("download", tmp_path / "x", "--window", "2024-04-01/2024-04-30")
