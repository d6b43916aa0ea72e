"""Vector layers: GeoPackage files (SQLite), GeoJSON features, sidecars and the map service."""

from __future__ import annotations

import json
import sqlite3
import struct
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tags import tag_class
from ..operators.vectors import RINGS
from .files import read_binary

_HEADER = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
GEOJSON = "features array<struct<geometry: struct<type: string, coordinates: string>, properties: struct<tags: map<string,string>>>>"
# Public mirrors of the map service, and its retry rule.
MIRRORS = ("https://overpass-api.de/api/interpreter", "https://overpass.kumi.systems/api/interpreter", "https://maps.mail.ru/osm/tools/overpass/api/interpreter")
TRIES, FIRST_WAIT = 3, 5.0
#: The service refuses callers that do not say who they are.
HEADERS = {"User-Agent": "fieldloom/0.2 (label bootstrap)", "Accept": "application/json"}


def _wkb(data: bytes, at: int = 0) -> tuple[list[list[tuple[float, float]]], str, int]:
    """Rings (or lines) of a polygon, multipolygon or line; extra dimensions are dropped."""
    order = "<" if data[at] else ">"
    (code,) = struct.unpack_from(order + "I", data, at + 1)
    flags, code = code & 0xE0000000, code & 0x0FFFFFFF
    dims = 2 + (1 if code // 1000 in (1, 2) else 2 if code // 1000 == 3 else 0) + bool(flags & 0x80000000) + bool(flags & 0x40000000)
    code, at = code % 1000, at + 5 + (4 if flags & 0x20000000 else 0)

    def line(at: int) -> tuple[list[tuple[float, float]], int]:
        (n,) = struct.unpack_from(order + "I", data, at)
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at + 4)
        return [(flat[i * dims], flat[i * dims + 1]) for i in range(n)], at + 4 + 8 * n * dims

    if code == 2:
        points, at = line(at)
        return [points], "LineString", at
    (n,) = struct.unpack_from(order + "I", data, at)
    at, rings, kind = at + 4, [], {3: "Polygon", 5: "MultiLineString", 6: "MultiPolygon"}.get(code)
    if kind is None:
        raise ValueError(f"geometry type {code}")
    for _ in range(n):
        if code == 3:
            ring, at = line(at)
            rings.append(ring)
        else:
            more, _, at = _wkb(data, at)
            rings += more
    return rings, kind, at


def polygon_wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    return out


def _layer(content: bytes, class_field: str) -> list[tuple]:
    db = sqlite3.connect(":memory:")
    db.deserialize(content)
    rows = []
    for name, column, srs in db.execute("select table_name, column_name, srs_id from gpkg_geometry_columns order by table_name"):
        quoted = '"' + name.replace('"', '""') + '"'
        fields = [r[1] for r in db.execute(f"pragma table_info({quoted})")]
        key = next((r[1] for r in db.execute(f"pragma table_info({quoted})") if r[5]), None)
        label = f'"{class_field}"' if class_field in fields else "null"
        for fid, cls, blob in db.execute(f'select {f"{key!r}".replace(chr(39), chr(34)) if key else "rowid"}, {label}, "{column}" from {quoted} order by 1'):
            if blob and blob[:2] == b"GP" and not blob[3] & 16:
                rings, kind, _ = _wkb(blob, 8 + _HEADER[blob[3] >> 1 & 7])
                rows.append((int(fid), None if cls is None else str(cls), kind, int(srs), [[{"x": x, "y": y} for x, y in r] for r in rings]))
    return rows


def read_geopackage(spark: SparkSession, path: str, class_field: str = "class_name") -> DataFrame:
    """(fid, class_name, geometry_type, srid, rings) of all layers, from any store; empty geometries are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                yield pd.DataFrame(_layer(bytes(content), class_field), columns=["fid", "class_name", "geometry_type", "srid", "rings"])

    return read_binary(spark, path, "*.gpkg").mapInPandas(run, f"fid long, class_name string, geometry_type string, srid int, rings {RINGS}")


def write_geopackage(polygons: DataFrame, path: str, srid: int, most: int = 1_000_000) -> None:
    """Write a layer of at most ``most`` polygons from the driver (the format is one SQLite file)."""
    rows = polygons.select("fid", "class_name", "rings").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} polygons: write Parquet instead")
    db = sqlite3.connect(path)
    with db:
        db.execute("pragma application_id = 1196444487")
        db.execute("create table gpkg_spatial_ref_sys (srs_name text, srs_id integer primary key, organization text, organization_coordsys_id integer, definition text, description text)")
        db.execute("create table gpkg_contents (table_name text primary key, data_type text, identifier text, srs_id integer)")
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id integer, z integer, m integer)")
        db.execute("create table labels (fid integer primary key, class_name text, geom blob)")
        db.execute("insert into gpkg_spatial_ref_sys values ('', ?, 'EPSG', ?, '', '')", (srid, srid))
        db.execute("insert into gpkg_contents values ('labels', 'features', 'labels', ?)", (srid,))
        db.execute("insert into gpkg_geometry_columns values ('labels', 'geom', 'POLYGON', ?, 0, 0)", (srid,))
        head = b"GP" + struct.pack("<BBi", 0, 1, srid)
        db.executemany("insert into labels values (?, ?, ?)", [(r["fid"], r["class_name"], head + polygon_wkb([[(p["x"], p["y"]) for p in ring] for ring in r["rings"]])) for r in rows])
    db.close()


def features(collections: DataFrame, column: str = "value") -> DataFrame:
    """Flatten GeoJSON texts: (class_name, geometry_type, rings, is_road); unclassified and empty ones go."""
    parsed = F.from_json(F.col(column), GEOJSON)
    rows = collections.select(F.explode(parsed["features"]).alias("f"))
    point = lambda c: F.transform(c, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    line = F.from_json(text, "array<array<double>>")
    polygon = F.from_json(text, "array<array<array<double>>>")
    multi = F.from_json(text, "array<array<array<array<double>>>>")
    rings = (
        F.when(kind == "LineString", F.array(point(line)))
        .when(kind.isin("Polygon", "MultiLineString"), F.transform(polygon, point))
        .when(kind == "MultiPolygon", F.transform(F.flatten(multi), point))
    )
    tags = F.col("f.properties.tags")
    out = rows.select(tag_class(tags).alias("class_name"), kind.alias("geometry_type"), rings.alias("rings"), F.coalesce(F.length(F.try_element_at(tags, F.lit("highway"))) > 0, F.lit(False)).alias("is_road"))
    return out.where(F.col("class_name").isNotNull() & (F.coalesce(F.size(F.flatten("rings")), F.lit(0)) > 0))


def read_legend(spark: SparkSession, path: str) -> DataFrame:
    """(class_id, class_name) of a JSON sidecar that maps ids as text to names."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "class_name")).select(F.col("k").cast("int").alias("class_id"), "class_name")


def legend_json(classes: DataFrame) -> DataFrame:
    """One row with the sidecar's JSON; a legend has a row per class."""
    entries = F.sort_array(F.collect_list(F.struct("class_id", "class_name")))
    return classes.agg(F.to_json(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["class_id"].cast("string"), e["class_name"])))).alias("json"))


def sidecar_json(names: list[str], scenes: list) -> str:
    return json.dumps({"features": names, "n_features": len(names), "band_dates": [str(s) for s in scenes]}, indent=2)


def fetch(query: str, send: Callable[[str, bytes], bytes] | None = None, wait: Callable[[float], None] = time.sleep, mirrors: tuple[str, ...] = MIRRORS) -> str:
    """Ask the mirrors in turn, each up to three times with doubled waits; the answer as text, which is JSON."""

    def post(url: str, body: bytes) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, body, HEADERS), timeout=300) as answer:
            return answer.read()

    body, last = urllib.parse.urlencode({"data": query}).encode(), None
    for url in mirrors:
        for k in range(TRIES):
            try:
                text = (send or post)(url, body).decode("utf-8")
                json.loads(text)
                return text
            except (urllib.error.URLError, OSError, ValueError) as e:
                last = e
                if k + 1 < TRIES:
                    wait(FIRST_WAIT * 2**k)
    raise RuntimeError(f"no mirror answered: {last}")
