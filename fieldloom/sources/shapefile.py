"""Shapefile layers: geometry from .shp, the class from the .dbf beside it."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.vectors import RINGS
from .files import read_binary

# Shape types of lines and polygons, plain and with further dimensions.
KINDS = {3: "LineString", 13: "LineString", 23: "LineString", 5: "Polygon", 15: "Polygon", 25: "Polygon"}
MAGIC = 9994


def shapes(content: bytes) -> list[tuple[int, str | None, list[list[tuple[float, float]]]]]:
    """(number, kind, rings or lines) of every record; empty shapes have no kind."""
    if struct.unpack_from(">i", content)[0] != MAGIC:
        raise ValueError("not a shapefile")
    out, at = [], 100
    while at + 12 <= len(content):
        number, words = struct.unpack_from(">ii", content, at)
        (kind,) = struct.unpack_from("<i", content, at + 8)
        rings: list[list[tuple[float, float]]] = []
        if kind in KINDS:
            parts, points = struct.unpack_from("<ii", content, at + 44)
            first = [*struct.unpack_from(f"<{parts}i", content, at + 52), points]
            flat = struct.unpack_from(f"<{2 * points}d", content, at + 52 + 4 * parts)
            rings = [[(flat[2 * k], flat[2 * k + 1]) for k in range(a, b)] for a, b in zip(first[:-1], first[1:], strict=True)]
        elif kind:
            raise ValueError(f"shape type {kind}")
        out.append((number, KINDS.get(kind), rings))
        at += 8 + 2 * words
    return out


def attribute(content: bytes, name: str) -> list[str | None]:
    """The values of one field as text; None without the field, for blanks and in deleted rows."""
    rows, head, size = struct.unpack_from("<IHH", content, 4)
    at, place, found = 32, 1, None
    while content[at] != 0x0D:
        field = content[at : at + 11].split(b"\0")[0].decode("latin-1")
        if field.lower() == name.lower()[:10]:
            found = (place, content[at + 16])
        place += content[at + 16]
        at += 32
    out: list[str | None] = []
    for k in range(rows):
        row = content[head + k * size : head + (k + 1) * size]
        text = None
        if found and row[:1] != b"*":
            raw = row[found[0] : found[0] + found[1]]
            try:
                text = raw.decode("utf-8").strip()
            except UnicodeDecodeError:
                text = raw.decode("latin-1").strip()
        out.append(text or None)
    return out


def read_shapefile(spark: SparkSession, path: str, class_field: str = "class_name") -> DataFrame:
    """(fid, class_name, geometry_type, rings) of all layers below a path; empty shapes are left out."""
    files = read_binary(spark, path, "*.{shp,dbf}").withColumn("layer", F.regexp_replace("path", r"\.[^.]*$", ""))
    of = lambda end: F.max(F.when(F.endswith("path", F.lit(end)), F.col("content"))).alias(end[1:])
    layers = files.groupBy("layer").agg(of(".shp"), of(".dbf"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shp, dbf in zip(pdf["shp"], pdf["dbf"], strict=True):
                if shp is None:
                    continue
                own = shapes(bytes(shp))
                names = attribute(bytes(dbf), class_field) if dbf is not None else []
                names += [None] * (len(own) - len(names))
                rows = [(n, name, kind, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for (n, kind, rings), name in zip(own, names, strict=False) if kind]
                yield pd.DataFrame(rows, columns=["fid", "class_name", "geometry_type", "rings"])

    return layers.mapInPandas(run, f"fid long, class_name string, geometry_type string, rings {RINGS}")
