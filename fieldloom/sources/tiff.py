"""TIFF rasters: a numpy codec, and readers and writers of pixel rows.

Baseline and tiled files, classic and with 64-bit offsets, bands interleaved by pixel or by plane, raw
or deflate, predictors 1 to 3, integer and float samples.  Written files are float32 or integer, deflate, one strip per band block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_binary, write_binary

_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
# Tag numbers.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317
TILE_W, TILE_H, TILE_AT, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, METADATA, NODATA = 33550, 33922, 34735, 42112, 42113


class TiffError(ValueError):
    """The file breaks the format, or uses what this codec does not read."""


@dataclass
class Raster:
    """samples (bands, height, width), ground position of the upper left corner, pixel size, and names."""

    samples: np.ndarray
    origin: tuple[float, float] = (0.0, 0.0)
    pixel: tuple[float, float] = (1.0, 1.0)
    epsg: int | None = None
    nodata: float | None = None
    names: list[str] = field(default_factory=list)


def _tags(data: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and tags of the first image, of a classic file or one with 64-bit offsets."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    version = struct.unpack_from(order + "H", data, 2)[0] if order else 0
    if version not in (42, 43):
        raise TiffError("not a TIFF file")
    place, number, step, inline = ("I", "H", 12, 4) if version == 42 else ("Q", "Q", 20, 8)
    (at,) = struct.unpack_from(order + place, data, 4 if version == 42 else 8)
    (count,) = struct.unpack_from(order + number, data, at)
    at += struct.calcsize(order + number)
    out = {}
    for k in range(count):
        tag, kind, n = struct.unpack_from(f"{order}HH{place}", data, at + step * k)
        if kind not in _TYPES:
            continue
        spot = at + step * k + 4 + inline
        if _SIZES[kind] * n > inline:
            (spot,) = struct.unpack_from(order + place, data, spot)
        if kind == 2:
            out[tag] = (data[spot : spot + n].rstrip(b"\0").decode("utf-8", "replace"),)
        else:
            out[tag] = struct.unpack_from(order + f"{n * len(_TYPES[kind])}{_TYPES[kind][0]}", data, spot)
    return order, out


def _undo(block: np.ndarray, predictor: int, dtype: np.dtype, width: int, samples: int) -> np.ndarray:
    """Reverse a predictor on rows of bytes."""
    rows = block.reshape(-1, width * samples * dtype.itemsize)
    if predictor == 3:
        x = rows.reshape(len(rows), -1, samples)
        x = np.cumsum(x, axis=1, dtype=np.uint8).reshape(len(rows), dtype.itemsize, width * samples)
        return np.ascontiguousarray(x.transpose(0, 2, 1)).view(dtype.newbyteorder(">")).reshape(len(rows), width, samples).astype(dtype)
    values = rows.copy().view(dtype).reshape(len(rows), width, samples)
    if predictor == 2:
        whole = values.astype(dtype.newbyteorder("="))
        return np.cumsum(whole, axis=1, dtype=whole.dtype)
    if predictor != 1:
        raise TiffError(f"predictor {predictor}")
    return values


@dataclass
class Profile:
    """What a file says about itself, without its samples."""

    width: int
    height: int
    bands: int
    dtype: np.dtype
    origin: tuple[float, float]
    pixel: tuple[float, float]
    epsg: int | None
    nodata: float | None
    names: list[str]


def profile(data: bytes, found: tuple[str, dict[int, tuple]] | None = None) -> Profile:
    """From the tags alone; nothing is decompressed."""
    order, tag = found or _tags(data)
    one = lambda k, default=None: tag.get(k, (default,))[0]
    bits, kind = one(BITS, 1), {1: "u", 2: "i", 3: "f"}.get(one(FORMAT, 1))
    if kind is None or bits not in (8, 16, 32, 64):
        raise TiffError(f"{bits}-bit samples of format {one(FORMAT)}")
    scale, tie, keys = tag.get(PIXEL_SCALE, (1.0, 1.0, 0.0)), tag.get(TIE_POINT, (0.0,) * 6), tag.get(GEO_KEYS, ())
    epsg = next((keys[i + 3] for i in range(4, len(keys), 4) if keys[i] in (3072, 2048)), None)
    bands = one(SAMPLES, 1)
    return Profile(
        one(WIDTH), one(HEIGHT), bands, np.dtype(f"{order}{kind}{bits // 8}"), (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]),
        (scale[0], -scale[1]), epsg, float(one(NODATA)) if NODATA in tag else None, _names(one(METADATA, ""), bands),
    )


def decode(data: bytes, window: tuple[int, int, int, int] | None = None) -> Raster:
    """A file's samples, or those of a window (row, col, height, width): only blocks that meet it are decompressed."""
    order, tag = _tags(data)
    own = profile(data, (order, tag))
    one = lambda k, default=None: tag.get(k, (default,))[0]
    width, height, bands, dtype = own.width, own.height, own.bands, own.dtype
    packing, predictor, planar = one(COMPRESSION, 1), one(PREDICTOR, 1), one(PLANAR, 1) == 2
    if packing not in (1, 8, 32946):
        raise TiffError(f"compression {packing}")
    per_block = 1 if planar else bands
    if TILE_AT in tag:
        bw, bh, places, sizes = one(TILE_W), one(TILE_H), tag[TILE_AT], tag[TILE_COUNTS]
    else:
        bw, bh, places, sizes = width, min(one(ROWS, height), height), tag[STRIPS], tag[COUNTS]
    across, down = -(-width // bw), -(-height // bh)
    r0, c0, tall, wide = window or (0, 0, height, width)
    r0, c0, r1, c1 = max(0, r0), max(0, c0), min(height, r0 + tall), min(width, c0 + wide)
    out = np.zeros((bands, max(0, r1 - r0), max(0, c1 - c0)), dtype.newbyteorder("="))
    for k, (place, size) in enumerate(zip(places, sizes, strict=True)):
        plane, spot = divmod(k, across * down)
        r, c = (spot // across) * bh, (spot % across) * bw
        top, left, bottom, right = max(r, r0), max(c, c0), min(r + bh, r1), min(c + bw, c1)
        if top >= bottom or left >= right:
            continue
        raw = data[place : place + size]
        raw = zlib.decompress(raw) if packing != 1 else raw
        lines = bh if TILE_AT in tag else min(bh, height - r)
        block = _undo(np.frombuffer(raw, np.uint8)[: lines * bw * per_block * dtype.itemsize], predictor, dtype, bw, per_block)
        target = slice(plane, plane + 1) if planar else slice(0, bands)
        out[target, top - r0 : bottom - r0, left - c0 : right - c0] = block[top - r : bottom - r, left - c : right - c].transpose(2, 0, 1)
    return Raster(out, own.origin, own.pixel, own.epsg, own.nodata, own.names)


def _names(text: str, bands: int) -> list[str]:
    import xml.etree.ElementTree as ET

    out = [""] * bands
    if text.strip().startswith("<"):
        for item in ET.fromstring(text).iter("Item"):
            if item.get("role") == "description" and int(item.get("sample", -1)) < bands:
                out[int(item.get("sample"))] = item.text or ""
    return out


def encode(raster: Raster, predictor: int | None = None, rows: int = 256) -> bytes:
    """A little-endian file, bands by plane, deflate strips of ``rows`` lines."""
    from xml.sax.saxutils import escape

    x = raster.samples
    bands, height, width = x.shape
    dtype = x.dtype.newbyteorder("<")
    predictor = predictor or (3 if x.dtype.kind == "f" else 1)
    strips = []
    for b in range(bands):
        for r in range(0, height, rows):
            part = np.ascontiguousarray(x[b, r : r + rows].astype(dtype))
            if predictor == 3:
                parts = np.ascontiguousarray(part.astype(dtype.newbyteorder(">"))).view(np.uint8).reshape(len(part), width, -1).transpose(0, 2, 1).reshape(len(part), -1)
                raw = np.diff(parts, axis=1, prepend=np.zeros((len(part), 1), np.uint8)).astype(np.uint8)
            elif predictor == 2:
                raw = np.diff(part.astype(x.dtype), axis=1, prepend=np.zeros((len(part), 1), x.dtype)).astype(dtype)
            else:
                raw = part
            strips.append(zlib.compress(np.ascontiguousarray(raw).tobytes()))
    entries: list[tuple[int, int, bytes]] = []
    put = lambda tag, kind, *v: entries.append((tag, kind, struct.pack(f"<{len(v)}{_TYPES[kind][0]}", *v)))
    body, places = bytearray(), []
    for s in strips:
        places.append(8 + len(body))
        body += s
    bits, form = x.dtype.itemsize * 8, {"u": 1, "i": 2, "f": 3}[x.dtype.kind]
    put(WIDTH, 4, width), put(HEIGHT, 4, height), put(BITS, 3, *[bits] * bands), put(COMPRESSION, 3, 8), put(PHOTOMETRIC, 3, 1)
    put(STRIPS, 4, *places), put(SAMPLES, 3, bands), put(ROWS, 4, rows), put(COUNTS, 4, *map(len, strips)), put(PLANAR, 3, 2)
    put(PREDICTOR, 3, predictor), put(FORMAT, 3, *[form] * bands)
    put(PIXEL_SCALE, 12, raster.pixel[0], -raster.pixel[1], 0.0), put(TIE_POINT, 12, 0.0, 0.0, 0.0, raster.origin[0], raster.origin[1], 0.0)
    if raster.epsg:
        put(GEO_KEYS, 3, 1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, raster.epsg)
    if any(raster.names):
        items = "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{escape(n)}</Item>' for i, n in enumerate(raster.names))
        entries.append((METADATA, 2, f"<GDALMetadata>{items}</GDALMetadata>".encode() + b"\0"))
    if raster.nodata is not None:
        entries.append((NODATA, 2, f"{raster.nodata:g}".encode() + b"\0"))
    entries.sort()
    at = 8 + len(body) + (len(body) & 1)
    head, extra = bytearray(struct.pack("<H", len(entries))), bytearray()
    base = at + 2 + 12 * len(entries) + 4
    for tag, kind, raw in entries:
        n = len(raw) // _SIZES[kind]
        if len(raw) <= 4:
            head += struct.pack("<HHI", tag, kind, n) + raw.ljust(4, b"\0")
        else:
            head += struct.pack("<HHII", tag, kind, n, base + len(extra))
            extra += raw + b"\0" * (len(raw) & 1)
    return struct.pack("<2sHI", b"II", 42, at) + bytes(body) + b"\0" * (len(body) & 1) + bytes(head) + struct.pack("<I", 0) + bytes(extra)


def read_pixels(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None, bands: list[int] | None = None, block: int = 1 << 18) -> DataFrame:
    """(path, band, name, row, col, value) of all TIFF files below a path; NaN and nodata are NULL.

    ``window`` is (row, col, height, width), of which only the blocks are decompressed; bands count from 1.
    A task decodes one file at a time and hands out blocks of pixels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raster = decode(content.as_buffer().to_pybytes(), window)
                r0, c0 = (max(0, x) for x in (window or (0, 0))[:2])
                for b in bands or range(1, len(raster.samples) + 1):
                    part = raster.samples[b - 1].astype(np.float64)
                    lines = max(1, block // max(1, part.shape[1]))
                    for r in range(0, part.shape[0], lines):
                        own = part[r : r + lines]
                        flat = own.ravel()
                        none = np.isnan(flat) | ((flat == raster.nodata) if raster.nodata is not None else False)
                        rr, cc = np.divmod(np.arange(flat.size), own.shape[1])
                        n = flat.size
                        yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.full(n, b, np.int32)), pa.array([raster.names[b - 1]] * n), pa.array((rr + r + r0).astype(np.int32)), pa.array((cc + c0).astype(np.int32)), pa.array(flat, mask=none)], ["path", "band", "name", "row", "col", "value"])

    return read_binary(spark, path, "*.{tif,tiff}").mapInArrow(run, "path string, band int, name string, row int, col int, value double")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, bands, dtype, epsg, x0, y0, dx, dy, nodata, names) from the tags; no sample is decompressed."""
    names = ["path", "width", "height", "bands", "dtype", "epsg", "x0", "y0", "dx", "dy", "nodata", "names"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                p = profile(bytes(content))
                rows.append((name, p.width, p.height, p.bands, p.dtype.name, p.epsg, *p.origin, *p.pixel, p.nodata, p.names))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"epsg": "Int32", "nodata": "Float64"})

    return read_binary(spark, path, "*.{tif,tiff}").mapInPandas(run, "path string, width int, height int, bands int, dtype string, epsg int, x0 double, y0 double, dx double, dy double, nodata double, names array<string>")


def write_rasters(pixels: DataFrame, folder: str, height: int, width: int, bands: list[str], file_col: str = "file", dtype: str = "float32", origin: tuple[float, float] = (0.0, 0.0), pixel: tuple[float, float] = (1.0, 1.0), epsg: int | None = None) -> int:
    """One file per value of ``file_col`` with the named columns as bands; NULL is NaN, or 0 for integers.

    A task holds one file's bands.  Larger rasters are written as one file per tile.
    """
    kind = np.dtype(dtype)

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.full((len(bands), height, width), np.nan if kind.kind == "f" else 0, kind)
        for k, b in enumerate(bands):
            value = pdf[b].to_numpy(float)
            image[k, pdf.row, pdf.col] = value if kind.kind == "f" else np.nan_to_num(value).astype(kind)
        content = encode(Raster(image, origin, pixel, epsg, None, bands))
        return pd.DataFrame({"file": [str(pdf[file_col].iloc[0])], "content": [content]})

    files = pixels.select(F.col(file_col), "row", "col", *bands).groupBy(file_col).applyInPandas(draw, "file string, content binary")
    return write_binary(files, folder)
