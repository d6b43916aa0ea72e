"""Media columns: texts as grayscale PNG in a binary column, read back, checked and hashed.

The payload is the text's UTF-8 bytes, padded with zero bytes to a positive multiple of 64, as the
8-bit samples of an image 64 pixels wide.  The reader tests every chunk's checksum, inflates the
IDAT chunks one by one and reverses the scanline filters with numpy.  The feature is a hash of the
image's low-frequency cosine-transform coefficients.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_slices

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: A private ancillary chunk with the length before padding.
LENGTH_CHUNK = b"fnBy"
IDAT_BYTES = 1 << 15


class MediaError(ValueError):
    """The stored bytes are not a PNG that this module reads, or are damaged."""


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(payload: bytes, n_bytes: int, level: int = 3) -> bytes:
    """A PNG of the payload's samples; each line takes the filter None, Sub or Up with the least sum."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.empty((3, *image.shape), np.uint8)
    lines[0] = image
    lines[1, :, 0], lines[1, :, 1:] = image[:, 0], image[:, 1:] - image[:, :-1]
    lines[2, 0], lines[2, 1:] = image[0], image[1:] - image[:-1]
    weight = np.abs(lines.view(np.int8).astype(np.int16)).sum(2)
    kind = weight.argmin(0)
    filtered = np.empty((len(image), WIDTH + 1), np.uint8)
    filtered[:, 0] = kind
    filtered[:, 1:] = lines[kind, np.arange(len(image))]
    packed = zlib.compress(filtered.tobytes(), level)
    header = struct.pack(">IIBBBBB", WIDTH, len(image), 8, 0, 0, 0, 0)
    data = b"".join(_chunk(b"IDAT", packed[i : i + IDAT_BYTES]) for i in range(0, len(packed), IDAT_BYTES))
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(LENGTH_CHUNK, struct.pack(">Q", n_bytes)) + data + _chunk(b"IEND", b"")


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Reverse PNG filters of 8-bit one-channel lines (a leading filter byte each)."""
    kind, out = lines[:, 0], lines[:, 1:].copy()
    if kind.size and kind.max() > 4:
        raise MediaError("unknown filter type")
    sub = kind == 1
    if sub.any():
        out[sub] = np.cumsum(out[sub], axis=1, dtype=np.uint8)
    hard = np.flatnonzero(kind >= 3)
    start = 0
    for stop in [*hard, len(out)]:
        _undo_up(kind[start:stop], out, start)
        if stop < len(out):
            _undo_hard(int(kind[stop]), out, stop)
        start = stop + 1
    return out


def _undo_up(kind: np.ndarray, out: np.ndarray, start: int) -> None:
    """Up lines add the line above: differences of running sums from the last line of another type."""
    up = kind == 2
    if not up.any():
        return
    part = out[start : start + len(kind)]
    if up[0] and start:
        part[0] += out[start - 1]
    first = ~up
    first[0] = True
    sums = np.cumsum(part, axis=0, dtype=np.uint8)
    origin = np.maximum.accumulate(np.where(first, np.arange(len(kind)), 0))
    before = np.vstack([np.zeros((1, part.shape[1]), np.uint8), sums[:-1]])[origin]
    part[:] = sums - before


def _undo_hard(kind: int, out: np.ndarray, row: int) -> None:
    """Average and Paeth depend on the pixel to the left, so these lines go pixel by pixel."""
    line = out[row].tolist()
    above = out[row - 1].tolist() if row else [0] * len(line)
    left = corner = 0
    for i, up in enumerate(above):
        if kind == 3:
            guess = (left + up) >> 1
        else:
            estimate = left + up - corner
            a, b, c = abs(estimate - left), abs(estimate - up), abs(estimate - corner)
            guess = left if a <= b and a <= c else up if b <= c else corner
        left, corner = (line[i] + guess) & 255, up
        line[i] = left
    out[row] = line


def decode_png(data: bytes) -> tuple[np.ndarray, int]:
    """(samples by line, unpadded length); raises :class:`MediaError` on any damage."""
    if data[:8] != SIGNATURE:
        raise MediaError("no PNG signature")
    at, header, n_bytes, inflate, raw, ended = 8, None, None, zlib.decompressobj(), [], False
    while at < len(data) and not ended:
        if at + 12 > len(data):
            raise MediaError("truncated chunk")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) < size or at + 12 + size > len(data) or struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise MediaError(f"checksum of chunk {kind!r}")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == LENGTH_CHUNK:
            (n_bytes,) = struct.unpack(">Q", body)
        elif kind == b"IDAT":
            try:
                raw.append(inflate.decompress(body))
            except zlib.error as e:
                raise MediaError(f"IDAT: {e}") from e
        elif kind == b"IEND":
            ended = True
        elif not kind[0] & 32:
            raise MediaError(f"critical chunk {kind!r}")
        at += 12 + size
    if not ended or header is None or not inflate.eof:
        raise MediaError("incomplete image")
    width, height, depth, colour, *methods = header
    if (depth, colour, *methods) != (8, 0, 0, 0, 0):
        raise MediaError("not an 8-bit grayscale image without interlace")
    lines = np.frombuffer(b"".join(raw), np.uint8)
    if lines.size != height * (width + 1):
        raise MediaError("wrong amount of samples")
    image = unfilter(lines.reshape(height, width + 1))
    return image, image.size if n_bytes is None else n_bytes


@functools.cache
def _cosines(n: int, k: int) -> np.ndarray:
    x = (np.arange(n) + 0.5) * np.pi / n
    return np.cos(np.arange(k)[:, None] * x[None, :])


def cosine_hash(image: np.ndarray, grid: int = 32, keep: int = 8) -> str:
    """64 bits as hex: signs against the median of the keep x keep lowest coefficients of a grid x grid reduction."""
    rows, cols = image.shape
    if rows >= grid:
        cut = (np.arange(grid) * rows) // grid
        small = np.add.reduceat(image, cut, axis=0, dtype=np.float64) / np.diff([*cut, rows])[:, None]
    else:
        small = image[(np.arange(grid) * rows) // grid].astype(np.float64)
    cut = (np.arange(grid) * cols) // grid
    small = np.add.reduceat(small, cut, axis=1) / np.diff([*cut, cols])[None, :]
    basis = _cosines(grid, keep)
    low = np.round(basis @ small @ basis.T, 6).ravel()
    bits = low > np.median(low[1:])
    return np.packbits(bits).tobytes().hex()


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 3) -> DataFrame:
    """(id, media): each row's whole text as PNG in a binary column; null is the empty text."""
    kind = docs.select(id_col).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, "__text"):
            raw = data.tobytes()
            media = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                size = max(64, -(-(b - a) // 64) * 64)
                media.append(encode_png(raw[a:b].ljust(size, b"\0"), b - a, level))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(media, pa.binary())], [id_col, "media"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(encode, f"`{id_col}` {kind[0].dataType.simpleString()}, media binary")


def read_media(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Read stored images back: (id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, rows).

    A null image gives null results; a damaged one fails the query with the reason.
    """
    kind = media.select(id_col).schema
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "image_rows"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for cell in batch.column(1):
                data = cell.as_py()
                if data is None:
                    rows.append((None,) * len(names))
                    continue
                image, n = decode_png(data)
                payload = image.tobytes()
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(image), len(image)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], [id_col, *names])

    schema = f"`{id_col}` {kind[0].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, image_rows int"
    return media.select(id_col, media_col).mapInArrow(decode, schema)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as an image and read it back; one row per row of ``docs``.

    A null text is the empty text, whose payload is 64 zero bytes.  Equal texts give equal values,
    repeated rows and null ids stay, other columns are ignored, an empty table gives an empty one.
    """
    with Scratch(docs.sparkSession, "media") as scratch:
        return scratch.result(read_media(to_media(docs, id_col, text_col), id_col))
