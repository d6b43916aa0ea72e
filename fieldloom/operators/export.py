"""Class maps to masks: valid sizes, coverage, masks and grayscale PNG files."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .resample import resample_nearest

# Quads per side that a landscape may have; a side has one vertex more.
QUADS = (126, 252, 504, 1008, 2016, 4032, 8128)


def valid_size(pixels: Column) -> Column:
    """The least valid size of at least ``pixels``, else the largest."""
    sizes = F.array(*[F.lit(q + 1) for q in QUADS])
    return F.coalesce(F.array_min(F.filter(sizes, lambda s: s >= pixels)), F.lit(QUADS[-1] + 1))


def valid_size_of(pixels: int) -> int:
    return next((q + 1 for q in QUADS if q + 1 >= pixels), QUADS[-1] + 1)


def class_mask(class_id: Column, wanted: Column | int, bits: int = 8) -> Column:
    return F.when(class_id == wanted, (1 << bits) - 1).otherwise(0)


def coverage(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, class_name, percent): share of all cells; class 0 has no row but counts below the line."""
    counts = cells.groupBy("class_id").agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))  # one row
    joined = classes.join(counts, "class_id", "left").join(F.broadcast(total), F.lit(True), "left")
    return joined.select("class_id", "class_name", (F.lit(100.0).cast("double") * F.coalesce("__n", F.lit(0)) / F.col("__all")).alias("percent"))


def to_square(cells: DataFrame, size: tuple[int, int], target: int | None = None) -> DataFrame:
    """The class map stretched to the next valid square."""
    side = target or valid_size_of(max(size))
    return resample_nearest(cells, size, (side, side))


def gray_png(samples: np.ndarray) -> bytes:
    """A grayscale PNG of 8 or 16 bits per sample."""
    height, width = samples.shape
    bits = 16 if samples.dtype.itemsize == 2 else 8
    rows = samples.astype(">u2").view(np.uint8).reshape(height, -1) if bits == 16 else samples.astype(np.uint8)
    raw = np.hstack([np.zeros((height, 1), np.uint8), rows]).tobytes()

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, bits, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def file_name(class_name: str) -> str:
    return f"weightmap_{re.sub(r'[^A-Za-z0-9_.-]', '_', class_name)}.png"


def mask_images(square: DataFrame, classes: DataFrame, side: int, bits: int = 8) -> DataFrame:
    """(class_id, file, png): one image per class, also for classes without a cell.

    A task holds one mask of side x side samples; sides are at most 8129.
    """
    if bits not in (8, 16):
        raise ValueError("bits must be 8 or 16")

    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((side, side), np.uint16 if bits == 16 else np.uint8)
        own = pdf[pdf.row.notna()]
        image[own.row.astype(int), own.col.astype(int)] = (1 << bits) - 1
        return pd.DataFrame({"class_id": [int(pdf.class_id.iloc[0])], "file": [file_name(str(pdf.class_name.iloc[0]))], "png": [gray_png(image)]})

    held = classes.join(square.select("class_id", "row", "col"), "class_id", "left")
    return held.groupBy("class_id").applyInPandas(draw, "class_id int, file string, png binary")


def write_masks(images: DataFrame, path: str) -> None:
    """Write each image as a file below ``path`` through Hadoop, from the tasks that made them.

    One task writes one image's bytes; the driver sees names only.
    """
    from ..sources.files import write_binary

    write_binary(images.select("file", F.col("png").alias("content")), path)


