"""Band algebra.  NULL is the only missing value; codecs turn NaN into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data: bands and their names, scale, and scene classes that spoil a pixel.
BANDS = {"B02": "blue", "B03": "green", "B04": "red", "B08": "nir", "B11": "swir1", "B12": "swir2"}
SCALE = 10000.0
BAD_SCENE_CLASSES = (0, 1, 3, 8, 9, 10, 11)
BAND_EXTENSIONS = (".jp2", ".tif", ".tiff")
RGB = ("B04", "B03", "B02")


def ndvi(red: Column, nir: Column) -> Column:
    """(nir - red) / (nir + red); NULL where the sum is 0."""
    return (nir - red) / F.nullif(nir + red, F.lit(0.0))


def reflectance(dn: Column) -> Column:
    return dn / F.lit(SCALE)


def is_bad(scl: Column) -> Column:
    """Cloud, shadow, snow and the like; a missing class is not bad."""
    return F.coalesce(scl.isin(*BAD_SCENE_CLASSES), F.lit(False))


def masked(value: Column, bad: Column) -> Column:
    return F.when(~bad, value)


def no_nan(value: Column) -> Column:
    """NaN becomes NULL: the rule at every scan boundary."""
    return F.when(~F.isnan(value), value)


def nearest_cell(place: Column, source: int | Column, target: int | Column) -> Column:
    """Source index of a target cell: floor((place + 0.5) * source / target)."""
    source = source if isinstance(source, Column) else F.lit(source)
    target = target if isinstance(target, Column) else F.lit(target)
    return F.floor((place + 0.5) * source / target).cast("int")
