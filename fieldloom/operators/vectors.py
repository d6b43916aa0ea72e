"""Vector layers on pixels: rows (fid, class_name, rings) with rings as arrays of (x, y) points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RINGS = "array<array<struct<x: double, y: double>>>"


def edges(polygons: DataFrame) -> DataFrame:
    """(fid, x0, y0, x1, y1): one row per ring segment."""
    rings = polygons.select("fid", F.explode("rings").alias("ring"))
    pairs = F.arrays_zip(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1)).alias("e")
    flat = rings.where(F.size("ring") > 1).select("fid", F.explode(pairs).alias("e"))
    return flat.select("fid", F.col("e.0.x").alias("x0"), F.col("e.0.y").alias("y0"), F.col("e.1.x").alias("x1"), F.col("e.1.y").alias("y1"))


def extent(polygons: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(xmin, ymin, xmax, ymax) of all points, by group if asked."""
    points = polygons.select(*by, F.explode(F.flatten("rings")).alias("p"))
    return points.groupBy(*by).agg(F.min("p.x").alias("xmin"), F.min("p.y").alias("ymin"), F.max("p.x").alias("xmax"), F.max("p.y").alias("ymax"))


def cover(polygons: DataFrame, cells: DataFrame, block: int = 64) -> DataFrame:
    """(fid, row, col) of the cells whose centres (x, y) lie in a polygon, holes left out.

    Polygons go to the blocks that their boxes touch, cells to their block; an equi-join on blocks
    comes before the crossing-number test, so no pair outside a common block is looked at.
    """
    boxes = extent(polygons, ("fid",))
    reach = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / block).cast("int"), F.floor(F.col(hi) / block).cast("int")))
    home = boxes.withColumn("__bx", reach("xmin", "xmax")).withColumn("__by", reach("ymin", "ymax")).select("fid", "__bx", "__by")
    segments = edges(polygons).where("y0 <> y1").join(home, "fid")
    # A segment matters to the blocks that its y range touches and that do not lie right of it.
    segments = segments.where((F.least("y0", "y1") < (F.col("__by") + 1) * block) & (F.greatest("y0", "y1") >= F.col("__by") * block) & (F.greatest("x0", "x1") >= F.col("__bx") * block))
    placed = cells.select("row", "col", "x", "y", F.floor(F.col("x") / block).cast("int").alias("__bx"), F.floor(F.col("y") / block).cast("int").alias("__by"))
    crosses = ((F.col("y0") > F.col("y")) != (F.col("y1") > F.col("y"))) & (F.col("x") < F.col("x0") + (F.col("y") - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0")))
    hits = placed.join(segments, ["__bx", "__by"]).where(crosses)
    return hits.groupBy("fid", "row", "col").agg(F.count("*").alias("__n")).where(F.col("__n") % 2 == 1).select("fid", "row", "col")


def rasterize(polygons: DataFrame, cells: DataFrame, classes: DataFrame) -> DataFrame:
    """(row, col, class_id): the last polygon (largest fid) that covers a centre; uncovered cells are 0."""
    named = polygons.join(classes, "class_name").select("fid", "class_id")
    inside = cover(polygons, cells).join(named, "fid")
    top = inside.groupBy("row", "col").agg(F.max_by("class_id", "fid").alias("class_id"))
    return cells.select("row", "col").join(top, ["row", "col"], "left").withColumn("class_id", F.coalesce("class_id", F.lit(0)))


def class_ids(polygons: DataFrame) -> DataFrame:
    """(class_name, class_id): names in order, ids from 1."""
    names = polygons.select("class_name").distinct()
    # One row per class: a window over the whole list is as small as the legend.
    return names.select("class_name", F.row_number().over(W.orderBy("class_name")).alias("class_id"))


def near_line(lines: DataFrame, cells: DataFrame, radius: float, block: int = 64) -> DataFrame:
    """(fid, row, col) of the cells whose centres are within ``radius`` of a line: its buffer, rasterized."""
    seg = edges(lines)
    reach = lambda a, b: F.explode(F.sequence(F.floor((F.least(a, b) - radius) / block).cast("int"), F.floor((F.greatest(a, b) + radius) / block).cast("int")))
    seg = seg.withColumn("__bx", reach("x0", "x1")).withColumn("__by", reach("y0", "y1"))
    placed = cells.select("row", "col", "x", "y", F.floor(F.col("x") / block).cast("int").alias("__bx"), F.floor(F.col("y") / block).cast("int").alias("__by"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    along = ((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.coalesce(F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    ex, ey = F.col("x") - F.col("x0") - t * dx, F.col("y") - F.col("y0") - t * dy
    return placed.join(seg, ["__bx", "__by"]).where(ex * ex + ey * ey <= radius * radius).select("fid", "row", "col").distinct()


def buffer_lines(lines: DataFrame, radius: float, quarter: int = 8) -> DataFrame:
    """Lines as polygons: a ring per segment, with round ends of ``quarter`` steps to a right angle."""
    seg = edges(lines)
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    angle = F.atan2(dy, dx)
    steps = [math.pi / 2 + k * math.pi / (2 * quarter) for k in range(2 * quarter + 1)]
    point = lambda x, y, a: F.struct((x + radius * F.cos(angle + a)).alias("x"), (y + radius * F.sin(angle + a)).alias("y"))
    start = [point(F.col("x0"), F.col("y0"), a) for a in steps]
    end = [point(F.col("x1"), F.col("y1"), a + math.pi) for a in steps]
    ring = F.array(*start, *end, start[0])
    rings = seg.select("fid", ring.alias("ring")).groupBy("fid").agg(F.collect_list("ring").alias("rings"))
    return lines.drop("rings").join(rings, "fid")


def clip(polygons: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Sutherland-Hodgman clipping of every ring to a box; polygons that leave nothing go."""

    def side(ring: Column, axis: str, bound: float, keep_below: bool) -> Column:
        other = "y" if axis == "x" else "x"
        inside = (lambda p: p[axis] <= bound) if keep_below else (lambda p: p[axis] >= bound)

        def cut(p: Column, q: Column) -> Column:
            share = (F.lit(bound) - p[axis]) / (q[axis] - p[axis])
            across = p[other] + share * (q[other] - p[other])
            return F.struct(F.lit(bound).alias("x"), across.alias("y")) if axis == "x" else F.struct(across.alias("x"), F.lit(bound).alias("y"))

        def step(q: Column, i: Column) -> Column:
            p = F.element_at(ring, F.when(i == 0, F.size(ring)).otherwise(i))
            none = F.array().cast("array<struct<x: double, y: double>>")
            entering = F.when(inside(p) != inside(q), F.array(cut(p, q))).otherwise(none)
            return F.concat(entering, F.when(inside(q), F.array(q)).otherwise(none))

        return F.flatten(F.transform(ring, step))

    def each(axis: str, bound: float, keep_below: bool) -> Column:
        return F.transform("__rings", lambda r: side(r, axis, bound, keep_below))

    out = polygons.withColumn("__rings", F.transform("rings", lambda r: F.slice(r, F.lit(1), F.size(r) - 1)))  # open rings
    for axis, bound, below in (("x", xmin, False), ("x", xmax, True), ("y", ymin, False), ("y", ymax, True)):
        out = out.withColumn("__rings", each(axis, float(bound), below))
    closed = F.transform(F.filter("__rings", lambda r: F.size(r) > 2), lambda r: F.concat(r, F.slice(r, 1, 1)))
    return out.withColumn("rings", closed).drop("__rings").where(F.size("rings") > 0)
