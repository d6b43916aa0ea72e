"""One query per raster operator on the driver's tables, with the SQL that DuckDB checks it by.

Cells are derived from ``lineitem``: row and column from two keys, the scene from the ship year.
Floats are rounded to six digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bands as fb
from .functions import geo, tags
from .operators import catalogue, classify, deep, export, neighbourhood, pixels, resample, samples, vectors
from .plans.features import feature_stack as build_stack
from .sources import vector

SIDE = 40
SCENES = list(range(1995, 2002))
BANDS = {"red": "red_dn", "nir": "nir_dn", "swir1": "swir_dn"}
# Polygons in pixel units (x right, y down); no edge meets a cell's centre.
POLYGONS = [
    (1, "wheat", [[(3.2, 4.1), (18.7, 6.3), (15.1, 22.9), (3.2, 4.1)]]),
    (2, "barley", [[(10.3, 10.3), (30.3, 10.3), (30.3, 34.7), (10.3, 34.7), (10.3, 10.3)], [(18.1, 18.1), (24.4, 18.1), (24.4, 24.4), (18.1, 24.4), (18.1, 18.1)]]),
    (3, "corn", [[(25.2, 2.2), (38.9, 3.3), (36.6, 16.8), (27.7, 14.9), (25.2, 2.2)]]),
]
LINES = [(10, "road", [[(1.3, 38.2), (20.4, 26.1), (39.2, 30.7)]])]
RADIUS = 1.7
WINDOWS = [(1, "2024-01-01", "2024-01-07"), (2, "2024-01-08", "2024-01-14"), (3, "2024-01-15", "2024-01-21"), (4, "2024-02-10", "2024-02-12")]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str, side: int = SIDE) -> DataFrame:
    """(row, col, scene, red_dn, nir_dn, swir_dn, scl) of observed cells."""
    keys = [(F.col("l_orderkey") % side).cast("int").alias("row"), (F.col("l_partkey") % side).cast("int").alias("col"), F.year("l_shipdate").alias("scene")]
    return table(spark, sf_dir, "lineitem").groupBy(*keys).agg(
        (F.max("l_quantity") * 100).alias("red_dn"),
        (F.max("l_extendedprice") / 10).alias("nir_dn"),
        (F.max("l_discount") * 50000).alias("swir_dn"),
        (F.sum("l_suppkey") % 12).cast("int").alias("scl"),
    )


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.densify(observations(spark, sf_dir), SIDE, SIDE, SCENES)


def index_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense cells with the masked index."""
    return pixels.with_ndvi(dense(spark, sf_dir)).select("row", "col", "scene", "ndvi")


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.fill_gaps(index_cells(spark, sf_dir), "ndvi")


def layer(spark: SparkSession, shapes: list = POLYGONS) -> DataFrame:
    rows = [(fid, name, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for fid, name, rings in shapes]
    return spark.createDataFrame(rows, f"fid int, class_name string, rings {vectors.RINGS}")


def centres(spark: SparkSession, side: int = SIDE) -> DataFrame:
    return spark.range(side * side).select((F.col("id") / side).cast("int").alias("row"), (F.col("id") % side).cast("int").alias("col")).withColumns({"x": F.col("col") + 0.5, "y": F.col("row") + 0.5})


def labels(spark: SparkSession) -> DataFrame:
    polygons = layer(spark)
    return vectors.rasterize(polygons, centres(spark), vectors.class_ids(polygons))


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def r8(c: Column | str) -> Column:
    """For reflectances: their medians have at most eight digits, so nothing is a tie."""
    return F.round(F.col(c) if isinstance(c, str) else c, 8)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


# The same building blocks as SQL text.
BAD = "(0, 1, 3, 8, 9, 10, 11)"
OBS = """obs as (select cast(l_orderkey % 40 as int) as "row", cast(l_partkey % 40 as int) as col, cast(year(l_shipdate) as int) as scene,
  max(l_quantity) * 100 as red_dn, max(l_extendedprice) / 10 as nir_dn, max(l_discount) * 50000 as swir_dn, cast(sum(l_suppkey) % 12 as int) as scl
  from lineitem group by 1, 2, 3)"""
GRID = """cells as (select cast(a.range as int) as "row", cast(b.range as int) as col from range(40) a, range(40) b)"""
DENSE = f"""{OBS}, {GRID}, dense as (select g."row", g.col, s.range::int as scene, red_dn, nir_dn, swir_dn, scl
  from cells g cross join range(1995, 2002) s left join obs o on o."row" = g."row" and o.col = g.col and o.scene = s.range)"""
NDVI = f"""{DENSE}, idx as (select "row", col, scene, case when coalesce(scl, 2) not in {BAD} then (nir_dn / 10000 - red_dn / 10000) / nullif(nir_dn / 10000 + red_dn / 10000, 0) end as ndvi from dense)"""
FILL = f"""{NDVI}, filled as (select "row", col, scene, coalesce(ndvi, median(ndvi) over (partition by "row", col), 0) as ndvi from idx)"""


def _edge_sql(shapes: list = POLYGONS) -> str:
    rows = [f"({fid}, {a[0]}::double, {a[1]}::double, {b[0]}::double, {b[1]}::double)" for fid, _, rings in shapes for ring in rings for a, b in zip(ring[:-1], ring[1:], strict=True)]
    return "edges(fid, x0, y0, x1, y1) as (values " + ", ".join(rows) + ")"


LABELS = f"""{GRID}, {_edge_sql()}, names(fid, class_name, class_id) as (values (1, 'wheat', 3), (2, 'barley', 1), (3, 'corn', 2)),
inside as (select fid, "row", col from cells, edges where (y0 > "row" + 0.5) <> (y1 > "row" + 0.5) and col + 0.5 < x0 + ("row" + 0.5 - y0) * (x1 - x0) / (y1 - y0)
  group by 1, 2, 3 having count(*) % 2 = 1),
labels as (select c."row", c.col, coalesce(arg_max(n.class_id, n.fid), 0) as class_id from cells c left join inside i on i."row" = c."row" and i.col = c.col left join names n on n.fid = i.fid group by 1, 2)"""
ORDER_HASH = "(({k}::bigint * 48271 + 42 * 16807 + 11) % 2147483647 * 69621 + 7) % 2147483647"
ITEMS = "items as (select event_id as id, ts as datetime, value / 5 as cloud from events)"
WINDOW_ROWS = "w(window_id, s, e) as (values " + ", ".join(f"({k}, date '{a}', date '{b}')" for k, a, b in WINDOWS) + ")"


def with_sql(ctes: str, body: str) -> str:
    return f"with {ctes} {body}"


# Bands and masks -----------------------------------------------------------


@query(with_sql(OBS, 'select "row", col, scene, round((nir_dn - red_dn) / nullif(nir_dn + red_dn, 0), 6) as ndvi from obs'))
def c1_ndvi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(observations(spark, sf_dir).select("row", "col", "scene", fb.ndvi(F.col("red_dn"), F.col("nir_dn")).alias("ndvi")), "ndvi")


@query(with_sql(OBS, 'select "row", col, scene, round(red_dn / 10000, 8) as red, round(nir_dn / 10000, 8) as nir from obs'))
def c2_reflectance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("row", "col", "scene", r8(fb.reflectance(F.col("red_dn"))).alias("red"), r8(fb.reflectance(F.col("nir_dn"))).alias("nir"))


@query(with_sql(OBS, f"select scl, scl in {BAD} as bad, count(*) as n from obs group by 1, 2"))
def c3_scl_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("scl", fb.is_bad(F.col("scl")).alias("bad")).agg(F.count("*").alias("n"))


@query(with_sql(OBS, f'select "row", col, scene, round(case when scl not in {BAD} then red_dn / 10000 end, 8) as red_dn, round(case when scl not in {BAD} then nir_dn / 10000 end, 8) as nir_dn from obs'))
def c4_masked_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.mask_bands(observations(spark, sf_dir), ["red_dn", "nir_dn"]).select("row", "col", "scene", r8("red_dn").alias("red_dn"), r8("nir_dn").alias("nir_dn"))


_C5 = ", ".join(f"round(max(case when scene = {s} then ndvi end), 6) as ndvi_{s}" for s in SCENES)
_SUMMARY = 'round(avg(ndvi), 6) as ndvi_mean, round(min(ndvi), 6) as ndvi_min, round(max(ndvi), 6) as ndvi_max, round(max(ndvi) - min(ndvi), 6) as ndvi_amplitude, round(regr_slope(ndvi, scene - 1995), 6) as ndvi_slope'


@query(with_sql(FILL, f'select "row", col, {_C5}, {_SUMMARY} from filled group by 1, 2'))
def c5_select_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = build_stack(observations(spark, sf_dir), SIDE, SIDE, SCENES, BANDS, "red_dn", "nir_dn", spectral=False, spatial=False)
    return out.select("row", "col", *[r6(c).alias(c) for c in out.columns[2:]])


_TAG_SQL = "case when event_id % 7 = 0 then 'vineyard' when event_id % 7 = 1 then 'orchard' when event_id % 7 in (2, 3) then 'non_agri' when event_id % 5 = 0 or event_id % 3 = 0 then 'non_agri' end"


@query(f"select class_name, count(*) as n from (select {_TAG_SQL} as class_name from events) group by 1")
def c8_tag_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select(tags.tag_class(F.col("tags")).alias("class_name")).groupBy("class_name").agg(F.count("*").alias("n"))


@query(with_sql(LABELS, 'select "row", col, class_id from labels where class_id > 0'))
def c13_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark).where("class_id > 0")


@query(with_sql(f"{NDVI}, {LABELS.replace(GRID + ', ', '')}", 'select class_id, count(ndvi) as kept, count(*) - count(ndvi) as dropped from labels l join idx i on i."row" = l."row" and i.col = l.col where class_id > 0 group by 1'))
def c14_drop_null_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.incomplete_counts(samples.training_samples(labels(spark), index_cells(spark, sf_dir)), ["ndvi"])


@query(with_sql(NDVI, 'select "row", col, scene, case when ndvi is null then 0 when ndvi > 0.2 then 2 else 1 end as class_id from idx'))
def c15_null_to_background(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_cells(spark, sf_dir).select("row", "col", "scene", classify.or_background(F.when(F.col("ndvi") > 0.2, 2).otherwise(1), ["ndvi"]).alias("class_id"))


@query(with_sql(LABELS, 'select k.range::int as wanted, "row", col, case when class_id = k.range then 65535 else 0 end as value from labels, range(1, 4) k'))
def c16_class_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels(spark).withColumn("wanted", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return rows.select("wanted", "row", "col", export.class_mask(F.col("class_id"), F.col("wanted"), 16).alias("value"))


@query(with_sql(OBS, 'select "row", col, scene, round((red_dn - avg(red_dn) over (partition by scene)) / (stddev_pop(red_dn) over (partition by scene) + 1e-6), 6) as red_dn from obs'))
def c19_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pixels.zscore(observations(spark, sf_dir), "red_dn").select("row", "col", "scene", "red_dn"), "red_dn")


@query("select * from (values (1, true), (2, false), (3, false)) t(id, same)")
def c20_same_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, others = geo.Grid(10, 10), [geo.Grid(10, 10), geo.Grid(10, 10, c=5.0), geo.Grid(10, 11)]
    return spark.createDataFrame([(k, base.same_as(g)) for k, g in enumerate(others, 1)], "id int, same boolean")


@query("select '[out:json][timeout:180];(' || string_agg(s || '(36.5,30.1,37.5,31.2);', '') || ');out geom;' as q from (select unnest([" + ", ".join("'" + s + "'" for s in tags.SELECTORS) + "]) as s)")
def c22_overpass_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = spark.createDataFrame([(30.1, 36.5, 31.2, 37.5)], "w double, s double, e double, n double")
    return box.select(tags.overpass_query(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("q"))


# Joins ----------------------------------------------------------------------

_D1 = ", ".join(f"round(max(case when scene = {s} then {b} end), 6) as {b}_{s}" for s in SCENES for b in ("red_dn", "nir_dn"))


@query(with_sql(OBS, f'select "row", col, {_D1} from obs group by 1, 2'))
def d1_band_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pixels.wide_by_scene(observations(spark, sf_dir), ["red_dn", "nir_dn"], SCENES)
    return out.select("row", "col", *[r6(c).alias(c) for c in out.columns[2:]])


_COARSE = 'coarse as (select "row" // 2 as r2, col // 2 as c2, scene, max(scl) as scl2 from obs group by 1, 2, 3)'


@query(with_sql(f"{OBS}, {_COARSE}", 'select "row", col, o.scene, scl2 from obs o left join coarse k on k.scene = o.scene and k.r2 = cast(floor(("row" + 0.5) * 20 / 40) as int) and k.c2 = cast(floor((col + 0.5) * 20 / 40) as int)'))
def d2_scl_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    coarse = obs.groupBy((F.col("row") / 2).cast("int").alias("row"), (F.col("col") / 2).cast("int").alias("col"), "scene").agg(F.max("scl").alias("scl2"))
    return resample.attach_nearest(obs.select("row", "col", "scene"), coarse, "scl2", (SIDE, SIDE), (SIDE // 2, SIDE // 2)).select("row", "col", "scene", "scl2")


_D3 = f"""{NDVI}, spot as (select "row", col, "row" + 0.3::double as y, col + 0.65::double as x from cells),
four as (select a."row", a.col, cast(floor(y) as int) + i.range as r, cast(floor(x) as int) + j.range as c,
  (case when i.range = 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case when j.range = 1 then x - floor(x) else 1 - (x - floor(x)) end) as wt from spot a, range(2) i, range(2) j)"""


@query(with_sql(_D3, 'select f."row", f.col, i.scene, round(sum(wt * ndvi) / sum(case when ndvi is not null then wt end), 6) as ndvi from four f join idx i on i."row" = f.r and i.col = f.c group by 1, 2, 3'))
def d3_bilinear_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(resample.reproject(index_cells(spark, sf_dir), "ndvi", geo.Grid(SIDE, SIDE), geo.Grid(SIDE, SIDE, c=0.65, f=0.3), ("scene",)), "ndvi")


@query(with_sql(LABELS, 'select "row", col, class_id from labels'))
def d4_rasterize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark)


@query(with_sql(f"{FILL}, {LABELS.replace(GRID + ', ', '')}", 'select l."row", l.col, class_id, round(avg(ndvi), 6) as ndvi from labels l join filled f on f."row" = l."row" and f.col = l.col where class_id > 0 group by 1, 2, 3'))
def d5_training_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = filled(spark, sf_dir).groupBy("row", "col").agg(r6(F.avg("ndvi")).alias("ndvi"))
    return samples.training_samples(labels(spark), mean).select("row", "col", "class_id", "ndvi")


@query(with_sql(f"{GRID}, {_edge_sql()}", 'select fid, "row", col from cells, edges where (y0 > "row" + 0.5) <> (y1 > "row" + 0.5) and col + 0.5 < x0 + ("row" + 0.5 - y0) * (x1 - x0) / (y1 - y0) and col + 0.5 between 8.2 and 28.9 and "row" + 0.5 between 6.1 and 30.2 group by 1, 2, 3 having count(*) % 2 = 1'))
def d6_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cover(vectors.clip(layer(spark), 8.2, 6.1, 28.9, 30.2), centres(spark))


@query("select distinct o_orderpriority as class_name, dense_rank() over (order by o_orderpriority)::int as class_id from orders")
def d7_class_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.class_ids(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("class_name")))


@query(with_sql(LABELS, 'select a.range::int as "row", b.range::int as col, class_id from range(127) a, range(127) b join labels l on l."row" = floor((a.range + 0.5) * 40 / 127)::int and l.col = floor((b.range + 0.5) * 40 / 127)::int'))
def d8_resample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.to_square(labels(spark), (SIDE, SIDE))


@query(with_sql(FILL, 'select "row", col, round(avg(ndvi), 6) as ndvi, round(sum(ndvi) * 2, 6) as deep_pca_00 from filled group by 1, 2'))
def d9_append_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = filled(spark, sf_dir)
    deep = cells.groupBy("row", "col").agg(r6(F.sum("ndvi") * 2).alias("deep_pca_00"))
    return pixels.append_bands(cells.groupBy("row", "col").agg(r6(F.avg("ndvi")).alias("ndvi"), F.lit(0.0).alias("deep_pca_00")), deep)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("datetime"), (F.col("value") / 5).alias("cloud"))


def _windows(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(k, f"{a}/{b}") for k, a, b in WINDOWS], "window_id int, text string")
    start, end = catalogue.parse_interval(F.col("text"))
    return rows.select("window_id", start.alias("start"), end.alias("end"))


@query(with_sql(f"{ITEMS}, {WINDOW_ROWS}", "select window_id::int as window_id, id from items join w on datetime::date between s and e"))
def d10_window_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.in_windows(_items(spark, sf_dir), _windows(spark)).select("window_id", "id")


@query(with_sql(GRID, 'select t.range::int as tile_row, u.range::int as tile_col, "row", col, ("row" // 16 = t.range and col // 16 = u.range) as in_core from cells, range(3) t, range(3) u where "row" between t.range * 16 - 4 and least(t.range * 16 + 16, 40) - 1 + 4 and col between u.range * 16 - 4 and least(u.range * 16 + 16, 40) - 1 + 4'))
def d11_halo_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbourhood.halo_tiles(centres(spark).select("row", "col"), 16, 4, SIDE, SIDE).select("tile_row", "tile_col", "row", "col", "in_core")


_D12 = """with p as (select c_custkey as id, 27 + (c_custkey % 60) / 10.0 as lon, 36 + (c_custkey % 70) / 10.0 as lat from customer),
a as (select id, radians(lon - 27) as lam, sin(radians(lat)) as s from p),
b as (select id, lam, sinh(atanh(s) - {e} * atanh(s * {e})) as t from a),
d as (select id, atan2(t, cos(lam)) as xi, atanh(sin(lam) / sqrt(1 + t * t)) as eta from b)
select id, round(500000 + {k} * (eta{xs}), 3) as x, round({k} * (xi{ys}), 3) as y from d""".format(
    e=repr(geo._E), k=repr(geo._K0 * geo._A),
    xs="".join(f" + {a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo._ALPHA, 1)),
    ys="".join(f" + {a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo._ALPHA, 1)),
)


@query(_D12)
def d12_utm_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    x, y = geo.utm_forward(27 + (k % 60) / 10.0, 36 + (k % 70) / 10.0, 35)
    return table(spark, sf_dir, "customer").select(k.alias("id"), F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# Aggregations ----------------------------------------------------------------


@query(with_sql(f"{ITEMS}, {WINDOW_ROWS}", "select window_id::int as window_id, id, strftime(datetime, '%Y-%m-%d') as scene_date, round(cloud, 6) as cloud from (select *, row_number() over (partition by window_id order by coalesce(cloud, 100), datetime, id) as k from items join w on datetime::date between s and e where cloud < 20) where k = 1"))
def e1_least_cloudy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(catalogue.least_cloudy(_items(spark, sf_dir), _windows(spark)), "cloud")


@query(with_sql(NDVI, 'select "row", col, round(median(ndvi), 6) as ndvi from idx group by 1, 2'))
def e2_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pixels.temporal_median(index_cells(spark, sf_dir), "ndvi"), "ndvi")


@query(with_sql(FILL, f'select "row", col, {_SUMMARY} from filled group by 1, 2'))
def e3_e7_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pixels.temporal_summary(filled(spark, sf_dir))
    return rounded(out, *out.columns[2:])


@query(with_sql(DENSE, 'select "row", col, round(coalesce(median(red_dn), 0), 6) as red_dn, round(coalesce(median(nir_dn), 0), 6) as nir_dn from dense group by 1, 2'))
def e9_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pixels.composite(dense(spark, sf_dir), "red_dn", "nir_dn"), "red_dn", "nir_dn")


@query("select o_orderpriority as class_name, count(*) as n from orders group by 1")
def e11_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.class_counts(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("class_name")))


@query(f"select fid, class_name from (select o_orderkey as fid, o_orderpriority as class_name, row_number() over (partition by o_orderpriority order by {ORDER_HASH.format(k='o_orderkey')}, o_orderkey) as k from orders) where k <= 40")
def e12_cap_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("fid"), F.col("o_orderpriority").alias("class_name"))
    return samples.cap_per_class(rows, 40)


@query(with_sql(_edge_sql(), "select min(x0) as xmin, min(y0) as ymin, max(x0) as xmax, max(y0) as ymax from edges"))
def e13_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.extent(layer(spark))


@query(with_sql(LABELS, "select n.class_id, n.class_name, round(100.0::double * (select count(*) from labels l where l.class_id = n.class_id) / (select count(*) from labels), 6) as percent from names n"))
def e14_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(export.coverage(labels(spark), vectors.class_ids(layer(spark))), "percent")


_PRED = "pred as (select quality as truth, case when doc_id % 5 = 0 then 1 - quality else quality end as predicted from labels)"


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    return table(spark, sf_dir, "labels").select(q.alias("truth"), F.when(F.col("doc_id") % 5 == 0, 1 - q).otherwise(q).alias("predicted"))


@query(with_sql(_PRED, "select truth, predicted, count(*) as n from pred group by 1, 2"))
def e15_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.confusion(_predictions(spark, sf_dir), "truth", "predicted")


_E16 = f"""with {_PRED}, c as (select distinct truth as k from pred), s as (select k, (select count(*) from pred where truth = k) as support, (select count(*) from pred where predicted = k) as said, (select count(*) from pred where truth = k and predicted = k) as hit from c),
m as (select k, support, hit, coalesce(hit / nullif(said, 0), 0) as p, coalesce(hit / nullif(support, 0), 0) as r from s), f as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f1 from m)
select k::varchar as label, round(p, 6) as precision, round(r, 6) as recall, round(f1, 6) as f1, support from f
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support)::bigint from f
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from f
union all select 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), sum(support)::bigint from f"""


@query(_E16)
def e16_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(samples.report(_predictions(spark, sf_dir), "truth", "predicted"), "precision", "recall", "f1")


@query("select quality, n, round(sum(n) over () / (count(*) over () * n), 6) as weight from (select quality, count(*) as n from labels group by 1)")
def e17_class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(samples.class_weights(table(spark, sf_dir, "labels"), "quality"), "weight")


@query(with_sql(NDVI, 'select "row", col, bool_or(ndvi is null) as any_missing, bool_and(ndvi is null) as all_missing, count(ndvi) as valid from idx group by 1, 2'))
def e18_missing_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.missing_flags(index_cells(spark, sf_dir), "ndvi")


# Windows and neighbourhoods ----------------------------------------------------

_MIRROR = "case when {p} < 0 then -1 - ({p}) when {p} >= 40 then 79 - ({p}) else {p} end"
_F1 = f"""{FILL}, off as (select range - 2 as o from range(5)), near as (select "row", col, {_MIRROR.format(p='"row" + a.o')} as r, {_MIRROR.format(p='col + b.o')} as c from cells, off a, off b)"""


@query(with_sql(_F1, 'select f.scene, n."row", n.col, round(sqrt(greatest(avg(ndvi * ndvi) - avg(ndvi) * avg(ndvi), 0)), 6) as ndvi_std5 from near n join filled f on f."row" = n.r and f.col = n.c group by 1, 2, 3'))
def f1_texture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(neighbourhood.local_std(filled(spark, sf_dir), "ndvi", 5, SIDE, SIDE), "ndvi_std5")


@query(ORACLES["f1_texture"])
def f1_texture_tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(neighbourhood.local_std_tiled(filled(spark, sf_dir), "ndvi", 5, SIDE, SIDE, tile=16), "ndvi_std5")


@query(with_sql(FILL, 'select "row", col, scene, round(ndvi, 6) as ndvi from filled'))
def f2_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(filled(spark, sf_dir), "ndvi")


_F3 = f"""{FILL}, ws(i, first, w) as (values {", ".join(f"({i}, {max(0, min(i - 2, 2))}, [{', '.join(str(x) for x in pixels.SAVGOL[0 if i == 0 else 1 if i == 1 else 4 if i == 6 else 3 if i == 5 else 2])}])" for i in range(7))})"""


@query(with_sql(_F3, 'select f."row", f.col, 1995 + i as scene, round(sum(w[f.scene - 1995 - first + 1] * ndvi) / 35, 6) as ndvi from filled f join ws on f.scene - 1995 between first and first + 4 group by 1, 2, 3'))
def f3_savgol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pixels.smooth(filled(spark, sf_dir)), "ndvi")


@query(with_sql(OBS, 'select "row", col, scene, (row_number() over (partition by "row", col order by scene) - 1)::int as t from obs'))
def f4_time_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.time_index(observations(spark, sf_dir)).select("row", "col", "scene", "t")


@query(with_sql(GRID, 'select "row", col, ("row" // 16)::int as tile_row, (col // 16)::int as tile_col from cells'))
def f5_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbourhood.tiles(centres(spark).select("row", "col"), 16)


_F6 = "with t as (select a.range * 16 as r, b.range * 16 as c from range(3) a, range(3) b) select r::int as \"row\", c::int as col, least(16, 40 - r)::int as height, least(16, 40 - c)::int as width, greatest(0, r - 4)::int as read_row, greatest(0, c - 4)::int as read_col, (least(40, r + least(16, 40 - r) + 4) - greatest(0, r - 4))::int as read_height, (least(40, c + least(16, 40 - c) + 4) - greatest(0, c - 4))::int as read_width, (r - greatest(0, r - 4))::int as off_row, (c - greatest(0, c - 4))::int as off_col from t"


@query(_F6)
def f6_halo_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = list(neighbourhood.tile_windows(SIDE, SIDE, 16, 4))
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"`{k}` int" for k in rows[0]))


# Order, limits, sets -------------------------------------------------------------


@query("select p_partkey, coalesce((select min(s) from (values (127), (253), (505), (1009), (2017), (4033), (8129)) v(s) where s >= p_size * 200), 8129)::int as side from part")
def g4_valid_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", export.valid_size(F.col("p_size") * 200).alias("side"))


@query(f"select o_orderkey, row_number() over (partition by o_orderpriority order by {ORDER_HASH.format(k='o_orderkey')}, o_orderkey) <= floor(count(*) over (partition by o_orderpriority) * 0.25 + 0.5) as held_out from orders")
def g6_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.stratified_split(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey").select("o_orderkey", "held_out")


_TILE_KEY = ORDER_HASH.format(k='("row"::bigint * 1000003 + col)')


@query(with_sql(GRID, f'select "row", col from (select "row", col, row_number() over (partition by "row" // 16, col // 16 order by {_TILE_KEY}, "row", col) as k from cells) where k <= 55'))
def g7_tile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sample_per_tile(neighbourhood.tiles(centres(spark).select("row", "col"), 16), 500, 9).select("row", "col")


@query("select user_id, event_id from (select user_id, event_id, dense_rank() over (partition by user_id order by ts) as k from events) where k = 1")
def g8_first_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.first_slice(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts").select("user_id", "event_id")


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, kind, tags): map elements made of the events' numbers."""
    k = F.col("event_id") % 7
    use = F.when(k == 0, "vineyard").when(k == 1, "orchard").when(k == 2, "residential").when(k == 3, "reservoir").otherwise("forest")
    natural = F.when(F.col("event_id") % 5 == 0, "water").otherwise("wood")
    pairs = F.map_from_arrays(F.array(F.lit("landuse"), F.lit("natural"), F.lit("highway")), F.array(use, natural, F.when(F.col("event_id") % 3 == 0, "primary").otherwise("")))
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "way").otherwise("relation").alias("kind"), pairs.alias("tags"))


@query("select event_id from events where event_id % 7 < 3 or event_id % 5 = 0 or (event_id % 2 = 0 and (event_id % 7 = 3 or event_id % 3 = 0))")
def h1_selector_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).where(tags.selected(F.col("kind"), F.col("tags"))).select("event_id")


@query(with_sql(f"{GRID}, {_edge_sql([(f, n, r) for f, n, r in LINES])}, d as (select fid, \"row\", col, x0, y0, x1 - x0 as dx, y1 - y0 as dy, greatest(0, least(1, ((col + 0.5 - x0) * (x1 - x0) + (\"row\" + 0.5 - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2))) as t from cells, edges)", f'select distinct fid, "row", col from d where (col + 0.5 - x0 - t * dx) ** 2 + ("row" + 0.5 - y0 - t * dy) ** 2 <= {RADIUS} * {RADIUS}'))
def i10_line_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_line(layer(spark, LINES), centres(spark), RADIUS)


@query(with_sql(GRID, 'select "row", col, ((col + 0.5) * 10 + 600000)::double as x, (("row" + 0.5) * -10 + 4100000)::double as y from cells'))
def i12_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geo.Grid(SIDE, SIDE, a=10.0, c=600000.0, e=-10.0, f=4100000.0).to_ground(F.col("row"), F.col("col"))
    return centres(spark).select("row", "col", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


# Sources as rows -------------------------------------------------------------------


@query(with_sql(ITEMS, "select id, datetime, round(cloud, 6) as cloud from items where datetime >= timestamp '2024-01-05' and datetime < timestamp '2024-01-13' and cloud < 20"))
def a2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(catalogue.search(_items(spark, sf_dir), "2024-01-05", "2024-01-12"), "cloud")


@query("select scene, band, arg_min(path, k) as path from (select o_orderkey % 50 as scene, o_custkey % 7 as band, o_orderkey as path, case o_orderkey % 4 when 0 then 1 when 1 then 2 when 2 then 3 end * 1000000000000 + o_orderkey as k from orders where o_orderkey % 4 < 3) group by 1, 2")
def a4_band_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    extension = F.element_at(F.array(F.lit(".jp2"), F.lit(".tif"), F.lit(".tiff"), F.lit(".png")), (k % 4 + 1).cast("int"))
    files = table(spark, sf_dir, "orders").select((k % 50).alias("scene"), (F.col("o_custkey") % 7).alias("band"), k.alias("path"), extension.alias("extension"))
    first = files.groupBy("scene", "band", "extension").agg(F.min("path").alias("path"))
    return catalogue.band_files(first, fb.BAND_EXTENSIONS)


_GEOJSON = """{"features":[{"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]},"properties":{"tags":{"landuse":"vineyard"}}},
{"geometry":{"type":"LineString","coordinates":[[1,1],[5,6]]},"properties":{"tags":{"highway":"primary"}}},
{"geometry":{"type":"MultiPolygon","coordinates":[[[[7,7],[9,7],[9,9],[7,7]]]]},"properties":{"tags":{"natural":"water"}}},
{"geometry":{"type":"Polygon","coordinates":[]},"properties":{"tags":{"landuse":"orchard"}}},
{"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]},"properties":{"tags":{"building":"yes"}}}]}"""


@query("select * from (values ('vineyard', 'Polygon', false, 4), ('non_agri', 'LineString', true, 2), ('non_agri', 'MultiPolygon', false, 4)) t(class_name, geometry_type, is_road, points)")
def a12_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector.features(spark.createDataFrame([(_GEOJSON,)], "value string"))
    return rows.select("class_name", "geometry_type", "is_road", F.size(F.flatten("rings")).alias("points"))


@query("select key::int as class_id, value as class_name from (values ('1', 'barley'), ('2', 'corn'), ('3', 'wheat')) t(key, value)")
def a13_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = vector.legend_json(vectors.class_ids(layer(spark)))
    return text.select(F.explode(F.from_json("json", "map<string,string>")).alias("k", "class_name")).select(F.col("k").cast("int").alias("class_id"), "class_name")


@query("select * from (values ('layer1.0.weight'), ('conv1.weight')) t(\"key\")")
def a15_backbone_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["model.layer1.0.weight", "backbone.conv1.weight", "model.fc.weight", "head.bias"]
    return classify.backbone_keys(spark.createDataFrame([(k,) for k in keys], "key string"))


@query(with_sql(OBS, "select distinct scene from obs"))
def a16_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels.scenes_of(observations(spark, sf_dir))


_J6 = """with src as (select a.range::int as r, b.range::int as c, (a.range * 10 + b.range * b.range)::double as v from range(5) a, range(5) b),
spot as (select a.range::int as "row", b.range::int as col, least(greatest((a.range + 0.5) * 5 / 20 - 0.5, 0), 4) as y, least(greatest((b.range + 0.5) * 5 / 20 - 0.5, 0), 4) as x from range(20) a, range(20) b),
four as (select "row", col, floor(y)::int + i.range as r, floor(x)::int + j.range as c, (case when i.range = 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case when j.range = 1 then x - floor(x) else 1 - (x - floor(x)) end) as w from spot, range(2) i, range(2) j)
select "row", col, round(sum(w * v) / sum(w), 6) as v from four join src using (r, c) group by 1, 2"""


@query(_J6)
def j6_upsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.range(25).select((F.col("id") / 5).cast("int").alias("row"), (F.col("id") % 5).cast("int").alias("col"))
    cells = cells.withColumn("v", (F.col("row") * 10 + F.col("col") * F.col("col")).cast("double"))
    return rounded(resample.upsample(cells, "v", (5, 5), (20, 20)), "v")


_J5 = f"""{DENSE}, comp as (select "row", col, coalesce(median(red_dn), 0) as red, coalesce(median(nir_dn), 0) as nir from dense group by 1, 2),
src as (select "row" // 4 as r, col // 4 as c, avg(red) as f0, avg(nir) as f1 from comp group by 1, 2),
spot as (select "row", col, least(greatest(("row" + 0.5) / 4 - 0.5, 0), 9) as y, least(greatest((col + 0.5) / 4 - 0.5, 0), 9) as x from cells),
four as (select "row", col, floor(y)::int + i.range as r, floor(x)::int + j.range as c, (case when i.range = 1 then y - floor(y) else 1 - (y - floor(y)) end) * (case when j.range = 1 then x - floor(x) else 1 - (x - floor(x)) end) as w from spot, range(2) i, range(2) j)
select "row", col, round(sum(w * f0) / sum(w) / 7, 4) as f0, round(sum(w * f1) / sum(w) / 7, 4) as f1 from four join src using (r, c) group by 1, 2"""


@query("with " + _J5)
def j5_deep_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extractor over tiles with halos: block means of the composite, stretched and cropped."""
    image = pixels.composite(dense(spark, sf_dir), "red_dn", "nir_dn")
    out = deep.tile_features(image, ["red_dn", "nir_dn"], deep.block_means(4), 2, SIDE, SIDE, tile=16, halo=8)
    # In sevenths, so that no decimal is a tie.
    return out.select("row", "col", *[F.round(F.col(f) / 7, 4).alias(f) for f in ("f0", "f1")])


@query()
def j9_deep_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index stack with principal components of tile features behind it."""
    image = pixels.composite(dense(spark, sf_dir), "red_dn", "nir_dn", "swir_dn")
    maps = deep.tile_features(image, ["red_dn", "nir_dn", "swir_dn"], deep.block_means(4), 3, SIDE, SIDE, tile=16, halo=8)
    out = deep.add_deep_features(pixels.wide_by_scene(filled(spark, sf_dir), ["ndvi"], SCENES), maps, deep.fit_components(maps, SIDE, SIDE, 16, 2))
    return out.select("row", "col", *[r6(c).alias(c) for c in out.columns[2:]])


# Whole plans and models ---------------------------------------------------------------

_STACK = ", ".join(
    [f"round(max(case when f.scene = {s} then {b} end), 8) as {b}_{s}" for s in SCENES for b in BANDS]
    + [f"round(max(case when f.scene = {s} then f.ndvi end), 6) as ndvi_{s}, round(max(case when f.scene = {s} then sd end), 6) as ndvi_std5_{s}" for s in SCENES]
)
_STACK_CTE = f"""{_F1}, bands as (select "row", col, scene, {", ".join(f"coalesce(v_{b}, median(v_{b}) over (partition by \"row\", col), 0) as {b}" for b in BANDS)} from (select "row", col, scene, {", ".join(f"case when coalesce(scl, 2) not in {BAD} then {c} / 10000 end as v_{b}" for b, c in BANDS.items())} from dense)),
tex as (select f.scene, n."row", n.col, sqrt(greatest(avg(ndvi * ndvi) - avg(ndvi) * avg(ndvi), 0)) as sd from near n join filled f on f."row" = n.r and f.col = n.c group by 1, 2, 3)"""


@query(with_sql(_STACK_CTE, f'select f."row", f.col, {_STACK}, {_SUMMARY.replace("(ndvi", "(f.ndvi").replace("scene - 1995", "f.scene - 1995")} from filled f join bands b on b."row" = f."row" and b.col = f.col and b.scene = f.scene join tex t on t."row" = f."row" and t.col = f.col and t.scene = f.scene group by 1, 2'))
def feature_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = build_stack(observations(spark, sf_dir), SIDE, SIDE, SCENES, BANDS, "red_dn", "nir_dn")
    return out.select("row", "col", *[(r6 if c.startswith("ndvi") else r8)(c).alias(c) for c in out.columns[2:]])


@query(with_sql(FILL, 'select "row", col, ' + ", ".join(f"round(max(case when scene = {s} then ndvi end), 6) as ndvi_{s}" for s in SCENES) + " from filled group by 1, 2"))
def ndvi_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pixels.wide_by_scene(filled(spark, sf_dir), ["ndvi"], SCENES)
    return out.select("row", "col", *[r6(c).alias(c) for c in out.columns[2:]])


@query()
def j1_j2_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class map from a forest trained on the labelled cells."""
    names = [f"ndvi_{s}" for s in SCENES]
    stack = pixels.wide_by_scene(filled(spark, sf_dir), ["ndvi"], SCENES).cache()
    train = samples.drop_incomplete(samples.training_samples(labels(spark), stack), names)
    return classify.predict(classify.train_forest(train, names), stack, names)


@query()
def j4_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two principal components of the embeddings."""
    stored = table(spark, sf_dir, "embeddings")
    width = stored.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"e{k}" for k in range(width)]
    rows = stored.select("vec_id", *[F.col("embedding")[k].cast("double").alias(name) for k, name in enumerate(names)])
    out = classify.apply_pca(classify.fit_pca(rows, names, 2), rows)
    return out.select("vec_id", r6("deep_pca_00").alias("deep_pca_00"), r6("deep_pca_01").alias("deep_pca_01"))


@query()
def b8_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One PNG per class, on the next valid square."""
    square = export.to_square(labels(spark), (SIDE, SIDE))
    images = export.mask_images(square, vectors.class_ids(layer(spark)), export.valid_size_of(SIDE))
    return images.select("class_id", "file", F.octet_length("png").alias("bytes"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
