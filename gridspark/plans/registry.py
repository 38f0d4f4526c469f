"""Every operator bound to the given tables, beside SQL that says the same over the same views."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions import calendars as cal
from gridspark.functions import columns as fn
from gridspark.operators import catalog, chunks, combine, manifest, quality, regrid, select, standardize, stats
from gridspark.session import scratch, small, written
from gridspark.sources import files, store
from gridspark.sources.fixtures import over, view, with_views
from gridspark.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with SQL over the views if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add


def raw(spark: SparkSession, d: str) -> DataFrame:
    return standardize.rename_dims(view(spark, d, "grid_raw"))


def latest(spark: SparkSession, d: str) -> DataFrame:
    """The dense cube: one value a cell and month."""
    return stats.latest_revision(view(spark, d, "grid_dense"), ["time", "lat_idx", "lon_idx"], ["revision", "value"])


LATEST = """
latest AS (SELECT time, lat_idx, lon_idx, revision, value FROM grid_dense
           QUALIFY row_number() OVER (PARTITION BY time, lat_idx, lon_idx ORDER BY revision DESC, value DESC NULLS LAST) = 1)"""
RULES = [("t2m", "2m_temperature", True, -9999.0, 0.5, 10.0), ("tp", "total_precipitation", True, -9999.0, None, None), ("sp", "surface_pressure", False, -9999.0, 2.0, None)]
LONG = "CASE short_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in fn.LONG_NAMES.items()) + " END"


# Sources ------------------------------------------------------------------------------------


LINES = {"l_returnflag": "short_name", "l_shipdate": "valid_time", "l_suppkey": "lat", "l_partkey": "lon", "l_linenumber": "revision", "l_quantity": "band1"}
ORDERS = {"o_orderstatus": "short_name", "o_orderdate": "valid_time", "o_custkey": "lat", "o_orderkey": "lon", "o_totalprice": "band1"}


@query("SELECT short_name, valid_time AS time, lat AS latitude, lon AS longitude, revision, expver, band1 FROM grid_raw")
def scan_grid(spark, d):
    return files.read_grid(spark, f"{d}/lineitem.parquet", decode=lambda rows: over(spark, "grid_raw", {"lineitem": rows}))


@query("""
SELECT l_returnflag AS short_name, l_shipdate AS time, l_suppkey AS latitude, l_partkey AS longitude, l_linenumber AS revision, l_quantity AS band1 FROM lineitem UNION ALL
SELECT o_orderstatus, o_orderdate, o_custkey, o_orderkey, NULL, o_totalprice FROM orders""")
def scan_multi(spark, d):
    return files.read_grid(spark, f"{d}/lineitem.parquet", f"{d}/orders.parquet", names=LINES | ORDERS)


TRANSFORM = (0.5, 0.0, -10.0, 0.0, -0.25, 60.0)


def tiles(spark, d) -> DataFrame:
    """Three rasters of 42 x 50 with an affine transform; absent pixels hold the nodata value."""
    value = F.coalesce(F.col("value"), F.lit(-9999.0)).cast("float")
    cells = view(spark, d, "grid_pixels").groupBy("path").agg(F.array_sort(F.collect_list(F.struct((F.col("pix_row") * 50 + F.col("pix_col")).alias("k"), value.alias("v")))).alias("cells"))
    pixels = chunks.filled("cells", F.lit(42 * 50), F.lit(-9999.0).cast("float"))
    transform = F.array(*map(F.lit, TRANSFORM))
    return cells.select("path", F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz").alias("time"), F.lit(1).alias("band"), F.lit(50).alias("width"), F.lit(42).alias("height"), transform.alias("transform"), F.lit(-9999.0).alias("nodata"), pixels.alias("pixels"))


@query("""
SELECT p.path, 1 AS band, CAST(r.range AS INT) AS pix_row, CAST(c.range AS INT) AS pix_col, 60 - 0.25::DOUBLE * (r.range + 0.5::DOUBLE) AS latitude, -10 + 0.5::DOUBLE * (c.range + 0.5::DOUBLE) AS longitude, g.value
FROM (SELECT DISTINCT path FROM grid_pixels) p, range(42) r, range(50) c LEFT JOIN grid_pixels g ON g.path = p.path AND g.pix_row = r.range AND g.pix_col = c.range""")
def raster_points(spark, d):
    return regrid.raster_to_points(tiles(spark, d)).drop("time")


@query("""
SELECT * FROM grid_dense n WHERE revision >= 3 AND NOT EXISTS (
  SELECT 1 FROM grid_dense e WHERE e.revision <= 4 AND e.time = n.time AND e.lat_idx = n.lat_idx AND e.lon_idx = n.lon_idx AND e.revision = n.revision)""")
def append_new_rows(spark, d):
    grid = view(spark, d, "grid_dense")
    return combine.append_new(grid.where("revision <= 4"), grid.where("revision >= 3"), ["time", "lat_idx", "lon_idx", "revision"])


@query("SELECT time, CAST(row_number() OVER (ORDER BY time) - 1 AS INT) AS idx, CAST((row_number() OVER (ORDER BY time) - 1) // 32 AS INT) AS slab_id FROM (SELECT DISTINCT time FROM obs_hourly)")
def slab_assign(spark, d):
    return cal.slabs(view(spark, d, "obs_hourly"), 32)


SHAPE = (12, 4, 10)


def cube(spark, d) -> tuple[DataFrame, int]:
    """Cells of the dense cube by index, and the number of its times. The axis is numbered once and written."""
    axis = written(stats.numbered(view(spark, d, "grid_dense").select("time").distinct(), "time").withColumnRenamed("idx", "t_idx"))
    cells = latest(spark, d).join(small(axis), "time").select(F.lit("dense").alias("dataset"), "t_idx", "lat_idx", "lon_idx", "value")
    return cells, axis.count()


CELLS = f""", {LATEST},
axis AS (SELECT time, CAST(row_number() OVER (ORDER BY time) - 1 AS INT) AS t_idx FROM (SELECT DISTINCT time FROM latest)),
cells AS (SELECT 'dense' AS dataset, t_idx, lat_idx, lon_idx, value FROM latest JOIN axis USING (time))"""


@query(CELLS + """,
size AS (SELECT count(*) AS n FROM axis),
k AS (SELECT DISTINCT t_idx // 12 AS t_chunk, lat_idx // 4 AS y_chunk, lon_idx // 10 AS x_chunk FROM cells),
n AS (SELECT *, least(12, size.n - t_chunk * 12) AS t_len, least(4, 10 - y_chunk * 4) AS y_len, least(10, 36 - x_chunk * 10) AS x_len FROM k, size),
f AS (SELECT n.*, t.range AS t, y.range AS y, x.range AS x FROM n, range(12) t, range(4) y, range(10) x WHERE t.range < t_len AND y.range < y_len AND x.range < x_len)
SELECT 'dense' AS dataset, t_chunk, y_chunk, x_chunk, t_len, y_len, x_len,
       string_agg(coalesce(CAST(CAST(value AS INT) AS VARCHAR), '-'), ',' ORDER BY t, y, x) AS cell_values
FROM f LEFT JOIN cells c ON c.t_idx = t_chunk * 12 + t AND c.lat_idx = y_chunk * 4 + y AND c.lon_idx = x_chunk * 10 + x GROUP BY ALL""")
def chunk_pack(spark, d):
    cells, n = cube(spark, d)
    packed = chunks.pack_chunks(cells, (n, 10, 36), SHAPE)
    shown = F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("int").cast("string"), F.lit("-"))), ",")
    return packed.withColumn("cell_values", shown).drop("values")


@query()
def chunk_append(spark, d):
    """As chunk_pack, of which the first 30 months are packed first and the others are appended."""
    cells, n = cube(spark, d)
    cells = written(cells)
    first = written(chunks.pack_chunks(cells.where("t_idx < 30"), (30, 10, 36), SHAPE))
    packed = chunks.append_chunks(first, cells.where("t_idx >= 30"), (n, 10, 36), SHAPE)
    shown = F.array_join(F.transform("values", lambda v: F.coalesce(v.cast("int").cast("string"), F.lit("-"))), ",")
    return packed.withColumn("cell_values", shown).drop("values")


ORACLES["chunk_append"] = ORACLES["chunk_pack"]


@query(CELLS + " SELECT * FROM cells WHERE value IS NOT NULL")
def chunk_roundtrip(spark, d):
    cells, n = cube(spark, d)
    return chunks.unpack_chunks(chunks.pack_chunks(cells, (n, 10, 36), SHAPE), SHAPE)


DIGESTS = CELLS + """,
size AS (SELECT count(*) AS n FROM axis),
k AS (SELECT DISTINCT t_idx // 12 AS t_chunk, lat_idx // 4 AS y_chunk, lon_idx // 10 AS x_chunk FROM cells),
n AS (SELECT *, least(12, size.n - t_chunk * 12) AS t_len, least(4, 10 - y_chunk * 4) AS y_len, least(10, 36 - x_chunk * 10) AS x_len FROM k, size),
f AS (SELECT n.*, t.range AS t, y.range AS y, x.range AS x FROM n, range(12) t, range(4) y, range(10) x WHERE t.range < t_len AND y.range < y_len AND x.range < x_len),
v AS (SELECT 'dense' AS dataset, t_chunk, y_chunk, x_chunk, t_len, y_len, x_len, string_agg(coalesce(CAST(CAST(value AS DOUBLE) AS VARCHAR), 'null'), ',' ORDER BY t, y, x) AS vs
      FROM f LEFT JOIN cells c ON c.t_idx = t_chunk * 12 + t AND c.lat_idx = y_chunk * 4 + y AND c.lon_idx = x_chunk * 10 + x GROUP BY ALL),
digests AS (SELECT dataset, t_chunk, y_chunk, x_chunk, t_len, y_len, x_len, sha256(concat('{"dataset":"dense","t_chunk":', t_chunk, ',"y_chunk":', y_chunk, ',"x_chunk":', x_chunk, ',"t_len":', t_len, ',"y_len":', y_len, ',"x_len":', x_len, ',"values":[', vs, ']}')) AS digest FROM v)"""


@query(DIGESTS + " SELECT * FROM digests")
def chunk_digest(spark, d):
    cells, n = cube(spark, d)
    return chunks.chunk_digests(chunks.pack_chunks(cells, (n, 10, 36), SHAPE)).drop("values")


@query(DIGESTS + """,
g AS (SELECT substr(digest, 1, 2) AS g, sha256(string_agg(digest, '' ORDER BY digest)) AS d FROM digests GROUP BY 1)
SELECT sha256(string_agg(concat(g, d), '' ORDER BY concat(g, d))) AS version_id FROM g""")
def version_id(spark, d):
    return chunks.version_id(chunk_digest(spark, d))


AXES = """
axes AS (SELECT dataset, dim, CAST(row_number() OVER (PARTITION BY dataset, dim ORDER BY coord) - 1 AS INT) AS idx, coord FROM (
  SELECT DISTINCT short_name AS dataset, 'latitude' AS dim, lat AS coord FROM grid_raw UNION
  SELECT DISTINCT short_name, 'longitude', CASE WHEN lon > 180 THEN lon - 360 ELSE lon END FROM grid_raw))"""


def wrapped(spark, d) -> DataFrame:
    return raw(spark, d).withColumnRenamed("short_name", "dataset").withColumn("longitude", fn.wrap_longitude(F.col("longitude")))


def grid_axes(spark, d) -> DataFrame:
    """Written, as a store keeps its axes: who uses them reads labels, not observations."""
    return written(stats.axes(wrapped(spark, d), ("latitude", "longitude")))


@query(f", {AXES} SELECT * FROM axes")
def axes_table(spark, d):
    return grid_axes(spark, d)


@query("SELECT short_name AS dataset, count(DISTINCT valid_time) AS n_time, count(DISTINCT lat) AS n_latitude, count(DISTINCT lon) AS n_longitude FROM grid_raw GROUP BY 1")
def dim_sizes(spark, d):
    return stats.dim_sizes(raw(spark, d).withColumnRenamed("short_name", "dataset"), ("time", "latitude", "longitude"))


@query("""
SELECT short_name AS dataset, 'dimension' AS kind, 'time' AS name, count(DISTINCT valid_time) AS n FROM grid_raw GROUP BY 1 UNION ALL
SELECT short_name, 'dimension', 'latitude', count(DISTINCT lat) FROM grid_raw GROUP BY 1 UNION ALL
SELECT short_name, 'dimension', 'longitude', count(DISTINCT lon) FROM grid_raw GROUP BY 1 UNION ALL
SELECT short_name, 'variable', 'expver', count(expver) FROM grid_raw GROUP BY 1 UNION ALL
SELECT short_name, 'variable', 'band1', count(band1) FROM grid_raw GROUP BY 1""")
def describe(spark, d):
    return stats.describe(raw(spark, d).withColumnRenamed("short_name", "dataset"), ("time", "latitude", "longitude"), ("expver", "band1"))


def listing(spark, d) -> DataFrame:
    kind = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'ppt' WHEN 1 THEN 'tmax' WHEN 2 THEN 'tmin' ELSE 'vpd' END")
    name = F.concat(F.lit('<a href="'), F.lit("PRISM_"), kind, F.lit("_stable_4kmD2_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit('_bil.zip">'))
    return view(spark, d, "orders").select(name.alias("value"))


@query(r"""
, lines AS (SELECT concat('<a href="PRISM_', CASE o_orderkey % 4 WHEN 0 THEN 'ppt' WHEN 1 THEN 'tmax' WHEN 2 THEN 'tmin' ELSE 'vpd' END, '_stable_4kmD2_', strftime(o_orderdate, '%Y%m%d'), '_bil.zip">') AS value FROM orders),
names AS (SELECT regexp_extract(value, 'PRISM_(ppt|tmax|tmin)_[A-Za-z0-9_]*[0-9]{8}_bil\.zip') AS name FROM lines)
SELECT regexp_extract(name, '^PRISM_([a-z]+)_', 1) AS variable, CAST(strptime(regexp_extract(name, '([0-9]{8})_bil', 1), '%Y%m%d') AS DATE) AS day, name FROM names WHERE name <> ''""")
def listing_parse(spark, d):
    return files.parse_listing(listing(spark, d))


FILES = ["dataset", "file_id"]


@query("""
SELECT o.o_orderstatus AS dataset, o.o_orderkey AS file_id,
       CASE WHEN l.file_id IS NULL AND r.file_id IS NULL THEN 'download+upload' WHEN l.file_id IS NOT NULL AND r.file_id IS NOT NULL THEN 'skip' WHEN l.file_id IS NULL THEN 'fetch' ELSE 'push' END AS action
FROM (SELECT DISTINCT o_orderstatus, o_orderkey FROM orders) o
LEFT JOIN (SELECT DISTINCT dataset, file_id FROM disk_manifest) l ON l.dataset = o.o_orderstatus AND l.file_id = o.o_orderkey
LEFT JOIN (SELECT DISTINCT dataset, file_id FROM src_manifest) r ON r.dataset = o.o_orderstatus AND r.file_id = o.o_orderkey""")
def manifest_reconcile(spark, d):
    wanted = view(spark, d, "orders").select(F.col("o_orderstatus").alias("dataset"), F.col("o_orderkey").alias("file_id"))
    return manifest.reconcile_cache(wanted, view(spark, d, "disk_manifest"), view(spark, d, "src_manifest"), FILES)


@query("""
SELECT dataset, month, unnest(generate_series(month, month + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_start
FROM (SELECT DISTINCT o_orderstatus AS dataset, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month FROM orders)""")
def period_expand(spark, d):
    months = view(spark, d, "orders").select(F.col("o_orderstatus").alias("dataset"), F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).distinct()
    return cal.expand_request(months, "month", "month")


REGISTRY = [("t2m", "reanalysis", 1940), ("tp", "gauge", 1979), ("sp", "reanalysis", 1940)]


@query("""
SELECT short_name AS dataset, provider, start_year, count(*) AS n, min(year(valid_time)) - start_year AS years_after_start
FROM grid_raw JOIN (VALUES ('t2m', 'reanalysis', 1940), ('tp', 'gauge', 1979), ('sp', 'reanalysis', 1940)) r(name, provider, start_year) ON name = short_name GROUP BY 1, 2, 3""")
def registry_join(spark, d):
    known = spark.createDataFrame(REGISTRY, "dataset string, provider string, start_year int")
    rows = raw(spark, d).withColumnRenamed("short_name", "dataset").join(F.broadcast(known), "dataset")
    return rows.groupBy("dataset", "provider", "start_year").agg(F.count(F.lit(1)).alias("n"), (F.min(F.year("time")) - F.first("start_year")).alias("years_after_start"))


# Projections --------------------------------------------------------------------------------


@query(f"SELECT {LONG} AS variable, count(*) AS n, sum(band1) AS total FROM grid_raw GROUP BY 1")
def rename_variable(spark, d):
    return standardize.rename_variable(view(spark, d, "grid_raw"), fn.LONG_NAMES).groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.sum("band1").alias("total"))


@query("SELECT short_name, valid_time AS time, lat AS latitude, lon AS longitude, revision, expver, band1 FROM grid_raw")
def rename_dims(spark, d):
    return standardize.drop_aux(standardize.rename_dims(view(spark, d, "grid_raw").withColumn("number", F.lit(0)).withColumn("crs", F.lit(""))))


@query("SELECT DISTINCT lon, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS longitude FROM grid_raw")
def wrap_longitude(spark, d):
    return view(spark, d, "grid_raw").select("lon", fn.wrap_longitude(F.col("lon")).alias("longitude")).distinct()


@query("SELECT event_id, ref_time + to_hours(step_hours) AS time FROM obs_hourly")
def valid_time(spark, d):
    return view(spark, d, "obs_hourly").select("event_id", fn.valid_time(F.col("ref_time"), F.col("step_hours")).alias("time"))


@query("SELECT path, pix_row, pix_col, value, strptime(CASE path WHEN 'A' THEN '20000101' WHEN 'N' THEN '20000102' ELSE '20000103' END, '%Y%m%d') AS time FROM grid_pixels")
def add_time(spark, d):
    name = F.expr("CASE path WHEN 'A' THEN '20000101' WHEN 'N' THEN '20000102' ELSE '20000103' END")
    return view(spark, d, "grid_pixels").withColumn("time", fn.compact_date(name).cast("timestamp_ntz"))


@query("SELECT short_name, count(*) AS n, count(CASE WHEN band1 <> -9999 THEN 1 END) AS n_valid, min(CASE WHEN band1 <> -9999 THEN band1 END) AS least, sum(CASE WHEN band1 <> -9999 THEN band1 END) AS total FROM grid_raw GROUP BY 1")
def fill_missing(spark, d):
    clean = view(spark, d, "grid_raw").withColumn("v", fn.fill_to_missing(F.col("band1"), F.lit(-9999.0)))
    return clean.groupBy("short_name").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("n_valid"), F.min("v").alias("least"), F.sum("v").alias("total"))


@query("SELECT short_name, valid_time, lat, lon, revision, band1 * CASE short_name WHEN 't2m' THEN 0.5::DOUBLE WHEN 'sp' THEN 2::DOUBLE ELSE 1::DOUBLE END + CASE short_name WHEN 't2m' THEN 10 ELSE 0 END AS value FROM grid_raw")
def decode_scale(spark, d):
    by = F.broadcast(standardize.rules(spark, RULES).select("short_name", "scale", "offset"))
    return view(spark, d, "grid_raw").join(by, "short_name").select("short_name", "valid_time", "lat", "lon", "revision", fn.decode_packed(F.col("band1"), F.col("scale"), F.col("offset")).alias("value"))


@query("SELECT time, lat_idx, lon_idx, value FROM grid_dense WHERE revision = 1")
def select_band(spark, d):
    return standardize.select_band(view(spark, d, "grid_dense"), 1, "revision")


@query("SELECT time, lat_idx, lon_idx, value FROM grid_dense WHERE revision = (SELECT max(revision) FROM grid_dense)")
def squeeze(spark, d):
    grid = view(spark, d, "grid_dense")
    last = F.broadcast(grid.agg(F.max("revision").alias("revision")))  # one row
    return standardize.squeeze(grid.join(last, "revision"), "revision").select("time", "lat_idx", "lon_idx", "value")


@query("SELECT o_orderkey, concat('{', CASE WHEN o_orderkey % 2 <> 0 THEN concat('\"x_', o_orderpriority, '\":\"', o_orderstatus, '\",') ELSE '' END, '\"units\":\"K\"}') AS attrs FROM orders")
def prune_attrs(spark, d):
    attrs = F.create_map(F.concat(F.when(F.col("o_orderkey") % 2 == 0, "GRIB_").otherwise("x_"), F.col("o_orderpriority")), F.col("o_orderstatus"), F.lit("units"), F.lit("K"))
    kept = fn.without_keys(fn.without_prefix(F.col("attrs"), "GRIB"), "history")
    return view(spark, d, "orders").select(F.col("o_orderkey"), attrs.alias("attrs")).select("o_orderkey", F.to_json(kept).alias("attrs"))


STANDARD = f"""
standard AS (SELECT {LONG} AS variable, valid_time AS time, lat AS latitude,
  CASE WHEN short_name <> 'sp' AND lon > 180 THEN lon - 360 ELSE lon END AS longitude, revision, expver = 1 AS is_final,
  CAST(CASE WHEN band1 <> -9999 THEN band1 * CASE short_name WHEN 't2m' THEN 0.5::DOUBLE WHEN 'sp' THEN 2::DOUBLE ELSE 1::DOUBLE END + CASE short_name WHEN 't2m' THEN 10 ELSE 0 END END AS FLOAT) AS value
  FROM grid_raw)"""


@query(f""", {STANDARD}
SELECT variable, min(longitude) AS west, min(latitude) AS south, max(longitude) AS east, max(latitude) AS north, min(time) AS earliest, max(time) AS latest, count(*) AS n, count(value) AS n_valid, sum(CAST(value AS DOUBLE)) AS total
FROM standard WHERE is_final AND latitude BETWEEN -60 AND 90 AND longitude BETWEEN -120 AND 120 GROUP BY 1""")
def standardize_box(spark, d):
    grid = standardize.standardize(view(spark, d, "grid_raw"), standardize.rules(spark, RULES), final_only=True)
    box = select.sel_range(select.sel_range(grid, "latitude", -60.0, 90.0), "longitude", -120.0, 120.0)
    joined = stats.spatial_extent(box, "variable").join(stats.time_span(box, "variable"), "variable")
    value = F.col("value").cast("double")
    return joined.join(box.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_valid"), F.sum(value).alias("total")), "variable")


@query(f", {STANDARD} SELECT * FROM standard")
def standardize_all(spark, d):
    return standardize.standardize(view(spark, d, "grid_raw"), standardize.rules(spark, RULES))


@query("""
SELECT file_id, concat(dataset, '_', strftime(period_start, '%Y%m%d'), '_', revision, '.nc') AS day_key, concat(dataset, '_', strftime(period_start, '%Y%m%dT%H0000'), '.nc') AS hour_key,
       concat(dataset, '_', strftime(period_start, '%Y%m'), '.nc') AS month_key, concat(dataset, '_', strftime(period_start, '%Y'), '.nc') AS year_key FROM src_manifest""")
def source_key(spark, d):
    key = lambda period, revision=None: fn.source_key(F.col("dataset"), F.col("period_start"), period, revision).alias(f"{period}_key")
    return view(spark, d, "src_manifest").select("file_id", key("day", F.col("revision")), key("hour"), key("month"), key("year"))


@query("SELECT file_id, revision, CASE WHEN file_id % 7 <> 0 THEN revision END AS parsed FROM src_manifest")
def parse_key(spark, d):
    name = F.when(F.col("file_id") % 7 == 0, fn.source_key(F.col("dataset"), F.col("period_start"), "month")).otherwise(fn.source_key(F.col("dataset"), F.col("period_start"), "day", F.col("revision")))
    return view(spark, d, "src_manifest").select("file_id", "revision", fn.parse_source_key(name).alias("parsed"))


# Selection ----------------------------------------------------------------------------------


@query("SELECT short_name, valid_time AS time, lat AS latitude, lon AS longitude, revision, expver, band1 FROM grid_raw WHERE lat BETWEEN -10 AND 10 AND lon BETWEEN 100 AND 180")
def sel_bbox(spark, d):
    return select.sel_range(select.sel_range(raw(spark, d), "latitude", -10.0, 10.0), "longitude", 100.0, 180.0)


@query("SELECT * FROM grid_dense WHERE time = TIMESTAMP '1996-03-01'")
def sel_exact(spark, d):
    return select.sel_exact(view(spark, d, "grid_dense"), "time", dt.datetime(1996, 3, 1))


@query("SELECT short_name, valid_time AS time, lat AS latitude, lon AS longitude, revision, expver, band1 FROM grid_raw WHERE valid_time >= TIMESTAMP '1996-01-01' AND valid_time < TIMESTAMP '1997-01-01'")
def sel_year(spark, d):
    return select.sel_period(raw(spark, d), "1996")


@query(f", {AXES} SELECT g.short_name AS dataset, valid_time AS time, lat AS latitude, revision, band1 FROM grid_raw g JOIN (SELECT dataset, max(coord) AS last FROM axes WHERE dim = 'latitude' GROUP BY 1) a ON a.dataset = g.short_name AND a.last = g.lat")
def isel(spark, d):
    grid = wrapped(spark, d)
    return select.isel(grid, grid_axes(spark, d), "latitude", -1).select("dataset", "time", "latitude", "revision", "band1")


@query(f""", {AXES},
n AS (SELECT dataset, max(idx) + 1 AS size FROM axes WHERE dim = 'longitude' GROUP BY 1),
s AS (SELECT dataset, CASE WHEN size <= 25 THEN 0 ELSE (size * 2654435761 + 42) % 2147483647 % (size - 25 + 1) END AS start FROM n)
SELECT a.dataset, idx, coord FROM axes a JOIN s USING (dataset) WHERE dim = 'longitude' AND idx >= start AND idx < start + 25""")
def random_window(spark, d):
    return select.random_window(grid_axes(spark, d), "longitude", 25, 42)


@query("SELECT dataset, arg_min(time, ((epoch(time)::BIGINT * 2654435761 + 7) % 2147483647, time)) AS time FROM obs_hourly GROUP BY 1")
def random_time(spark, d):
    return select.random_time(view(spark, d, "obs_hourly"), 7)


@query("SELECT short_name, revision, count(*) AS n, bool_and(expver = 1) AS all_final, count(CASE WHEN expver = 1 THEN 1 END) AS n_final FROM grid_raw GROUP BY 1, 2")
def final_flag(spark, d):
    rows = view(spark, d, "grid_raw").withColumn("f", fn.is_final(F.col("expver")))
    return rows.groupBy("short_name", "revision").agg(F.count(F.lit(1)).alias("n"), F.bool_and("f").alias("all_final"), F.count_if("f").alias("n_final"))


@query("""
SELECT o_orderstatus AS dataset, o_orderkey AS file_id FROM orders o
WHERE EXISTS (SELECT 1 FROM src_manifest s WHERE s.dataset = o_orderstatus AND s.file_id = o_orderkey) OR EXISTS (SELECT 1 FROM disk_manifest l WHERE l.dataset = o_orderstatus AND l.file_id = o_orderkey)""")
def available_semi(spark, d):
    wanted = view(spark, d, "orders").select(F.col("o_orderstatus").alias("dataset"), F.col("o_orderkey").alias("file_id"))
    return manifest.available_only(wanted, [view(spark, d, "src_manifest"), view(spark, d, "disk_manifest")], FILES)


@query("SELECT item AS id, collection, version FROM catalog_input WHERE item = (SELECT min(item) FROM catalog_input)")
def catalog_find(spark, d):
    items = view(spark, d, "catalog_input").withColumnRenamed("item", "id")
    return catalog.find(items, items.agg(F.min("id")).first()[0])


@query("SELECT dataset, file_id, size_bytes FROM src_manifest WHERE size_bytes < 1000")
def reject_small(spark, d):
    return manifest.reject_small(view(spark, d, "src_manifest")).select("dataset", "file_id", "size_bytes")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN (SELECT min(event_type) FROM events UNION SELECT max(event_type) FROM events) GROUP BY 1")
def invalid_names(spark, d):
    events = view(spark, d, "events")
    names = events.agg(F.min("event_type").alias("a"), F.max("event_type").alias("b")).select(F.explode(F.array("a", "b")).alias("event_type"))
    return manifest.invalid_names(events.select("event_type"), names, "event_type").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# Combination --------------------------------------------------------------------------------


@query(f", {LATEST} SELECT * FROM latest WHERE time < TIMESTAMP '1994-01-01' UNION ALL SELECT time, lat_idx, lon_idx, NULL, value FROM latest WHERE time >= TIMESTAMP '1994-01-01'")
def concat_outer(spark, d):
    rows = latest(spark, d)
    cut = F.lit(dt.datetime(1994, 1, 1)).cast("timestamp_ntz")
    return combine.concat_time([rows.where(F.col("time") < cut), rows.where(F.col("time") >= cut).drop("revision")])


@query(f""", {LATEST},
first_axis AS (SELECT DISTINCT lat_idx, lon_idx FROM latest WHERE time = (SELECT min(time) FROM latest))
SELECT t.time, a.lat_idx, a.lon_idx, l.revision, l.value FROM (SELECT DISTINCT time FROM latest) t CROSS JOIN first_axis a
LEFT JOIN latest l ON l.time = t.time AND l.lat_idx = a.lat_idx AND l.lon_idx = a.lon_idx""")
def concat_left(spark, d):
    rows = written(latest(spark, d))
    start = F.lit(rows.agg(F.min("time")).first()[0]).cast("timestamp_ntz")
    return combine.concat_time([rows.where(F.col("time") == start), rows.where(F.col("time") > start)], "left")


@query(f""", {LATEST}
SELECT t.time, CAST(y.range AS INT) AS lat_idx, CAST(x.range AS INT) AS lon_idx, l.revision, l.value FROM (SELECT DISTINCT time FROM latest) t, range(10) y, range(36) x
LEFT JOIN latest l ON l.time = t.time AND l.lat_idx = y.range AND l.lon_idx = x.range""")
def densify(spark, d):
    rows = latest(spark, d)
    index = lambda n, name: spark.range(n).select(F.col("id").cast("int").alias(name))
    return combine.densify(rows, {"time": view(spark, d, "grid_dense").select("time").distinct(), "lat_idx": index(10, "lat_idx"), "lon_idx": index(36, "lon_idx")})


@query(f", {LATEST} SELECT * FROM latest WHERE time >= (SELECT min(time) FROM latest WHERE revision >= 7)")
def append_aligned(spark, d):
    rows = latest(spark, d)
    return combine.append_aligned(rows.where("revision < 7"), rows.where("revision >= 7"))


@query("""
SELECT s.dataset, s.file_id, d.revision AS disk, s.revision AS source,
       CASE WHEN d.revision IS NULL THEN 'download' WHEN d.revision >= 8 THEN 'keep-final' WHEN d.revision = s.revision THEN 'keep' WHEN d.revision < s.revision THEN 'refresh' ELSE 'error' END AS action
FROM src_manifest s LEFT JOIN disk_manifest d USING (dataset, file_id)""")
def revision_decision(spark, d):
    return manifest.revision_decision(view(spark, d, "disk_manifest"), view(spark, d, "src_manifest"), FILES)


@query("""
, a AS (SELECT dataset, max(period_start) AS source_latest FROM src_manifest GROUP BY 1), b AS (SELECT dataset, max(period_start) AS store_latest FROM disk_manifest GROUP BY 1)
SELECT coalesce(a.dataset, b.dataset) AS dataset, source_latest, store_latest, coalesce(source_latest IS NOT NULL AND (store_latest IS NULL OR source_latest > store_latest), false) AS stale FROM a FULL JOIN b ON a.dataset = b.dataset""")
def freshness(spark, d):
    return manifest.freshness(*(view(spark, d, m).withColumnRenamed("period_start", "time") for m in ("src_manifest", "disk_manifest")))


@query("""
, m AS (SELECT *, revision >= 5 AS is_final FROM grid_dense)
SELECT time, lat_idx, lon_idx, revision, value, is_final FROM m QUALIFY row_number() OVER (PARTITION BY time, lat_idx, lon_idx ORDER BY is_final DESC, revision DESC, value DESC NULLS LAST) = 1""")
def supersede(spark, d):
    grid = view(spark, d, "grid_dense")
    return combine.supersede(grid.where("revision < 5"), grid.where("revision >= 5"), ["time", "lat_idx", "lon_idx"], ["revision", "value"])


@query("SELECT collection, item, 'item' AS rel, concat('ver://', version) AS href, item AS title FROM catalog_input WHERE version <> 'null'")
def catalog_links(spark, d):
    return catalog.collection_links(catalog.present(view(spark, d, "catalog_input")))


@query("SELECT collection, item AS id, version FROM catalog_input WHERE version <> 'null'")
def catalog_walk(spark, d):
    return catalog.walk_catalog(catalog.build_catalog(view(spark, d, "catalog_input")))


@query("SELECT concat(item, ' ', max(version)) AS line FROM catalog_input WHERE version <> 'null' GROUP BY item")
def catalog_listing(spark, d):
    return catalog.listing(catalog.walk_catalog(catalog.build_catalog(view(spark, d, "catalog_input"))))


@query("""
, v AS (SELECT item, max(version) AS version FROM catalog_input WHERE version <> 'null' GROUP BY 1)
SELECT concat('{', string_agg(concat('"', item, '":"', version, '"'), ',' ORDER BY item), '}') AS document FROM v""")
def listing_json(spark, d):
    return catalog.listing_json(catalog.walk_catalog(catalog.build_catalog(view(spark, d, "catalog_input"))))


@query("""
SELECT path, CAST(r.range AS INT) AS out_row, CAST(c.range AS INT) AS out_col, value FROM grid_pixels, range(17) r, range(20) c
WHERE pix_row = floor((r.range + 0.5) * 42 / 17) AND pix_col = floor((c.range + 0.5) * 50 / 20)""")
def regrid_nearest(spark, d):
    index = lambda n, name: spark.range(n).select(F.col("id").cast("int").alias(name))
    return regrid.regrid_nearest(view(spark, d, "grid_pixels"), index(17, "out_row"), index(20, "out_col"), (42 / 17, 50 / 20))


# Aggregation --------------------------------------------------------------------------------


@query("""
SELECT path, CAST(r AS INT) AS out_row, CAST(c AS INT) AS out_col, sum(value * w) / sum(w) FILTER (value IS NOT NULL) AS value,
       60::DOUBLE + (-0.25::DOUBLE * (42::DOUBLE / 10)) * (r + 0.5::DOUBLE) AS latitude, -10::DOUBLE + (0.5::DOUBLE * (50::DOUBLE / 12)) * (c + 0.5::DOUBLE) AS longitude
FROM (SELECT path, value, r.range AS r, c.range AS c, (least((pix_row + 1) * 10, (r.range + 1) * 42) - greatest(pix_row * 10, r.range * 42)) * (least((pix_col + 1) * 12, (c.range + 1) * 50) - greatest(pix_col * 12, c.range * 50)) AS w FROM grid_pixels, range(10) r, range(12) c
      WHERE least((pix_row + 1) * 10, (r.range + 1) * 42) > greatest(pix_row * 10, r.range * 42) AND least((pix_col + 1) * 12, (c.range + 1) * 50) > greatest(pix_col * 12, c.range * 50))
GROUP BY ALL""")
def downsample_mean(spark, d):
    return regrid.downsample_mean(view(spark, d, "grid_pixels"), 4, 42, 50, transform=TRANSFORM)


@query("""
SELECT path, 49 + y.range * 0.5::DOUBLE AS latitude, -12 + x.range * 0.75::DOUBLE AS longitude, value FROM grid_pixels, range(24) y, range(40) x
WHERE pix_row = floor((49 + y.range * 0.5::DOUBLE - 59.875::DOUBLE) / -0.25::DOUBLE + 0.5) AND pix_col = floor((-12 + x.range * 0.75::DOUBLE - -9.75::DOUBLE) / 0.5::DOUBLE + 0.5)""")
def regrid_to_axes(spark, d):
    axis = lambda n, name, start, step: spark.range(n).select((F.lit(start) + F.col("id") * F.lit(step)).alias(name))
    return regrid.regrid_to_axes(view(spark, d, "grid_pixels"), axis(24, "latitude", 49.0, 0.5), axis(40, "longitude", -12.0, 0.75), TRANSFORM)


@query("SELECT dataset, min(time) AS earliest, max(time) AS latest FROM obs_hourly GROUP BY 1")
def time_span(spark, d):
    return stats.time_span(view(spark, d, "obs_hourly"))


@query("SELECT short_name AS dataset, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM grid_raw GROUP BY 1")
def spatial_extent(spark, d):
    return stats.spatial_extent(raw(spark, d), "short_name").withColumnRenamed("short_name", "dataset")


@query("SELECT dataset, CAST(ceil(count(DISTINCT time) / 400) AS BIGINT) AS n_chunks FROM obs_hourly GROUP BY 1")
def chunk_count(spark, d):
    return stats.chunk_count(view(spark, d, "obs_hourly"), 400)


def items(spark, d) -> DataFrame:
    """Catalogue items with an extent and span each, of the customers of a nation and their orders."""
    entries = catalog.present(view(spark, d, "catalog_input"))
    nation, customer, orders = (view(spark, d, t) for t in ("nation", "customer", "orders"))
    own = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    spot = lambda c, n, k: ((F.col(c) % n).cast("double") * 0.25 - k)
    box = own.groupBy(F.col("n_name").alias("item")).agg(F.min(spot("o_orderkey", 1440, 180)).alias("west"), F.min(spot("c_custkey", 720, 90)).alias("south"), F.max(spot("o_orderkey", 1440, 180)).alias("east"), F.max(spot("c_custkey", 720, 90)).alias("north"), F.min("o_orderdate").alias("earliest"), F.max("o_orderdate").alias("latest"))
    return entries.join(box, "item")


ITEMS = """
own AS (SELECT n_name AS item, min((o_orderkey % 1440) * 0.25::DOUBLE - 180) AS west, min((c_custkey % 720) * 0.25::DOUBLE - 90) AS south, max((o_orderkey % 1440) * 0.25::DOUBLE - 180) AS east, max((c_custkey % 720) * 0.25::DOUBLE - 90) AS north, min(o_orderdate) AS earliest, max(o_orderdate) AS latest
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
items AS (SELECT * FROM catalog_input JOIN own USING (item) WHERE version <> 'null')"""


@query(f", {ITEMS} SELECT collection, min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north, min(earliest) AS earliest, max(latest) AS latest FROM items GROUP BY 1")
def collection_extent(spark, d):
    return catalog.collection_extent(items(spark, d))


def days(spark, d) -> DataFrame:
    """dataset, time: every day from the first to the last that orders have."""
    day = lambda end: F.date_trunc("day", end("o_orderdate")).cast("timestamp_ntz")
    bounds = view(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("dataset")).agg(day(F.min).alias("start"), day(F.max).alias("end"))
    return cal.period_calendar(bounds, "day", keys=("dataset",))


def stored_days(spark, d) -> DataFrame:
    return view(spark, d, "disk_manifest").select("dataset", F.date_trunc("day", "period_start").cast("timestamp_ntz").alias("time"))


DAYS = """
calendar AS (SELECT dataset, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS time FROM (
  SELECT o_orderstatus AS dataset, CAST(date_trunc('day', min(o_orderdate)) AS TIMESTAMP) AS a, CAST(date_trunc('day', max(o_orderdate)) AS TIMESTAMP) AS b FROM orders GROUP BY 1)),
stored AS (SELECT DISTINCT dataset, CAST(date_trunc('day', period_start) AS TIMESTAMP) AS time FROM disk_manifest)"""


@query(f", {DAYS} SELECT c.dataset, count(*) AS expected, count(s.time) AS present, count(*) - count(s.time) AS missing FROM calendar c LEFT JOIN stored s ON s.dataset = c.dataset AND s.time = c.time GROUP BY 1")
def coverage_gaps(spark, d):
    return combine.coverage(days(spark, d), stored_days(spark, d), ["dataset", "time"])


# Windows, order, sets -----------------------------------------------------------------------


@query(f", {LATEST} SELECT * FROM latest")
def latest_revision(spark, d):
    return latest(spark, d)


@query("SELECT lat, CAST(row_number() OVER (ORDER BY lat) - 1 AS INT) AS idx FROM (SELECT DISTINCT lat FROM grid_raw)")
def axis_index(spark, d):
    return stats.numbered(view(spark, d, "grid_raw").select("lat").distinct(), "lat")


@query("SELECT dataset, time, CAST(rank AS INT) AS rank FROM (SELECT dataset, time, row_number() OVER (PARTITION BY dataset ORDER BY time DESC) AS rank FROM (SELECT DISTINCT dataset, time FROM obs_hourly)) WHERE rank <= 5")
def latest_n_times(spark, d):
    return stats.latest_n_times(view(spark, d, "obs_hourly"), 5)


@query("""
SELECT dataset, previous, time, CAST(date_diff('hour', previous, time) AS DOUBLE) AS hours FROM (SELECT dataset, time, lag(time) OVER (PARTITION BY dataset ORDER BY time) AS previous FROM (SELECT DISTINCT dataset, time FROM obs_hourly))
WHERE previous IS NOT NULL AND date_diff('hour', previous, time) <> 1""")
def step_gaps(spark, d):
    return stats.step_gaps(view(spark, d, "obs_hourly"), 1)


@query("""
SELECT event_id, user_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n,
    row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) AS nw, dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('week', ts) DESC) AS rw,
    row_number() OVER (PARTITION BY user_id, date_trunc('month', ts) ORDER BY ts DESC, event_id DESC) AS nm, dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('month', ts) DESC) AS rm FROM events)
WHERE n <= 4 OR (nw = 1 AND rw <= 4) OR (nm = 1 AND rm <= 6)""")
def retention(spark, d):
    return stats.retention(view(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", "ts", "event_id")


@query(f", {AXES} SELECT g.short_name AS dataset, y.idx AS lat_idx, x.idx AS lon_idx, valid_time AS time, revision, band1 FROM grid_raw g JOIN axes y ON y.dataset = g.short_name AND y.dim = 'latitude' AND y.coord = g.lat JOIN axes x ON x.dataset = g.short_name AND x.dim = 'longitude' AND x.coord = CASE WHEN g.lon > 180 THEN g.lon - 360 ELSE g.lon END")
def sort_axes(spark, d):
    grid, axes = wrapped(spark, d), grid_axes(spark, d)
    for dim, idx in (("latitude", "lat_idx"), ("longitude", "lon_idx")):
        own = axes.where(F.col("dim") == dim).select("dataset", F.col("coord").alias(dim), F.col("idx").alias(idx))
        grid = grid.join(small(own), ["dataset", dim])
    return grid.select("dataset", "lat_idx", "lon_idx", "time", "revision", "band1").sortWithinPartitions("dataset", "lat_idx", "lon_idx", "time")


@query("SELECT DISTINCT lon FROM grid_raw WHERE short_name = 't2m' UNION SELECT DISTINCT lon FROM grid_raw WHERE short_name <> 't2m'")
def axis_union(spark, d):
    grid = view(spark, d, "grid_raw")
    return combine.concat_time([grid.where("short_name = 't2m'").select("lon"), grid.where("short_name <> 't2m'").select("lon")]).distinct()


@query(f", {DAYS} SELECT dataset, time FROM calendar EXCEPT SELECT dataset, time FROM stored")
def missing_periods(spark, d):
    return combine.missing_periods(days(spark, d), stored_days(spark, d), ["dataset", "time"])


# Functions ----------------------------------------------------------------------------------


@query("SELECT DISTINCT o_orderdate AS ts, o_orderdate + INTERVAL 1 HOUR AS next_hour, o_orderdate + INTERVAL 1 DAY AS next_day, o_orderdate + INTERVAL 1 MONTH AS next_month, o_orderdate + INTERVAL 1 YEAR AS next_year FROM orders")
def next_period(spark, d):
    ts = F.col("o_orderdate")
    return view(spark, d, "orders").select(ts.alias("ts"), *(fn.next_period(ts, p).alias(f"next_{p}") for p in ("hour", "day", "month", "year"))).distinct()


@query("""
, b AS (SELECT o_orderstatus AS dataset, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders GROUP BY 1)
SELECT dataset, CAST(day AS TIMESTAMP) AS time FROM (SELECT dataset, unnest(generate_series(a, z, INTERVAL 1 DAY)) AS day FROM b) WHERE day(day) IN (1, 11, 21)""")
def dekad_calendar(spark, d):
    bounds = view(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("dataset")).agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return cal.dekad_calendar(bounds, keys=("dataset",))


@query("SELECT dataset, make_date(year(ts)::INT, month(ts)::INT, CASE WHEN day(ts) < 11 THEN 1 WHEN day(ts) < 21 THEN 11 ELSE 21 END) AS dekad, count(*) AS n, CAST(max(value) AS DOUBLE) AS most FROM obs_hourly GROUP BY 1, 2")
def dekad_agg(spark, d):
    return view(spark, d, "obs_hourly").groupBy("dataset", fn.dekad_of(F.col("ts")).alias("dekad")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM events")
def iso_format(spark, d):
    return view(spark, d, "events").select("event_id", fn.iso_date(F.col("ts")).alias("day"), fn.iso_time(F.col("ts")).alias("instant"))


@query("""
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS day, CASE WHEN event_id % 7 <> 0 THEN date_trunc('minute', ts) END AS minute FROM events""")
def parse_dates(spark, d):
    ts = F.col("ts")
    compact = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.date_format(ts, "yyyyMMdd"))
    message = F.concat(F.lit("latest date available is: "), F.when(F.col("event_id") % 7 == 0, "not a date today").otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm")))
    return view(spark, d, "events").select("event_id", fn.compact_date(compact).alias("day"), fn.trailing_time(message).alias("minute"))


@query("""
SELECT event_id, ((a IS NULL AND b IS NULL) OR coalesce(abs(a - b) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(b), false)) AS close
FROM (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN value * CASE WHEN event_id % 2 = 0 THEN 1.000001::DOUBLE ELSE 1.001::DOUBLE END END AS a, CASE WHEN event_id % 6 <> 0 THEN value END AS b FROM events)""")
def isclose(spark, d):
    near = F.when(F.col("event_id") % 2 == 0, 1.000001).otherwise(1.001)
    a = F.when(F.col("event_id") % 3 != 0, F.col("value") * near)
    return view(spark, d, "events").select("event_id", fn.isclose(a, F.when(F.col("event_id") % 6 != 0, F.col("value"))).alias("close"))


@query("SELECT p_partkey, split_part(p_name, ' ', 2) AS second, NULL::VARCHAR AS ninth FROM part")
def split_field(spark, d):
    spaced = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", " \t "), F.lit(" "))
    second = F.coalesce(fn.split_field(spaced, 1), F.lit(""))
    return view(spark, d, "part").select("p_partkey", second.alias("second"), fn.split_field(spaced, 9).alias("ninth"))


@query(f""", {ITEMS}, s AS (SELECT item, CAST(west AS VARCHAR) AS w, CAST(south AS VARCHAR) AS s, CAST(east AS VARCHAR) AS e, CAST(north AS VARCHAR) AS n FROM items)
SELECT item, concat('{{"type":"Polygon","coordinates":[[[', e, ',', s, '],[', e, ',', n, '],[', w, ',', n, '],[', w, ',', s, '],[', e, ',', s, ']]]}}') AS geometry FROM s""")
def geo_ring(spark, d):
    return items(spark, d).select("item", fn.geo_ring(*map(F.col, ("west", "south", "east", "north"))).alias("geometry"))


STAC = ITEMS + """,
s AS (SELECT item, collection, version, CAST(west AS VARCHAR) AS w, CAST(south AS VARCHAR) AS s, CAST(east AS VARCHAR) AS e, CAST(north AS VARCHAR) AS n, strftime(earliest, '%Y-%m-%dT%H:%M:%SZ') AS a, strftime(latest, '%Y-%m-%dT%H:%M:%SZ') AS z FROM items)"""


@query(f""", {STAC}
SELECT item AS id, concat('{{"type":"Feature","stac_version":"1.0.0","id":"', item, '","collection":"', collection, '","bbox":[', w, ',', s, ',', e, ',', n, '],"geometry":{{"type":"Polygon","coordinates":[[[', e, ',', s, '],[', e, ',', n, '],[', w, ',', n, '],[', w, ',', s, '],[', e, ',', s, ']]]}},"properties":{{"start_datetime":"', a, '","end_datetime":"', z, '"}},"assets":{{"data":{{"href":"ver://', version, '"}}}}}}') AS document FROM s""")
def stac_items(spark, d):
    return catalog.stac_items(items(spark, d))


@query(f""", {STAC},
c AS (SELECT collection, CAST(min(west) AS VARCHAR) AS w, CAST(min(south) AS VARCHAR) AS s, CAST(max(east) AS VARCHAR) AS e, CAST(max(north) AS VARCHAR) AS n, strftime(min(earliest), '%Y-%m-%dT%H:%M:%SZ') AS a, strftime(max(latest), '%Y-%m-%dT%H:%M:%SZ') AS z,
        string_agg(concat('{{"rel":"item","href":"ver://', version, '","title":"', item, '"}}'), ',' ORDER BY concat('ver://', version), item) AS links FROM items GROUP BY 1)
SELECT collection AS id, concat('{{"type":"Collection","stac_version":"1.0.0","id":"', collection, '","extent":{{"spatial":{{"bbox":[[', w, ',', s, ',', e, ',', n, ']]}},"temporal":{{"interval":[["', a, '","', z, '"]]}}}},"links":[', links, ']}}') AS document FROM c""")
def stac_collections(spark, d):
    return catalog.stac_collections(items(spark, d))


@query("SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events WHERE props IS NOT NULL AND json_valid(props)")
def json_extract(spark, d):
    return view(spark, d, "events").where("props is not null and json_object_keys(props) is not null").select("event_id", F.expr("from_json(props, 'map<string,string>')[json_object_keys(props)[0]]").alias("first_value"))


# Quality ------------------------------------------------------------------------------------


@query("""
SELECT short_name AS dataset, count(DISTINCT valid_time) AS have_time, count(DISTINCT lat) AS have_latitude, count(DISTINCT valid_time) AS n_time, 721 AS n_latitude, count(DISTINCT lat) = 721 AS agrees FROM grid_raw GROUP BY 1""")
def qc_dim_counts(spark, d):
    grid = raw(spark, d).withColumnRenamed("short_name", "dataset")
    expected = grid.groupBy("dataset").agg(F.count_distinct("time").alias("n_time")).withColumn("n_latitude", F.lit(721))
    return quality.qc_dim_counts(grid, expected, ("time", "latitude"))


@query(f""", {LATEST},
a AS (SELECT time, lat_idx, lon_idx, value AS raw FROM latest
      QUALIFY row_number() OVER (PARTITION BY year(time) ORDER BY (((year(time) * 12 + month(time)) * 360 + lat_idx * 36 + lon_idx) * CAST(2654435761 AS BIGINT) + 5) % 2147483647, time, lat_idx, lon_idx) <= 150),
b AS (SELECT time, lat_idx, lon_idx, CASE WHEN revision = 3 THEN value + 1 ELSE value END AS stored FROM latest WHERE revision <> 2)
SELECT a.time, a.lat_idx, a.lon_idx, raw, stored FROM a LEFT JOIN b USING (time, lat_idx, lon_idx)
WHERE b.time IS NULL OR NOT ((raw IS NULL AND stored IS NULL) OR coalesce(abs(raw - stored) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(stored), false))""")
def qc_sample_diff(spark, d):
    rows = written(latest(spark, d))
    stored = rows.where("revision <> 2").withColumn("value", F.when(F.col("revision") == 3, F.col("value") + 1).otherwise(F.col("value")))
    number = (F.year("time") * 12 + F.month("time")).cast("long") * 360 + F.col("lat_idx") * 36 + F.col("lon_idx")
    return quality.qc_sample_diff(rows, stored, ["time", "lat_idx", "lon_idx"], F.year("time"), number, 150, 5)


@query("SELECT short_name AS dataset, count(*) AS n, count(DISTINCT valid_time) AS n_time FROM grid_raw GROUP BY 1")
def qc_dims(spark, d):
    grid = raw(spark, d).withColumnRenamed("short_name", "dataset")
    quality.qc_dims(grid)
    return grid.groupBy("dataset").agg(F.count(F.lit(1)).alias("n")).join(stats.dim_sizes(grid, ("time",)), "dataset")


@query("SELECT time, lat_idx, lon_idx, revision, count(*) AS n FROM grid_dense GROUP BY 1, 2, 3, 4 HAVING count(*) > 1")
def qc_duplicates(spark, d):
    return quality.qc_duplicates(view(spark, d, "grid_dense"), ["time", "lat_idx", "lon_idx", "revision"])


@query("SELECT short_name AS dataset, 'longitude' AS dim, CAST(idx AS INT) AS idx, lon AS coord FROM (SELECT short_name, lon, row_number() OVER (PARTITION BY short_name ORDER BY lon) - 1 AS idx FROM (SELECT DISTINCT short_name, lon FROM grid_raw)) WHERE lon > 180")
def qc_coord_range(spark, d):
    return quality.qc_coord_range(stats.axes(raw(spark, d).withColumnRenamed("short_name", "dataset"), ("latitude", "longitude")))


# Stores and streams ---------------------------------------------------------------------------

CELL = ["dataset", "time", "lat_idx", "lon_idx"]


@query("""
SELECT 'dense' AS dataset, time, lat_idx, lon_idx, revision, value FROM grid_dense
QUALIFY row_number() OVER (PARTITION BY time, lat_idx, lon_idx ORDER BY revision DESC, value DESC NULLS LAST) = 1""")
def store_versions(spark, d):
    rows = stats.latest_revision(view(spark, d, "grid_dense").withColumn("dataset", F.lit("dense")), [*CELL, "revision"], ["value"])
    root = scratch(spark)
    store.instantiate(rows.where("revision <= 3"), root)
    store.append(rows.where("revision >= 3"), root)
    return store.read_version(spark, root)


@query("""
, l AS (SELECT DISTINCT 'time' AS dim, time, NULL::BIGINT AS coord FROM grid_dense WHERE time IS NOT NULL UNION SELECT 'lat_idx', NULL, lat_idx FROM grid_dense UNION SELECT 'lon_idx', NULL, lon_idx FROM grid_dense)
SELECT 'dense' AS dataset, dim, CAST(row_number() OVER (PARTITION BY dim ORDER BY time, coord) - 1 AS INT) AS idx, time, coord FROM l""")
def store_axes(spark, d):
    """The axes that a store keeps with its second version."""
    grid, root = view(spark, d, "grid_dense").withColumn("dataset", F.lit("dense")), scratch(spark)
    store.instantiate(grid.where("time < '1995-01-01'"), root)
    store.append(grid.where("time >= '1994-06-01'"), root)
    return store.read_axes(spark, root)


def event_stream(spark, d) -> DataFrame:
    """The events file as a stream, with its columns as a batch reads them; a stream takes one file by a pattern only."""
    return spark.readStream.schema(view(spark, d, "events").schema).parquet(f"{d}/[e]vents.parquet")


@query("SELECT event_id, user_id, event_type, value FROM events")
def append_stream(spark, d):
    out = scratch(spark)
    for replay in "ab":  # the second run has forgotten the first, and adds nothing
        streams.append_stream(event_stream(spark, d), f"{out}/data", ["event_id"], f"{out}/{replay}").awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "event_type", "value")


@query("""
SELECT user_id, event_type, event_id, value, CAST(year(ts) AS INT) AS year FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, year(ts) ORDER BY event_id DESC, value DESC NULLS LAST) = 1""")
def revise_stream(spark, d):
    out = scratch(spark)
    rows = event_stream(spark, d).select("user_id", "event_type", "event_id", "value", F.year("ts").alias("year"))
    for i, part in enumerate(("event_id % 2 = 1", "true", "event_id < 50")):  # the last brings old revisions only
        streams.revise_stream(rows.where(part), f"{out}/data", ["user_id", "event_type", "year"], f"{out}/{i}", f"{out}/new", revision="event_id").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{out}/data")


@query("""
, w AS (SELECT dataset, CAST(date_trunc('day', time) AS TIMESTAMP) AS window_start, max(time) AS latest, count(*) AS n FROM obs_hourly GROUP BY 1, 2)
SELECT * FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(time) FROM obs_hourly) - INTERVAL 1 HOUR""")
def freshness_stream(spark, d):
    out = scratch(spark)
    stream = event_stream(spark, d).select(F.col("event_type").alias("dataset"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"))
    streams.freshness_stream(stream, f"{out}/data", f"{out}/c").awaitTermination()
    return spark.read.parquet(f"{out}/data")


# Streaming windows, as a batch over the same operator ------------------------------------------


@query("SELECT dataset, CAST(date_trunc('day', time) AS TIMESTAMP) AS window_start, max(time) AS latest, count(*) AS n FROM obs_hourly GROUP BY 1, 2")
def freshness_windows(spark, d):
    return streams.latest_by_window(view(spark, d, "obs_hourly"), "1 hour", "1 day")


QUERIES["standardize"] = QUERIES.pop("standardize_box")
ORACLES["standardize"] = ORACLES.pop("standardize_box")
