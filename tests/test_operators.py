"""Operators on small tables, with every boundary that they have to keep."""

import datetime as dt
import random
import time
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridspark.functions.columns import axis_position
from gridspark.operators import catalog, chunks, combine, manifest, quality, regrid, select, standardize, stats
from gridspark.session import small
from gridspark.sources import files

D = dt.datetime
GRID = "time timestamp_ntz, lat_idx int, lon_idx int, value double"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_standardize_one_cell_of_each_variable(spark):
    from gridspark.functions.columns import LONG_NAMES

    cells = [(k, D(2020, 1, 1), 0.0, 190.0, 1, 1, 0.0) for k in LONG_NAMES]
    df = spark.createDataFrame(cells, "short_name string, valid_time timestamp_ntz, lat double, lon double, revision int, expver int, band1 double")
    by = standardize.rules(spark, [(k, v, True, None, None, None) for k, v in LONG_NAMES.items()])
    out = standardize.standardize(df, by)
    assert {r["variable"] for r in out.collect()} == {*LONG_NAMES.values()}
    assert {r["longitude"] for r in out.collect()} == {-170.0}
    assert "time" in out.columns and "valid_time" not in out.columns
    with pytest.raises(Exception, match="no rule for"):
        standardize.standardize(df, by.where("short_name <> 'tp'")).collect()
    assert standardize.standardize(df.limit(0), by).count() == 0


def test_rename_dims_refuses_clashes(spark):
    with pytest.raises(ValueError):
        standardize.rename_dims(spark.createDataFrame([(1, 2)], "lat int, latitude int"))
    assert standardize.drop_aux(spark.createDataFrame([(1, 2)], "number int, v int")).columns == ["v"]


def test_sel_range_ends(spark):
    df = spark.createDataFrame([(float(x),) for x in range(5)], "x double")
    assert rows(select.sel_range(df, "x", 1.0, 3.0), "x") == [(1.0,), (2.0,), (3.0,)]
    assert select.sel_range(df, "x", 3.5, 3.6).count() == 0
    assert select.sel_range(df, "x", None, 1.0).count() == 2 and select.sel_range(df, "x", 3.0).count() == 2


def test_sel_exact_and_period(spark):
    df = spark.createDataFrame([(D(2019, 12, 31, 23),), (D(2020, 1, 1),), (D(2020, 12, 31),), (D(2021, 1, 1),)], "time timestamp_ntz")
    assert select.sel_exact(df, "time", D(2022, 1, 1)).count() == 0
    with pytest.raises(KeyError):
        select.sel_exact(df, "time", D(2022, 1, 1), strict=True)
    assert select.sel_period(df, "2020").count() == 2
    assert select.sel_period(df, "2020-12").count() == 1 and select.sel_period(df, "2019-12").count() == 1


@pytest.mark.parametrize("n", [1, 24, 25, 26, 60])
def test_random_window(spark, n):
    axis = spark.createDataFrame([("a", "x", i, float(i)) for i in range(n)], "dataset string, dim string, idx int, coord double")
    got = sorted(r["idx"] for r in select.random_window(axis, "x", 25, 3).collect())
    assert len(got) == min(n, 25) and got == [*range(got[0], got[0] + len(got))]


def test_isel(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("a", 2.0), ("b", 5.0)], "dataset string, x double")
    axes = stats.axes(df, ("x",))
    assert rows(select.isel(df, axes, "x", -1), "dataset", "x") == [("a", 3.0), ("b", 5.0)]
    assert rows(select.isel(df, axes, "x", 1), "dataset", "x") == [("a", 2.0)]


def test_concat_outer_and_left(spark):
    a = spark.createDataFrame([(D(2020, 1, 1), 0, x, 1.0) for x in (0, 1, 2)], GRID)
    b = spark.createDataFrame([(D(2020, 1, 2), 0, x, 2.0) for x in (1, 2, 3)], GRID)
    assert combine.concat_time([a, b]).count() == 6
    left = combine.concat_time([a, b], "left").where("time = '2020-01-02'")
    assert rows(left, "lon_idx", "value") == [(0, None), (1, 2.0), (2, 2.0)]
    with pytest.raises(ValueError):
        combine.concat_time([a, b], "inner")


def test_append_twice_is_once(spark):
    keys = ["time", "lat_idx", "lon_idx"]
    old = spark.createDataFrame([(D(2020, 1, 1), 0, 0, 1.0)], GRID)
    new = spark.createDataFrame([(D(2020, 1, 1), 0, 0, 9.0), (D(2020, 1, 2), 0, 0, 2.0)], GRID)
    first = old.unionByName(combine.append_new(old, new, keys))
    assert rows(first, "value") == [(1.0,), (2.0,)]
    assert combine.append_new(first, new, keys).count() == 0
    assert rows(combine.append_aligned(old, new.where("value = 2")), "value") == [(2.0,)]


def test_revision_decision(spark):
    cases = [(None, 3, None), (3, 3, None), (3, 5, None), (5, 3, None), (8, 1, None), (8, 8, None), (5, 5, True)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, disk int, source int, force boolean")
    got = [r[0] for r in df.orderBy("i").select(manifest.revision_action(F.col("disk"), F.col("source"), F.col("force"))).collect()]
    assert got == ["download", "keep", "refresh", "error", "keep-final", "keep-final", "refresh"]


@pytest.mark.parametrize("force", [False, True])
def test_reconcile_cache(spark, force):
    names = spark.createDataFrame([("neither",), ("both",), ("local",), ("remote",)], "name string")
    local, remote = names.where("name in ('both', 'local')"), names.where("name in ('both', 'remote')")
    got = dict(rows(manifest.reconcile_cache(names, local, remote, ["name"], force), "name", "action"))
    want = {"neither": "download+upload", "both": "skip", "local": "push", "remote": "fetch"}
    assert got == ({k: "download+upload" for k in want} if force else want)


def test_freshness(spark):
    at = lambda *x: spark.createDataFrame([(k, D(2020, 1, d)) for k, d in x], "dataset string, time timestamp_ntz")
    got = dict(rows(manifest.freshness(at(("equal", 2), ("newer", 3), ("none", 1)), at(("equal", 2), ("newer", 2), ("only", 5))), "dataset", "stale"))
    assert got == {"equal": False, "newer": True, "none": True, "only": False}


def test_small_files_and_names(spark):
    df = spark.createDataFrame([(0,), (999,), (1000,)], "size_bytes int")
    assert rows(manifest.reject_small(df), "size_bytes") == [(0,), (999,)]
    bad = manifest.invalid_names(spark.createDataFrame([("a",), ("x",), (None,)], "n string"), spark.createDataFrame([("a",)], "n string"), "n")
    assert rows(bad, "n") == [("x",), (None,)] or rows(bad, "n") == [(None,), ("x",)]


def tile(spark, h, w, missing=()):
    pixels = [-9999.0 if (r, c) in missing else float(r * w + c) for r in range(h) for c in range(w)]
    return spark.createDataFrame([("p", D(2020, 1, 1), 1, w, h, [1.0, 0.0, 10.0, 0.0, -1.0, 50.0], -9999.0, pixels)], "path string, time timestamp_ntz, band int, width int, height int, transform array<double>, nodata double, pixels array<float>")


def test_raster_points_and_block_means(spark):
    gone = {(r, c) for r in range(4) for c in range(4)}
    points = regrid.raster_to_points(tile(spark, 8, 8, gone))
    first = points.where("pix_row = 0 and pix_col = 4").first()
    assert (first["latitude"], first["longitude"], first["value"]) == (49.5, 14.5, 4.0)
    means = {(r["out_row"], r["out_col"]): r["value"] for r in regrid.downsample_mean(points, 4, 8, 8).collect()}
    block = lambda a, b: sum(r * 8 + c for r in range(a, a + 4) for c in range(b, b + 4)) / 16
    assert means == {(0, 0): None, (0, 1): block(0, 4), (1, 0): block(4, 0), (1, 1): block(4, 4)}


@pytest.mark.parametrize("height, width, k", [(7, 10, 4), (42, 50, 4), (11, 9, 2), (5, 5, 5), (6, 7, 1)])
def test_block_means_split_pixels_where_sides_do_not_divide(spark, height, width, k):
    """Against shares of areas, as fractions."""
    gone = {(r, c) for r in range(min(3, height - 1)) for c in range(min(4, width - 1))}
    points = regrid.raster_to_points(tile(spark, height, width, gone))
    got = {(r["out_row"], r["out_col"]): r["value"] for r in regrid.downsample_mean(points, k, height, width).collect()}
    rows, cols = height // k, width // k
    share = lambda i, size, out, j: max(0, min(Fraction(i + 1) * out / size, j + 1) - max(Fraction(i) * out / size, j))
    assert {*got} == {(j, i) for j in range(rows) for i in range(cols)}
    for (j, i), value in got.items():
        weights = {(r, c): share(r, height, rows, j) * share(c, width, cols, i) for r in range(height) for c in range(width) if (r, c) not in gone}
        total = sum(weights.values())
        assert (value is None) == (total == 0)
        if total:
            assert value == pytest.approx(float(sum(w * (r * width + c) for (r, c), w in weights.items()) / total))


def test_coarse_pixels_need_room(spark):
    with pytest.raises(ValueError):
        regrid.downsample_mean(regrid.raster_to_points(tile(spark, 3, 3)), 4, 3, 3)


def test_appended_chunks_are_those_of_all_cells(spark):
    """Into open and closed chunks, new and old cells, missing values, and chunks that weren't there."""
    rng = random.Random(4)
    sizes, shape = (11, 5, 7), (4, 3, 3)
    cell = lambda t: ("a", t, rng.randrange(5), rng.randrange(7), rng.choice([None, float(rng.randrange(99))]))
    old = {c[:4]: c for c in (cell(rng.randrange(6)) for _ in range(60))}
    new = {c[:4]: c for c in (cell(rng.choice([1, 5, 6, 7, 8, 10])) for _ in range(40))}
    obs = lambda cells: spark.createDataFrame([*cells], "dataset string, t_idx int, lat_idx int, lon_idx int, value double")
    stored = chunks.pack_chunks(obs(old.values()), (6, 5, 7), shape)
    got = chunks.append_chunks(stored, obs(new.values()), sizes, shape)
    want = chunks.pack_chunks(obs((old | new).values()), sizes, shape)
    shown = lambda df: sorted(map(tuple, df.select(want.columns).collect()), key=str)
    assert shown(got) == shown(want)
    changed = {tuple(r) for r in chunks.changed_chunks(stored, obs(new.values()), sizes, shape).select("t_chunk", "y_chunk", "x_chunk").collect()}
    touched = {(t // 4, y // 3, x // 3) for _, t, y, x in new}
    assert {c for c in changed if c[0] == 0} == {c for c in touched if c[0] == 0}  # of closed chunks those with new cells
    assert shown(chunks.append_chunks(stored, obs([]), (6, 5, 7), shape)) == shown(stored)
    with pytest.raises(Exception, match="only time can grow"):
        chunks.append_chunks(stored, obs([]), (6, 5, 8), shape).collect()


def test_a_slab_gives_as_many_cells_whatever_its_size(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 7, 0).otherwise(1).alias("slab"), "id")
    got = quality.sample_cells(df, F.col("slab"), F.col("id"), 50, 3, ["id"]).groupBy("slab").count().collect()
    assert {r["slab"]: r["count"] for r in got} == {0: 7, 1: 50}
    again = {r["id"] for r in quality.sample_cells(df.repartition(7), F.col("slab"), F.col("id"), 50, 3, ["id"]).collect()}
    assert again == {r["id"] for r in quality.sample_cells(df, F.col("slab"), F.col("id"), 50, 3, ["id"]).collect()}


def test_latest_revision_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None, 5.0, "a"), (1, 2, None, "b"), (1, 2, 1.0, "c"), (1, 2, 1.0, "d"), (None, 1, 1.0, "e"), (None, 3, None, "f")], "k int, revision int, value double, s string")
    got = stats.latest_revision(df, ["k"], ["revision", "value"])
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == [(1, 2, 1.0, "d"), (None, 3, None, "f")]


def test_appends_compare_nulls(spark):
    g = "a int, b string, v int"
    old = spark.createDataFrame([(1, None, 1), (None, "x", 2)], g)
    assert combine.append_new(old, old, ["a", "b"]).count() == 0
    assert rows(combine.append_new(old, spark.createDataFrame([(1, "x", 3), (None, None, 4)], g), ["a", "b"]), "v") == [(3,), (4,)]


def test_chunks_round_trip_whatever_the_partitions(spark):
    cells = [("a", t, y, x, float(t * 100 + y * 10 + x)) for t in range(3) for y in range(7) for x in range(5) if (t + y * x) % 3]
    obs = spark.createDataFrame(cells, "dataset string, t_idx int, lat_idx int, lon_idx int, value double")
    packed = chunks.pack_chunks(obs, (3, 7, 5), (2, 4, 3))
    sizes = {(r["t_chunk"], r["y_chunk"], r["x_chunk"]): len(r["values"]) for r in packed.collect()}
    assert sizes[0, 0, 0] == 24 and sizes[1, 1, 1] == 1 * 3 * 2
    assert rows(chunks.unpack_chunks(packed, (2, 4, 3)), "dataset", "t_idx", "lat_idx", "lon_idx", "value") == sorted(cells, key=str)
    ids = {chunks.version_id(chunks.chunk_digests(chunks.pack_chunks(obs.repartition(n), (3, 7, 5), (2, 4, 3)))).first()[0] for n in (1, 3, 7)}
    assert len(ids) == 1
    changed = obs.withColumn("value", F.col("value") + (F.col("t_idx") == 2).cast("int"))
    assert chunks.version_id(chunks.chunk_digests(chunks.pack_chunks(changed, (3, 7, 5), (2, 4, 3)))).first()[0] not in ids


def test_latest_n_times(spark):
    df = spark.createDataFrame([("a", D(2020, 1, d)) for d in (1, 2, 3, 3)], "dataset string, time timestamp_ntz")
    assert rows(stats.latest_n_times(df, 2), "rank", "time") == [(1, D(2020, 1, 3)), (2, D(2020, 1, 2))]
    assert stats.latest_n_times(df, 9, strict=False).count() == 3
    with pytest.raises(Exception, match="too few times"):
        stats.latest_n_times(df, 9).collect()
    with pytest.raises(ValueError):
        stats.latest_n_times(df, 0)


def test_step_gaps_and_numbers(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 1, h)) for h in (0, 1, 3, 4)], "dataset string, time timestamp_ntz")
    assert rows(stats.step_gaps(df, 1), "time", "hours") == [(D(2020, 1, 1, 3), 2.0)]
    axis = spark.createDataFrame([(x / 4,) for x in range(-9, 9)], "c double")
    assert [r["idx"] for r in stats.numbered(axis, "c").orderBy("c").collect()] == [*range(18)]


def test_retention_keeps_rows_of_the_input(spark):
    days = [("k", D(2020, 1, 1) + dt.timedelta(days=3 * i), i) for i in range(100)]
    df = spark.createDataFrame(days, "key string, ts timestamp_ntz, n int")
    kept = {r["n"] for r in stats.retention(df, "key", "ts", "n").collect()}
    assert {96, 97, 98, 99} <= kept <= {*range(100)} and len(kept) <= 14


def test_supersede(spark):
    g = "k int, revision int, value double"
    out = combine.supersede(spark.createDataFrame([(1, 9, 1.0), (2, 1, 1.0)], g), spark.createDataFrame([(1, 2, 5.0), (1, 3, 6.0)], g), ["k"], ["revision"])
    assert rows(out, "k", "value", "is_final") == [(1, 6.0, True), (2, 1.0, False)]


def test_coverage_and_missing(spark):
    p = "dataset string, time int"
    wanted, have = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], p), spark.createDataFrame([("a", 2), ("a", 2), ("c", 1)], p)
    assert rows(combine.coverage(wanted, have, ["dataset", "time"]), "dataset", "expected", "present", "missing") == [("a", 2, 1, 1), ("b", 1, 0, 1)]
    assert rows(combine.missing_periods(wanted, have, ["dataset", "time"]), "dataset", "time") == [("a", 1), ("b", 1)]


def test_catalog(spark):
    items = spark.createDataFrame([("c", "x", "v1"), ("c", "y", "null"), ("d", "z", "null"), ("e", "x2", "v1")], "collection string, item string, version string")
    built = catalog.build_catalog(items)
    assert rows(catalog.walk_catalog(built), "collection", "id", "version") == [("c", "x", "v1"), ("e", "x2", "v1")]
    assert rows(catalog.walk_catalog(built, "collection"), "collection") == [("c",), ("e",)]
    assert catalog.find(built, "X").count() == 0 and catalog.find(built, "x").count() == 1


def test_quality(spark):
    axis = lambda *x: spark.createDataFrame([("a", d, i, c) for d, i, c in x], "dataset string, dim string, idx int, coord double")
    assert quality.qc_coord_range(axis(("latitude", 0, -90.0), ("latitude", 1, 90.0), ("longitude", 0, 180.0))).count() == 0
    assert quality.qc_coord_range(axis(("latitude", 0, -90.5), ("longitude", 0, 5.0), ("longitude", 1, 5.0))).count() == 2
    g = "k int, n int, value double"
    diff = quality.qc_sample_diff(spark.createDataFrame([(1, 1, 1.0), (2, 2, None), (3, 3, 1.0)], g), spark.createDataFrame([(1, 1, 1.000001), (2, 2, None), (4, 4, 1.0)], g), ["k"], F.lit(1), F.col("n"))
    assert rows(diff, "k") == [(3,)]  # stored rows beyond the sample aren't read
    with pytest.raises(ValueError):
        quality.qc_dims(diff)
    assert rows(quality.qc_duplicates(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]), "k", "n") == [(1, 2)]


def test_listing(spark):
    lines = spark.createDataFrame([(">PRISM_ppt_stable_4kmD2_19810101_bil.zip<",), ("PRISM_vpd_stable_4kmD2_19810101_bil.zip",), ('<a href="1999/">',), (None,)], "value string")
    assert rows(files.parse_listing(lines), "variable", "day") == [("ppt", dt.date(1981, 1, 1))]
    assert rows(files.listing_years(lines), "year") == [(1999,)]


def test_filled_arrays(spark):
    df = spark.createDataFrame([([(1, 5.0), (3, None)],), ([],), ([(0, 1.0), (4, 2.0)],)], "cells array<struct<k:int,v:double>>")
    got = [r[0] for r in df.select(chunks.filled("cells", F.lit(5), F.lit(None).cast("double"))).collect()]
    assert got == [[None, 5.0, None, None, None], [None] * 5, [1.0, None, None, None, 2.0]]
    twice = spark.createDataFrame([([(1, 5.0), (1, 6.0)],)], "cells array<struct<k:int,v:double>>")
    with pytest.raises(Exception, match="two rows of one cell"):
        twice.select(chunks.filled("cells", F.lit(5))).collect()


def test_a_large_chunk_is_packed_in_one_pass(spark):
    n = 250_000
    cell = F.col("id")
    obs = spark.range(n).select(F.lit("a").alias("dataset"), F.floor(cell / 625).cast("int").alias("t_idx"), F.floor(cell % 625 / 25).cast("int").alias("lat_idx"), (cell % 25).cast("int").alias("lon_idx"), cell.cast("double").alias("value"))
    began = time.perf_counter()
    packed = chunks.pack_chunks(obs.where("id % 3 <> 1"), (400, 25, 25), (400, 25, 25)).select("values").first()[0]
    assert time.perf_counter() - began < 20
    assert packed == [None if i % 3 == 1 else float(i) for i in range(n)]


def test_small_tables_are_counted(spark):
    said = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in said(small(spark.range(5), 5)) and "broadcast" not in said(small(spark.range(6), 5))


def test_coarse_pixels_have_coordinates(spark):
    # A transform of 1 degree on 8 x 8 pixels; blocks of 4 have their centres at 2 and 6 degrees.
    points = regrid.raster_to_points(tile(spark, 8, 8))
    got = {(r["out_row"], r["out_col"]): (r["latitude"], r["longitude"]) for r in regrid.downsample_mean(points, 4, 8, 8, transform=(1.0, 0, 10.0, 0, -1.0, 50.0)).collect()}
    assert got == {(0, 0): (48.0, 12.0), (0, 1): (48.0, 16.0), (1, 0): (44.0, 12.0), (1, 1): (44.0, 16.0)}
    # Where 4 doesn't divide 7, the coarse grid is stretched over all of it.
    points = regrid.raster_to_points(tile(spark, 7, 8))
    got = {r["latitude"] for r in regrid.downsample_mean(points, 4, 7, 8, transform=(1.0, 0, 10.0, 0, -1.0, 50.0)).collect()}
    assert got == {46.5}


def test_axis_positions_and_nearest_values(spark):
    coords = spark.createDataFrame([(x,) for x in (9.4, 9.5, 10.0, 10.49, 10.5, 12.0)], "x double")
    assert [r[0] for r in coords.select(axis_position(F.col("x"), 10.0, 1.0)).collect()] == [-1, 0, 0, 0, 1, 2]
    src = spark.createDataFrame([("p", r, c, float(10 * r + c)) for r in range(3) for c in range(3)], "path string, pix_row int, pix_col int, value double")
    axis = lambda name, *x: spark.createDataFrame([(v,) for v in x], f"{name} double")
    got = regrid.regrid_to_axes(src, axis("latitude", 49.9, 48.6, 40.0), axis("longitude", 9.9, 10.2, 12.9), (1.0, 0, 10.0, 0, -1.0, 50.0))
    assert rows(got, "latitude", "longitude", "value") == [(48.6, 10.2, 10.0), (48.6, 12.9, 12.0), (49.9, 10.2, 0.0), (49.9, 12.9, 2.0)]


def test_squeeze(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "a int, b int")
    assert standardize.squeeze(df, "a").columns == ["b"]
    with pytest.raises(ValueError):
        standardize.squeeze(df, "b")


def test_describe(spark):
    df = spark.createDataFrame([("a", 1, 2, None), ("a", 1, 3, 5.0), ("b", 2, 2, 1.0)], "dataset string, time int, x int, v double")
    got = rows(stats.describe(df, ("time", "x"), ("v",)), "dataset", "kind", "name", "n")
    assert got == sorted([("a", "dimension", "time", 1), ("a", "dimension", "x", 2), ("a", "variable", "v", 1), ("b", "dimension", "time", 1), ("b", "dimension", "x", 1), ("b", "variable", "v", 1)], key=str)
    for dims, variables in ((("x",), ("v",)), (("time", "y"), ("v",)), (("time",), ("w",))):
        with pytest.raises(ValueError):
            stats.describe(df, dims, variables)


def test_listings_and_documents_as_files(spark, tmp_path):
    walked = spark.createDataFrame([("c", "x", "v1"), ("d", "x", "v2"), ("c", "a", "v3")], "collection string, id string, version string")
    assert catalog.listing_json(walked).first()[0] == '{"a":"v3","x":"v2"}'
    files.write_documents(catalog.listing_json(walked), str(tmp_path / "out"))
    assert {(r["item"], r["version"]) for r in files.read_versions(spark, str(tmp_path / "out")).collect()} == {("a", "v3"), ("x", "v2")}


def test_collections_have_the_extent_of_their_items(spark):
    import json

    items = spark.createDataFrame([("c", "x", "v1", 1.0, 2.0, 3.0, 4.0, D(2020, 1, 1), D(2020, 2, 1)), ("c", "y", "v2", 0.0, 3.0, 2.0, 9.0, D(2019, 1, 1), None)], "collection string, item string, version string, west double, south double, east double, north double, earliest timestamp_ntz, latest timestamp_ntz")
    said = json.loads(catalog.stac_collections(items).first()["document"])
    assert said["extent"]["spatial"]["bbox"] == [[0.0, 2.0, 3.0, 9.0]]
    assert said["extent"]["temporal"]["interval"] == [["2019-01-01T00:00:00Z", None]]
    assert [x["title"] for x in said["links"]] == ["x", "y"]
    assert rows(catalog.walk_catalog(catalog.build_catalog(items)), "id") == [("x",), ("y",)]
    document = json.loads(catalog.stac_items(items.where("item = 'x'")).first()["document"])
    assert document["bbox"] == [1.0, 2.0, 3.0, 4.0] and document["geometry"]["coordinates"][0][0] == [3.0, 2.0]
