"""Stores and streams: doing a step twice, late revisions, versions that stay readable."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridspark.operators.stats import latest_revision
from gridspark.plans.registry import QUERIES
from gridspark.session import cut_to
from gridspark.sources import files, store
from gridspark.sources.fixtures import view
from gridspark.streaming import streams

D = dt.datetime
OBS = "dataset string, time timestamp_ntz, lat_idx int, lon_idx int, value double, revision int"


def obs(spark, *cells):
    return spark.createDataFrame([("a", D(*day), 0, x, v, r) for day, x, v, r in cells], OBS)


def values(df):
    return sorted((r["time"], r["lon_idx"], r["value"]) for r in df.collect())


def test_versions(spark, tmp_path):
    root = str(tmp_path / "store")
    assert store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root).number == 1
    with pytest.raises(FileExistsError):
        store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root)
    new = obs(spark, ((2020, 1, 1), 0, 2.0, 2), ((2021, 1, 1), 0, 3.0, 1))
    second = store.append(new, root)
    assert second.number == 2
    assert store.append(new, root) == second  # nothing new
    assert store.append(new.limit(0), root) == second
    assert values(store.read_version(spark, root)) == [(D(2020, 1, 1), 0, 2.0), (D(2021, 1, 1), 0, 3.0)]
    assert values(store.read_version(spark, root, 1)) == [(D(2020, 1, 1), 0, 1.0)]
    with pytest.raises(KeyError):
        store.read_version(spark, root, 9)
    before = values(store.read_version(spark, root))
    assert store.compact(spark, root).number == 3
    assert values(store.read_version(spark, root)) == before and len(store.commits(spark, root)) == 1
    assert store.append(obs(spark, ((2020, 1, 1), 0, 7.0, 3)), root).number == 4
    assert values(store.read_version(spark, root))[0] == (D(2020, 1, 1), 0, 7.0)


def test_version_ids_are_of_contents(spark, tmp_path):
    a = obs(spark, ((2020, 1, 1), 0, 1.0, 1), ((2021, 1, 1), 1, None, 1))
    ids = [store.instantiate(df, str(tmp_path / str(i))).id for i, df in enumerate((a, a.repartition(5, "lon_idx"), a.limit(1), a.union(a)))]
    assert ids[0] == ids[1] == ids[3] and len({*ids}) == 2  # a row that is there twice counts once


def test_versions_are_never_written_twice(spark, tmp_path):
    root = str(tmp_path / "store")
    store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root)
    with pytest.raises(FileExistsError):  # as a writer that has read version 0 would
        store._claim(spark, root, 1, "other")
    assert store.commits(spark, root, 1) != ["other"]


def test_a_second_writer_starts_again(spark, tmp_path, monkeypatch):
    """Two appends read one version; the second to finish finds its number taken and adds what is still new."""
    root = str(tmp_path / "store")
    store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root)
    publish, others = store._publish, [obs(spark, ((2020, 1, 2), 0, 2.0, 1), ((2020, 1, 3), 0, 3.0, 1))]

    def late(*args, **kwargs):
        if others:
            store.append(others.pop(), root)
        return publish(*args, **kwargs)

    monkeypatch.setattr(store, "_publish", late)
    got = store.append(obs(spark, ((2020, 1, 3), 0, 3.0, 1), ((2020, 1, 4), 0, 4.0, 1)), root)
    assert got.number == 3 and [v for *_, v in values(store.read_version(spark, root))] == [1.0, 2.0, 3.0, 4.0]
    rows = store._rows(spark, root, store.commits(spark, root))
    assert rows.count() == 4  # nothing is stored twice


def test_batches_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "store")
    store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root, batch="s:0")
    first = store.append(obs(spark, ((2020, 1, 2), 0, 2.0, 1)), root, batch="s:1")
    assert store.append(obs(spark, ((2020, 1, 2), 0, 9.0, 2)), root, batch="s:1") == first
    compacted = store.compact(spark, root)
    assert compacted.id == first.id
    for b in ("s:0", "s:1"):
        assert store.append(obs(spark, ((2021, 1, 2), 0, 9.0, 2)), root, batch=b) == compacted
    assert store.append(obs(spark, ((2021, 1, 2), 0, 9.0, 2)), root, batch="s:2").number == 4


def test_a_stream_that_comes_again_is_stored_once(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    obs(spark, ((2020, 1, 1), 0, 1.0, 1), ((2020, 1, 2), 0, 2.0, 1)).write.parquet(source)
    for run in "ab":  # the second run has lost its checkpoint
        streams.append_store_stream(spark.readStream.schema(OBS).parquet(source), root, str(tmp_path / run), "obs").awaitTermination()
    assert store.latest_version(spark, root) == 1
    obs(spark, ((2020, 1, 3), 0, 3.0, 1)).write.mode("append").parquet(source)
    streams.append_store_stream(spark.readStream.schema(OBS).parquet(source), root, str(tmp_path / "b"), "obs").awaitTermination()
    assert [v for *_, v in values(store.read_version(spark, root))] == [1.0, 2.0, 3.0]


def test_one_content_has_one_id_by_any_history(spark, tmp_path):
    """At once, with revisions in two orders, compacted in between; and an append reads no more than its years."""
    final = [((2020, 1, 1), 0, 5.0, 3), ((2020, 1, 2), 1, None, 1), ((2021, 1, 1), 0, 2.0, 1)]
    old = [((2020, 1, 1), 0, 1.0, 1), ((2020, 1, 1), 0, 4.0, 2)]
    histories = [[final], [[*old, *final]], [old[:1], old[1:] + final[1:2], final], [final[:1], final[1:], old], [old, "compact", final[2:], "compact", final[:2]]]
    got = []
    for i, (first, *later) in enumerate(histories):
        root = str(tmp_path / str(i))
        store.instantiate(obs(spark, *first), root)
        for step in later:
            store.compact(spark, root) if step == "compact" else store.append(obs(spark, *step), root)
        got.append((store.version_id(spark, root), values(store.read_version(spark, root).fillna(-1.0))))
        assert store.state(store.read_version(spark, root)).said() == store._listed(spark, root, None)[-1]["content"]
    assert len({i for i, _ in got}) == 1 and all(v == got[0][1] for _, v in got)
    store.append(obs(spark, ((2020, 1, 2), 1, 0.0, 2)), str(tmp_path / "0"))
    assert store.version_id(spark, str(tmp_path / "0")) != got[0][0] == store.version_id(spark, str(tmp_path / "0"), 1)


def test_axes_are_kept_with_versions(spark, tmp_path):
    root = str(tmp_path / "store")
    store.instantiate(obs(spark, ((2020, 1, 1), 4, 1.0, 1), ((2020, 1, 1), 2, 1.0, 1)), root)
    store.append(obs(spark, ((2019, 1, 1), 3, 1.0, 1), ((2020, 1, 1), 4, 2.0, 2)), root)
    shown = lambda v: sorted((r["dim"], r["idx"], r["time"] or r["coord"]) for r in store.read_axes(spark, root, v).collect())
    assert shown(1) == [("lat_idx", 0, 0), ("lon_idx", 0, 2), ("lon_idx", 1, 4), ("time", 0, D(2020, 1, 1))]
    assert shown(2) == [("lat_idx", 0, 0), ("lon_idx", 0, 2), ("lon_idx", 1, 3), ("lon_idx", 2, 4), ("time", 0, D(2019, 1, 1)), ("time", 1, D(2020, 1, 1))]
    store.compact(spark, root)
    assert shown(3) == shown(2)
    assert all("/axes/" in x for x in store.read_axes(spark, root).inputFiles())


def test_a_store_can_begin_empty(spark, tmp_path):
    root = str(tmp_path / "store")
    first = store.instantiate(obs(spark, ((2020, 1, 1), 0, 1.0, 1)).limit(0), root)
    assert store.read_version(spark, root).count() == 0 and store.read_axes(spark, root).count() == 0
    store.append(obs(spark, ((2020, 1, 1), 0, 1.0, 1)), root)
    assert store.version_id(spark, root) != first.id and store.read_version(spark, root).count() == 1


def test_nulls_in_keys_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "store")
    odd = spark.createDataFrame([(None, D(2020, 1, 1), 0, 0, 1.0, 1), ("a", None, 0, 0, 2.0, 1), ("a", D(2020, 1, 1), None, 0, 3.0, None)], OBS)
    first = store.instantiate(odd, root)
    assert store.append(odd, root) == first and store.read_version(spark, root).count() == 3
    assert store.append(odd.where("time is null"), root) == first
    assert store.append(odd.withColumn("revision", F.lit(2)), root).number == 2
    assert store.read_version(spark, root).count() == 3 and store.state(store.read_version(spark, root)).said() == store._listed(spark, root, None)[-1]["content"]


def test_streams_with_nulls(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    odd = spark.createDataFrame([(None, D(2020, 1, 1), 0, 0, 1.0, 1), ("a", None, None, 0, 2.0, 1), ("b", D(2020, 1, 1), 0, 0, 3.0, 1)], OBS)
    odd.write.parquet(source)
    for run in "ab":
        streams.append_stream(spark.readStream.schema(OBS).parquet(source), path, ["dataset", "time", "lat_idx", "lon_idx"], str(tmp_path / run)).awaitTermination()
    assert spark.read.parquet(path).count() == 3
    years, out = str(tmp_path / "years"), str(tmp_path / "revised")
    schema = OBS + ", year int"
    with_year = odd.withColumn("year", F.year("time"))
    with_year.write.parquet(years)
    run = lambda: streams.revise_stream(spark.readStream.schema(schema).parquet(years), out, ["dataset", "time", "lat_idx", "lon_idx"], str(tmp_path / "c"), str(tmp_path / "new")).awaitTermination()
    run()
    spark.createDataFrame([("z", None, 1, 1, 4.0, 1, None), ("a", None, None, 0, 5.0, 2, None)], schema).write.mode("append").parquet(years)
    run()
    got = sorted((str(r["dataset"]), r["value"]) for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [("None", 1.0), ("a", 5.0), ("b", 3.0), ("z", 4.0)]


def test_append_stream_replays_add_nothing(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    keys = ["dataset", "time", "lat_idx", "lon_idx"]
    obs(spark, ((2020, 1, 1), 0, 1.0, 1), ((2020, 1, 2), 0, 2.0, 1)).write.parquet(source)
    for run in (1, 2):  # the second run has forgotten what it read
        streams.append_stream(spark.readStream.schema(OBS).parquet(source), path, keys, str(tmp_path / f"c{run}")).awaitTermination()
    assert spark.read.parquet(path).count() == 2
    obs(spark, ((2020, 1, 2), 0, 9.0, 1), ((2020, 1, 3), 0, 3.0, 1)).write.mode("append").parquet(source)
    streams.append_stream(spark.readStream.schema(OBS).parquet(source), path, keys, str(tmp_path / "c2")).awaitTermination()
    assert [v for _, _, v in values(spark.read.parquet(path))] == [1.0, 2.0, 3.0]


def test_revise_stream_touches_its_years_only(spark, tmp_path):
    source, path, scratch = (str(tmp_path / x) for x in ("in", "out", "scratch"))
    keys = ["dataset", "time", "lat_idx", "lon_idx"]
    with_year = lambda df: df.withColumn("year", F.year("time"))
    schema = OBS + ", year int"

    def run():
        streams.revise_stream(spark.readStream.schema(schema).parquet(source), path, keys, str(tmp_path / "c"), scratch).awaitTermination()

    with_year(obs(spark, ((2020, 1, 1), 0, 1.0, 1), ((2021, 1, 1), 0, 2.0, 1))).write.parquet(source)
    run()
    before = {p.name for p in (tmp_path / "out" / "year=2020").iterdir()}
    with_year(obs(spark, ((2021, 1, 1), 0, 5.0, 3), ((2021, 1, 1), 1, 6.0, 1))).write.mode("append").parquet(source)
    run()
    with_year(obs(spark, ((2021, 1, 1), 0, 4.0, 2))).write.mode("append").parquet(source)  # older than stored
    run()
    assert values(spark.read.parquet(path)) == [(D(2020, 1, 1), 0, 1.0), (D(2021, 1, 1), 0, 5.0), (D(2021, 1, 1), 1, 6.0)]
    assert {p.name for p in (tmp_path / "out" / "year=2020").iterdir()} == before


def test_freshness_stream_drops_late_rows(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "dataset string, time timestamp_ntz"
    for rows in ([("a", D(2020, 1, 1, 1)), ("a", D(2020, 1, 5))], [("a", D(2020, 1, 1, 9)), ("a", D(2020, 1, 9))]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        streams.freshness_stream(spark.readStream.schema(schema).parquet(source), path, str(tmp_path / "c")).awaitTermination()
    got = sorted((r["window_start"], r["latest"], r["n"]) for r in spark.read.parquet(path).collect())
    assert got[0] == (D(2020, 1, 1), D(2020, 1, 1, 1), 1)


def test_files(spark, tmp_path):
    grid = spark.createDataFrame([(1.0, 2.0)], "lat double, lon double")
    grid.write.parquet(str(tmp_path / "g1"))
    grid.withColumn("v", F.lit(3)).write.parquet(str(tmp_path / "g2"))
    both = files.read_grid(spark, str(tmp_path / "g1"), str(tmp_path / "g2"))
    assert {*both.columns} == {"latitude", "longitude", "v"} and both.count() == 2
    times = spark.createDataFrame([(D(2020, 1, d), float(d)) for d in (1, 2, 3, 4)], "valid_time timestamp_ntz, t2m double")
    for name, part in (("p1", "day(valid_time) < 3"), ("p2", "day(valid_time) > 2"), ("p3", "day(valid_time) = 2"), ("p4", "false")):
        times.where(part).write.parquet(str(tmp_path / name))
    at = lambda *names: [str(tmp_path / x) for x in names]
    assert files.read_grid(spark, *at("p1", "p2", "p4"), periods="time", names={"valid_time": "valid_time", "t2m": "band1"}).columns == ["time", "band1"]
    with pytest.raises(ValueError, match="p1 and .*p3 overlap"):
        files.read_grid(spark, *at("p2", "p3", "p1"), periods="time")
    (tmp_path / "ids.json").write_text('{\n "x": "v1",\n "y": "null"\n}')
    assert {(r["item"], r["version"]) for r in files.read_versions(spark, str(tmp_path / "ids.json")).collect()} == {("x", "v1"), ("y", None)}


def test_files_are_decoded_as_they_are_read(spark, tmp_path):
    for name in "ab":
        spark.createDataFrame([(40, 3.0), (60, None)], "row int, v double").write.parquet(str(tmp_path / name))
    got = files.read_grid(spark, str(tmp_path / "a"), str(tmp_path / "b"), decode=lambda df: df.select((90 - F.col("row") * 0.25).alias("lat"), "v"))
    assert sorted((r["latitude"], r["v"]) for r in got.where("v is not null").collect()) == [(80.0, 3.0)] * 2 and got.count() == 4


def test_a_scan_gives_the_whole_grid(spark):
    """Every column and value of the raw grid, not only what the file's own columns say under other names."""
    data = "/root/testdata/sf0.001"
    got, grid = QUERIES["scan_grid"](spark, data), view(spark, data, "grid_raw").withColumnsRenamed({"valid_time": "time", "lat": "latitude", "lon": "longitude"})
    assert got.columns == ["short_name", "time", "latitude", "longitude", "revision", "expver", "band1"] == grid.columns
    assert got.exceptAll(grid).count() == 0 == grid.exceptAll(got).count()
    assert {r[0] for r in got.select("short_name").distinct().collect()} == {"t2m", "tp", "sp"}
    assert {r[0] for r in got.select("expver").distinct().collect()} == {1, 5} and got.where("band1 = -9999").count() > 0


def test_a_large_year_goes_to_several_tasks(spark, tmp_path, monkeypatch):
    """However many rows the few cells of a year have, a task of the write sorts a bounded part of them."""
    monkeypatch.setattr(store, "PART", 1, raising=False)
    number, before = F.col("id"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    columns = [F.lit("a").alias("dataset"), F.lit(D(2020, 1, 1)).cast("timestamp_ntz").alias("time"), (number % 3).cast("int").alias("lat_idx"), F.lit(0).alias("lon_idx"), F.rand(1).alias("value"), number.cast("int").alias("revision")]
    rows, root = spark.range(0, 600_000, 1, 8).select(*columns), str(tmp_path / "store")
    store.instantiate(rows.where("revision < 300000"), root)
    store.append(rows, root)
    for commit in store.commits(spark, root):
        kept = spark.read.parquet(f"{root}/data/{commit}")
        counts = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
        assert sum(counts) == 300_000 and len(counts) > 2 and max(counts) < 150_000
    assert sorted(r["revision"] for r in store.read_version(spark, root).collect()) == [599_997, 599_998, 599_999]
    assert store.state(store.read_version(spark, root)).said() == store._listed(spark, root, None)[-1]["content"]
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before


def test_a_lower_aim_of_the_session_stays(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, "16k")
    try:
        with cut_to(spark, 16):
            assert spark.conf.get(name) == "16k"
        spark.conf.set(name, "64MB")
        with cut_to(spark, 16):
            assert spark.conf.get(name) == "16m"
        assert spark.conf.get(name) == "64MB"
    finally:
        spark.conf.unset(name)


def test_latest_revisions_keep_their_values(spark):
    """Nulls, NaN, -0.0 and texts, with other columns and without, as the largest row of each key has them."""
    odd = [("a", 1, 2.0, "x"), ("a", 1, None, "z"), ("b", None, 1.0, "x"), ("b", 1, -0.0, "y"), ("c", 2, float("nan"), None), ("c", 2, 5.0, "x"), ("d", None, None, None), ("e", 1, 3.0, "a"), ("e", 1, 3.0, "b")]
    df = spark.createDataFrame(odd * 3, "k string, revision int, value double, more string")
    want = [("a", "1", "2.0", "x"), ("b", "1", "-0.0", "y"), ("c", "2", "nan", "None"), ("d", "None", "None", "None"), ("e", "1", "3.0", "b")]
    for columns in (["k", "revision", "value", "more"], ["k", "revision", "value"], ["k", "more", "revision"], ["k", "revision"]):
        of = df.select(*columns).where("more is null or more <> 'z'" if columns[1] == "more" else "true")
        got = sorted(tuple(map(str, r)) for r in latest_revision(of, ["k"], columns[1:2]).collect())
        if columns[1] == "revision":
            assert got == [w[: len(columns)] for w in want]
        else:
            assert got == [("a", "x", "1"), ("b", "y", "1"), ("c", "x", "2"), ("d", "None", "None"), ("e", "b", "1")]
