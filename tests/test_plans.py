"""Plans: what reaches the scan, how joins run, and that nothing meets in one task."""

import re

import pytest

from gridspark.plans.registry import QUERIES
from gridspark.sources import store

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_filters_and_columns_reach_the_scan(spark):
    said = plan(QUERIES["sel_exact"](spark, DATA))
    assert re.search(r"ReadSchema: struct<[^>]*l_shipdate", said) and "l_extendedprice" not in said
    said = plan(QUERIES["sel_year"](spark, DATA))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", said)


@pytest.mark.parametrize("name", ["standardize", "decode_scale", "registry_join", "sort_axes", "regrid_nearest", "revision_decision"])
def test_no_nested_loops(spark, name):
    assert "BroadcastNestedLoopJoin" not in plan(QUERIES[name](spark, DATA)).replace("Cross", "")


@pytest.mark.parametrize("name", ["latest_revision", "retention", "latest_n_times", "step_gaps", "axes_table", "supersede"])
def test_windows_have_keys(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_the_path(spark, name):
    assert not re.search(r"EvalPython|InPandas|InArrow", plan(QUERIES[name](spark, DATA)))


@pytest.mark.parametrize("name, scans", [("isel", 1), ("sort_axes", 1), ("scan_grid", 1), ("dim_sizes", 1), ("qc_dim_counts", 2), ("latest_revision", 1), ("concat_left", 0)])
def test_facts_are_scanned_once(spark, name, scans):
    """Axes and cubes that are used several times are written first; qc_dim_counts also scans for what it expects."""
    assert len(re.findall(r"Location: [^\n]*lineitem", plan(QUERIES[name](spark, DATA)))) == scans


@pytest.mark.parametrize("name", ["dim_sizes", "describe", "qc_dims"])
def test_labels_are_counted_without_copies_of_rows(spark, name):
    assert "Expand" not in plan(QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", ["latest_revision", "supersede", "chunk_pack"])
def test_revisions_are_combined_before_the_shuffle(spark, name):
    said = plan(QUERIES[name](spark, DATA))
    assert "Window" not in said and "partial_max" in said


def test_retention_bounds_what_a_task_sends_of_a_key(spark):
    said = plan(QUERIES["retention"](spark, DATA))
    assert "WindowGroupLimit" in said and "partial_max" in said and "Exchange" in said[said.index("WindowGroupLimit") :]


def test_samples_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["qc_sample_diff"](spark, DATA))


def test_years_are_pruned(spark, tmp_path):
    import datetime as dt

    from gridspark.operators.select import sel_range

    rows = [("a", dt.datetime(y, 1, 1), 0, 0, 1.0, 1) for y in (2019, 2020, 2021)]
    store.instantiate(spark.createDataFrame(rows, "dataset string, time timestamp_ntz, lat_idx int, lon_idx int, value double, revision int"), str(tmp_path / "s"))
    data = spark.read.parquet(f"{tmp_path}/s/data/{store.commits(spark, f'{tmp_path}/s')[0]}")
    said = plan(sel_range(data, "time", dt.datetime(2020, 1, 1), dt.datetime(2020, 12, 31), partition="year"))
    assert re.search(r"PartitionFilters: \[.*year.*>= 2020.*year.*<= 2020", said)


@pytest.mark.parametrize("name", ["latest_revision", "store_versions", "supersede", "chunk_pack"])
def test_revisions_are_hashed_where_they_are_read(spark, name):
    """A task that reads a well-packed file holds a row a key and revision, not a sort of all rows."""
    tree = plan(QUERIES[name](spark, DATA)).split("\n\n")[0].splitlines()
    scans = [i for i, line in enumerate(tree) if " Scan " in line]
    shuffle = max(i for i, line in enumerate(tree) if "Exchange" in line and i < scans[0])
    assert "HashAggregate" in "".join(tree[shuffle:]) and "Sort" not in "".join(tree[shuffle:])
