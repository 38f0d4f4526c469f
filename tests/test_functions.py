"""Column functions and calendars at their boundaries."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridspark.functions import calendars as cal
from gridspark.functions import columns as fn

D = dt.datetime


def column(spark, values, kind, make):
    """make applied to each value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("x"))).collect()]


def test_wrap_longitude(spark):
    assert column(spark, [0.0, 180.0, 180.25, 190.0, 359.75, -170.0, None], "double", fn.wrap_longitude) == [0.0, 180.0, -179.75, -170.0, -0.25, -170.0, None]


def test_wrap_longitude_twice_is_once(spark):
    values = [x * 0.25 for x in range(-720, 1440)]
    once = column(spark, values, "double", fn.wrap_longitude)
    assert column(spark, once, "double", fn.wrap_longitude) == once


def test_fill_to_missing(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(0, -9999.0, -9999.0), (1, nan, -9999.0), (2, 5.0, nan), (3, nan, nan), (4, None, 0.0), (5, 0.0, 0.0), (6, 0.0, None)], "i int, v double, nodata double")
    got = rows.orderBy("i").select(fn.fill_to_missing(F.col("v"), F.col("nodata"))).collect()
    assert [r[0] for r in got] == [None, None, 5.0, None, None, None, 0.0]


def test_next_period_clamps_to_the_month(spark):
    ends = [D(2023, 1, 29), D(2023, 1, 31), D(2024, 1, 31), D(2024, 2, 29), D(2023, 12, 31), None]
    assert column(spark, ends, "timestamp_ntz", lambda x: fn.next_period(x, "month")) == [D(2023, 2, 28), D(2023, 2, 28), D(2024, 2, 29), D(2024, 3, 29), D(2024, 1, 31), None]
    assert column(spark, [D(2024, 2, 29)], "timestamp_ntz", lambda x: fn.next_period(x, "year")) == [D(2025, 2, 28)]
    assert column(spark, [D(2023, 12, 31, 23)], "timestamp_ntz", lambda x: fn.next_period(x, "hour")) == [D(2024, 1, 1)]
    with pytest.raises(ValueError):
        fn.next_period(F.lit(None), "week")


def test_dekads_at_every_start(spark):
    def brute(a, b):
        day, out = D(a.year, a.month, a.day), []
        while day <= b:
            out += [day] * (day.day in (1, 11, 21))
            day += dt.timedelta(days=1)
        return out

    bounds = [(i, D(2023, 1 + i % 12, day, 7), D(2023, 1 + i % 12, day) + dt.timedelta(days=span)) for i, (day, span) in enumerate((d, s) for d in (1, 2, 11, 12, 21, 22, 28) for s in (0, 9, 40))]
    bounds.append((99, D(2023, 5, 2), D(2023, 5, 1)))
    got = cal.dekad_calendar(spark.createDataFrame(bounds, "k int, start timestamp_ntz, end timestamp_ntz"), keys=("k",)).collect()
    for k, a, b in bounds:
        assert sorted(r["time"] for r in got if r["k"] == k) == brute(a, b)


def test_dekad_of(spark):
    days = [D(2023, 2, d) for d in (1, 10, 11, 20, 21, 28)]
    assert [x.day for x in column(spark, days, "timestamp_ntz", fn.dekad_of)] == [1, 1, 11, 11, 21, 21]


def test_source_keys_and_back(spark):
    ts = D(2021, 3, 4, 5, 6)
    keys = [column(spark, [ts], "timestamp_ntz", lambda x, p=p: fn.source_key(F.lit("tp"), x, p))[0] for p in ("hour", "day", "month", "year")]
    assert keys == ["tp_20210304T050000.nc", "tp_20210304.nc", "tp_202103.nc", "tp_2021.nc"]
    assert column(spark, ["a_20210304_7.nc", "a_20210304.nc", "a_7.txt", None], "string", fn.parse_source_key) == [7, None, None, None]


def test_parse_dates(spark):
    assert column(spark, ["20240229", "20230229", "x", None], "string", fn.compact_date) == [dt.date(2024, 2, 29), None, None, None]
    assert column(spark, ["up to 2024-02-29 13:00", "none", None], "string", fn.trailing_time) == [D(2024, 2, 29, 13), None, None]


def test_split_field(spark):
    assert column(spark, [" a \t b  c ", "a", "", None], "string", lambda x: fn.split_field(x, 1)) == ["b", None, None, None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e6, 1e6)), st.one_of(st.none(), st.floats(-1e6, 1e6))), min_size=1, max_size=30))
def test_isclose(spark, pairs):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    got = [r[0] for r in rows.orderBy("i").select(fn.isclose(F.col("a"), F.col("b"))).collect()]
    assert got == [a is None and b is None if a is None or b is None else abs(a - b) <= 1e-8 + 1e-5 * abs(b) for a, b in pairs]


def test_lookup(spark):
    assert column(spark, ["t2m", "tp", None], "string", lambda x: fn.lookup(x, fn.LONG_NAMES)) == ["2m_temperature", "total_precipitation", None]
    with pytest.raises(Exception, match="unknown name: q"):
        column(spark, ["q"], "string", lambda x: fn.lookup(x, fn.LONG_NAMES))


def test_attributes(spark):
    attrs = [{"GRIB_a": "1", "units": "K", "history": "h"}, {}, None]
    got = column(spark, attrs, "map<string,string>", lambda x: fn.without_keys(fn.without_prefix(x, "GRIB"), "history"))
    assert got == [{"units": "K"}, {}, None]


def test_expand_request(spark):
    one = spark.createDataFrame([(D(2024, 2, 10, 5, 30),)], "ts timestamp_ntz")
    for period, n, first in (("hour", 1, D(2024, 2, 10, 5)), ("day", 24, D(2024, 2, 10)), ("month", 29 * 24, D(2024, 2, 1))):
        hours = sorted(r["hour_start"] for r in cal.expand_request(one, period).collect())
        assert len(hours) == n and hours[0] == first and hours[-1] == first + dt.timedelta(hours=n - 1)
    with pytest.raises(ValueError):
        cal.expand_request(one, "year")


def test_slabs(spark):
    days = [D(2020, 1, 1) + dt.timedelta(days=9 * i) for i in range(101)]
    rows = spark.createDataFrame([(x,) for x in reversed(days)], "time timestamp_ntz")
    got = {r["time"]: (r["idx"], r["slab_id"]) for r in cal.slabs(rows, 32).collect()}
    assert got == {x: (i, i // 32) for i, x in enumerate(days)}
    with pytest.raises(ValueError):
        cal.slabs(rows, 0)


def test_geo_ring(spark):
    got = spark.range(1).select(fn.geo_ring(*map(F.lit, (-10, -5, 10, 5)))).first()[0]
    assert got == '{"type":"Polygon","coordinates":[[[10.0,-5.0],[10.0,5.0],[-10.0,5.0],[-10.0,-5.0],[10.0,-5.0]]]}'
