"""Column functions on coordinates, values, times and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short names of reanalysis variables and the long names they are stored under.
LONG_NAMES = {
    "t2m": "2m_temperature",
    "u10": "10m_u_component_of_wind",
    "v10": "10m_v_component_of_wind",
    "u100": "100m_u_component_of_wind",
    "v100": "100m_v_component_of_wind",
    "sp": "surface_pressure",
    "ssrd": "surface_solar_radiation_downwards",
    "tp": "total_precipitation",
}


def lookup(name: Column, names: dict[str, str], strict: bool = True) -> Column:
    """The name that names has for it; an unknown name is an error, or null if not strict."""
    found = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[name]
    return found if not strict else F.when(found.isNotNull() | name.isNull(), found).otherwise(F.raise_error(F.concat(F.lit("unknown name: "), name)))


def wrap_longitude(lon: Column) -> Column:
    """0..360 to (-180, 180]; 180 itself stays."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def fill_to_missing(value: Column, marker: Column | None = None) -> Column:
    """Null for NaN and for the marker; a null or NaN marker marks nothing more."""
    gone = F.isnan(value) if marker is None else F.isnan(value) | F.coalesce(~F.isnan(marker) & (value == marker), F.lit(False))
    return F.when(~gone, value)


def decode_packed(value: Column, scale: Column, offset: Column) -> Column:
    """value * scale + offset; null parameters mean 1 and 0."""
    return value * F.coalesce(scale, F.lit(1.0)) + F.coalesce(offset, F.lit(0.0))


def valid_time(ref_time: Column, step_hours: Column) -> Column:
    """The reference time moved on by a step."""
    return ref_time + F.make_dt_interval(F.lit(0), step_hours)


def next_period(ts: Column, period: str) -> Column:
    """ts one hour, day, month or year later; a day that the month lacks becomes its last."""
    if period in {"hour", "day"}:
        return ts + F.expr(f"INTERVAL '1' {period.upper()}")
    if period in {"month", "year"}:
        return ts + F.make_ym_interval(F.lit(int(period == "year")), F.lit(int(period == "month")))
    raise ValueError(period)


def dekad_of(ts: Column) -> Column:
    """First day of the ten-day period: the 1st, 11th or 21st."""
    day = F.dayofmonth(ts)
    return F.make_date(F.year(ts), F.month(ts), F.when(day < 11, 1).when(day < 21, 11).otherwise(21))


def source_key(dataset: Column, ts: Column, period: str, revision: Column | None = None) -> Column:
    """A provider's file name: dataset_, the time in the period's form, _revision if given, .nc."""
    form = {"hour": "yyyyMMdd'T'HH'0000'", "day": "yyyyMMdd", "month": "yyyyMM", "year": "yyyy"}[period]
    parts = [dataset, F.lit("_"), F.date_format(ts, form)] + ([F.lit("_"), revision.cast("string")] if revision is not None else [])
    return F.concat(*parts, F.lit(".nc"))


def parse_source_key(name: Column) -> Column:
    """The revision, the digit before .nc; null where there is none."""
    return F.nullif(F.regexp_extract(name, r"_(\d)\.nc$", 1), F.lit("")).cast("int")


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def iso_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def compact_date(text: Column) -> Column:
    """A date of the form YYYYMMDD; null where it isn't one."""
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def trailing_time(message: Column) -> Column:
    """The time in the last 16 characters, YYYY-MM-DD HH:MM; null where it isn't one."""
    return F.try_to_timestamp(F.right(message, F.lit(16)), F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


def split_field(text: Column, n: int) -> Column:
    """Field n, from 0, of fields parted by white space; null beyond the last."""
    return F.get(F.split(F.trim(text), r"\s+"), n)


def is_final(expver: Column) -> Column:
    """Version 1 is final."""
    return expver.cast("int") == 1


def isclose(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|a - b| <= atol + rtol |b|, b being the stored value; missing equals missing."""
    return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= atol + rtol * F.abs(b), F.lit(False))


def axis_position(coord: Column, origin: float, step: float) -> Column:
    """Index of a coordinate on a regular axis, the nearest; half a step goes up."""
    return F.floor((coord - F.lit(origin)) / F.lit(step) + 0.5).cast("int")


def pixel_centre(transform: tuple[float, ...], row: Column, col: Column, scale: tuple[float, float] = (1.0, 1.0)) -> tuple[Column, Column]:
    """Latitude and longitude of a pixel's centre by an affine transform (a, b, c, d, e, f) without rotation.

    scale: rows and columns of the transform's own grid that one row and column here stand for.
    """
    a, _, c, _, e, f = map(float, transform)
    return F.lit(f) + F.lit(e * scale[0]) * (row + 0.5), F.lit(c) + F.lit(a * scale[1]) * (col + 0.5)


def geo_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """GeoJSON polygon of a box: from south-east round by north."""
    corner = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    ring = F.array(corner(east, south), corner(east, north), corner(west, north), corner(west, south), corner(east, south))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


def seeded(key: Column, seed: int) -> Column:
    """A fixed pseudo-random integer below 2**31 - 1, which SQL can compute as well."""
    return F.pmod(key.cast("long") * F.lit(2654435761) + F.lit(seed), F.lit(2147483647))


def without_prefix(attrs: Column, prefix: str) -> Column:
    """A map without the keys that begin so."""
    return F.map_filter(attrs, lambda k, v: ~F.startswith(k, F.lit(prefix)))


def without_keys(attrs: Column, *keys: str) -> Column:
    return F.map_filter(attrs, lambda k, v: ~k.isin(*keys))
