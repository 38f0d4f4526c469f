"""Axes, extents, spans, revisions, gaps and retention."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Types whose largest value is found by hashing.
_FIXED = re.compile("tinyint|smallint|int$|bigint|float|double|decimal|boolean|date|timestamp")


def numbered(axis: DataFrame, coord: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """axis with idx, from 0 by coord within keys. axis: distinct labels, never observations."""
    if keys:
        return axis.withColumn("idx", (F.row_number().over(Window.partitionBy(*keys).orderBy(coord)) - 1).cast("int"))
    # Without keys the labels would meet in one task: number within years or units, then add the counts before.
    part = F.year(coord) if dict(axis.dtypes)[coord].startswith(("timestamp", "date")) else F.floor(F.col(coord)).cast("long")
    axis = axis.withColumn("_part", part)
    counts = axis.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(coord)) - 1
    return axis.withColumn("_n", inner).join(before, "_part").withColumn("idx", (F.col("_n") + F.col("_before")).cast("int")).drop("_part", "_n", "_before")


def axes(df: DataFrame, dims: tuple[str, ...], dataset: str = "dataset") -> DataFrame:
    """dataset, dim, idx, coord: the sorted distinct labels of each dimension, missing labels left out."""
    labels = df.select(F.col(dataset).alias("dataset"), F.explode(F.create_map(*(x for d in dims for x in (F.lit(d), F.col(d).cast("double"))))).alias("dim", "coord"))
    return numbered(labels.where("coord is not null").distinct(), "coord", ("dataset", "dim"))


def labels(df: DataFrame, dims: tuple[str, ...], dataset: str = "dataset") -> DataFrame:
    """dataset, dim, label (as text): the distinct labels of each dimension, missing ones left out, in one pass; tasks combine their own first."""
    pairs = F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("label")) for d in dims))
    return df.select(F.col(dataset).alias("dataset"), F.inline(pairs)).where("label is not null").distinct()


def dim_sizes(df: DataFrame, dims: tuple[str, ...], dataset: str = "dataset") -> DataFrame:
    """Number of distinct labels of each dimension; a dimension that df lacks is an error. Datasets without any label have no row."""
    if missing := [d for d in dims if d not in df.columns]:
        raise ValueError(f"no dimension {missing[0]}")
    return labels(df, dims, dataset).groupBy(F.col("dataset").alias(dataset)).agg(*(F.count_if(F.col("dim") == d).alias(f"n_{d}") for d in dims))


def describe(df: DataFrame, dims: tuple[str, ...], variables: tuple[str, ...], dataset: str = "dataset", time: str = "time") -> DataFrame:
    """dataset, kind ('dimension' or 'variable'), name, n: labels of each dimension, values of each variable.

    A dataset without a time dimension, or without one of the named columns, is an error.
    """
    if time not in dims or (missing := [c for c in (*dims, *variables) if c not in df.columns]):
        raise ValueError("no dimension time" if time not in dims else f"no column {missing[0]}")
    counts = dim_sizes(df, dims, dataset).join(df.groupBy(dataset).agg(*(F.count(v).alias(f"v_{v}") for v in variables)), dataset)
    rows = [F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(f"{p}_{name}").alias("n")) for kind, p, names in (("dimension", "n", dims), ("variable", "v", variables)) for name in names]
    return counts.select(F.col(dataset).alias("dataset"), F.inline(F.array(*rows)))


def time_span(df: DataFrame, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """Earliest and latest time that any row of the dataset has."""
    return df.groupBy(dataset).agg(F.min(time).alias("earliest"), F.max(time).alias("latest"))


def spatial_extent(df: DataFrame, dataset: str = "dataset", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.groupBy(dataset).agg(F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north"))


def chunk_count(df: DataFrame, length: int, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """Chunks of length steps that the dataset's times fill, the last maybe in part."""
    return df.groupBy(dataset).agg(F.ceil(F.count_distinct(time) / F.lit(length)).cast("long").alias("n_chunks"))


def leading(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """keys and order of the rows among which the largest of each key is, by the columns `order`: one for each combination of all but the last.

    Tasks hash what they read, and so hold a row a combination. A largest struct they would find by
    sorting all their input, which well-packed files make many rows. Where hashing can't be (a last
    column that isn't of a fixed size) or would change a value (-0.0 among those grouped by), all rows are given.
    """
    types, (*first, last) = dict(df.dtypes), order
    if not _FIXED.match(types[last]) or any("float" in types[c] or "double" in types[c] for c in first):
        return df.select(*keys, *order)
    return df.groupBy(*keys, *first).agg(F.max(last).alias(last))


def latest_revision(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """One row for each key: that with the largest values of the columns `by`, null being the smallest; ties by the other columns.

    An aggregate, so a task combines its own rows of a key before the shuffle, and a key with many
    revisions is no task's burden.
    """
    order = [*by, *(c for c in df.columns if c not in keys and c not in by)]
    best = leading(df, keys, order).groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*(c if c in keys else F.col("_best")[c].alias(c) for c in df.columns))


def latest_n_times(df: DataFrame, n: int, dataset: str = "dataset", time: str = "time", strict: bool = True) -> DataFrame:
    """The n newest times of each dataset, newest first by rank; strict: fewer than n is an error."""
    if n < 1:
        raise ValueError("n has to be positive")
    by = Window.partitionBy(dataset).orderBy(F.desc(time))
    ranked = df.select(dataset, time).where(F.col(time).isNotNull()).distinct().withColumn("rank", F.row_number().over(by).cast("int"))
    if strict:
        ranked = ranked.withColumn("_all", F.count(F.lit(1)).over(Window.partitionBy(dataset)))
        ranked = ranked.where(F.when(F.col("_all") >= n, True).otherwise(F.raise_error(F.concat(F.lit("too few times in "), F.col(dataset).cast("string"))).cast("boolean"))).drop("_all")
    return ranked.where(F.col("rank") <= n)


def step_gaps(df: DataFrame, step_hours: int, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """Times whose distance to the one before isn't step_hours: dataset, previous, time, hours."""
    before = F.lag(time).over(Window.partitionBy(dataset).orderBy(time))
    steps = df.select(dataset, time).distinct().withColumn("previous", before).where("previous is not null")
    hours = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("previous").cast("timestamp"))) / F.lit(3_600_000_000)
    return steps.withColumn("hours", hours.cast("double")).where(F.col("hours") != step_hours)


def retention(df: DataFrame, key: str, ts: str, tie: str, last: int = 4, weekly: int = 4, monthly: int = 6) -> DataFrame:
    """Rows to keep of each key: the newest, the newest of each of the latest weeks and of the latest months.

    tie tells rows of one key and time apart. What a task sends of a key is bounded: its newest
    rows, and a row a week and month, however many rows the key has; these are merged.
    """
    row = F.struct(ts, tie, *(c for c in df.columns if c not in (key, ts, tie)))
    newest = df.groupBy(key, F.date_trunc("month", ts).alias("_month"), F.date_trunc("week", ts).alias("_week")).agg(F.max(row).alias("_row"))
    first = lambda rows, n, order: rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= n)
    of = lambda p, n: first(newest.groupBy(key, p).agg(F.max("_row").alias("_row")), n, [F.desc(p)])
    kept = [first(df, last, [F.desc(ts), F.desc(tie)]).select(key, row.alias("_row")), *(of(p, n).select(key, "_row") for p, n in (("_week", weekly), ("_month", monthly)))]
    rows = kept[0].union(kept[1]).union(kept[2]).distinct()
    return rows.select(*(key if c == key else F.col("_row")[c].alias(c) for c in df.columns))
