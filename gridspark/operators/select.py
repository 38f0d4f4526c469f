"""Selection by label, position and period."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.columns import seeded
from gridspark.session import small


def sel_range(df: DataFrame, dim: str, lo: Any = None, hi: Any = None, partition: str | None = None) -> DataFrame:
    """lo <= dim <= hi, an end that is None being open.

    partition: a column with the year of dim by which the files are laid out; its own range
    follows from the ends, so that other years' files aren't opened.
    """
    for end, test in ((lo, "__ge__"), (hi, "__le__")):
        if end is not None:
            df = df.where(getattr(F.col(dim), test)(F.lit(end)))
            if partition and isinstance(end, dt.date):
                df = df.where(getattr(F.col(partition), test)(end.year))
    return df


def sel_exact(df: DataFrame, dim: str, value: Any, strict: bool = False) -> DataFrame:
    """Rows of one label; strict: none is an error (which reads as far as the first)."""
    out = df.where(F.col(dim) == F.lit(value))
    if strict and not out.head(1):
        raise KeyError(value)
    return out


def sel_period(df: DataFrame, period: str, time: str = "time") -> DataFrame:
    """Rows of a year 'YYYY' or month 'YYYY-MM', as a half-open range that reaches the scan."""
    year, _, month = period.partition("-")
    start = dt.datetime(int(year), int(month or 1), 1)
    end = dt.datetime(start.year + (not month or start.month == 12), start.month % 12 + 1 if month else 1, 1)
    return df.where((F.col(time) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time) < F.lit(end).cast("timestamp_ntz")))


def isel(df: DataFrame, axes: DataFrame, dim: str, i: int, dataset: str = "dataset") -> DataFrame:
    """Rows at position i of a dimension's axis; -1 is the last. A position beyond the axis has none."""
    axis = axes.where(F.col("dim") == dim)
    size = axis.groupBy("dataset").agg((F.max("idx") + 1).alias("_size"))
    at = axis.join(size, "dataset").where(F.col("idx") == (F.lit(i) if i >= 0 else F.col("_size") + i))
    # One label a dataset, so few rows; the label is part of the join.
    labels = at.select(F.col("dataset").alias(dataset), F.col("coord").alias(dim))
    return df.join(small(labels), [dataset, dim]).select(*df.columns)


def random_window(axes: DataFrame, dim: str, width: int, seed: int) -> DataFrame:
    """dataset, idx, coord of a run of width labels; the whole axis where it has no more.

    The run begins at (fixed pseudo-random integer of the axis size and seed) modulo the number
    of places, so that it is the same wherever it runs.
    """
    axis = axes.where(F.col("dim") == dim)
    size = axis.groupBy("dataset").agg((F.max("idx") + 1).alias("_size"))
    start = F.when(F.col("_size") <= width, 0).otherwise(F.pmod(seeded(F.col("_size"), seed), F.col("_size") - width + 1))
    return axis.join(size.withColumn("_start", start), "dataset").where((F.col("idx") >= F.col("_start")) & (F.col("idx") < F.col("_start") + width)).select("dataset", "idx", "coord")


def random_time(df: DataFrame, seed: int, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """One time of each dataset: that with the smallest fixed pseudo-random integer."""
    key = seeded(F.unix_seconds(F.col(time).cast("timestamp")), seed)
    return df.groupBy(dataset).agg(F.min_by(time, F.struct(key, F.col(time))).alias("time"))
