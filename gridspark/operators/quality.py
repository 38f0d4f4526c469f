"""Checks of cubes against calendars, axes and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.functions.columns import isclose, seeded
from gridspark.operators.stats import dim_sizes


def qc_dims(df: DataFrame, dims: tuple[str, ...] = ("time", "latitude", "longitude")) -> None:
    """An error unless df has these dimensions."""
    if missing := [d for d in dims if d not in df.columns]:
        raise ValueError(f"no dimension {', '.join(missing)}")


def qc_dim_counts(df: DataFrame, expected: DataFrame, dims: tuple[str, ...], dataset: str = "dataset") -> DataFrame:
    """dataset and, for each dimension, how many labels there are, how many are expected, and if they agree.

    expected: dataset, n_<dim>.
    """
    have = dim_sizes(df, dims, dataset).withColumnsRenamed({f"n_{d}": f"have_{d}" for d in dims})
    joined = have.join(expected, dataset, "full_outer")
    agree = [F.coalesce(F.col(f"have_{d}") == F.col(f"n_{d}"), F.lit(False)) for d in dims]
    return joined.select(dataset, *(f"have_{d}" for d in dims), *(f"n_{d}" for d in dims), F.forall(F.array(*agree), lambda x: x).alias("agrees"))


def sample_cells(df: DataFrame, slab: Column, number: Column, cells: int, seed: int, keys: list[str]) -> DataFrame:
    """The same number of rows of each slab, whatever its size: those with the smallest pseudo-random integers of number, ties by keys.

    A task keeps so many rows of a slab before the shuffle (a limited window), so a large slab is no task's burden.
    """
    by = Window.partitionBy("_slab").orderBy("_at", *keys)
    placed = df.withColumns({"_slab": slab, "_at": seeded(number, seed)})
    return placed.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= cells).drop("_slab", "_at", "_n")


def qc_sample_diff(raw: DataFrame, stored: DataFrame, keys: list[str], slab: Column, number: Column, cells: int = 150, seed: int = 0, value: str = "value") -> DataFrame:
    """Sampled keys of raw whose stored values differ: keys, raw, stored. Missing equals missing; a key that isn't stored differs.

    `cells` keys a slab are drawn from raw, one row a key; of the stored rows only theirs are compared.
    """
    drawn = sample_cells(raw, slab, number, cells, seed, keys).select(*keys, F.col(value).alias("raw"))
    there = stored.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(value).alias("stored"), F.lit(True).alias("_there"))
    joined = drawn.join(there, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys)), "left")
    same = F.col("_there").isNotNull() & isclose(F.col("raw"), F.col("stored"))
    return joined.where(~same).select(*keys, "raw", "stored")


def qc_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with several rows, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def qc_coord_range(axes: DataFrame) -> DataFrame:
    """Labels of latitude and longitude beyond their range, or not above the one before them."""
    limit = F.when(F.col("dim") == "latitude", 90.0).when(F.col("dim") == "longitude", 180.0)
    before = F.lag("coord").over(Window.partitionBy("dataset", "dim").orderBy("idx"))
    return axes.withColumn("_before", before).where((F.abs("coord") > limit) | (F.col("coord") <= F.col("_before"))).drop("_before")
