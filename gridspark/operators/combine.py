"""Concatenation, alignment, appends and supersession."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.stats import latest_revision
from gridspark.session import small


def concat_time(dfs: list[DataFrame], join: str = "outer", cell: tuple[str, ...] = ("lat_idx", "lon_idx")) -> DataFrame:
    """Periods one after the other. outer: all cells; left: every period on the first one's cells.

    With left, cells the first period lacks are dropped, and cells a later period lacks are null
    there: one row for each of its times.
    """
    if join == "outer":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    if join != "left":
        raise ValueError(join)
    first, *rest = dfs
    axis = first.select(*cell).distinct()
    return reduce(DataFrame.unionByName, [first, *(on_cells(df, axis, cell) for df in rest)])


def on_cells(df: DataFrame, axis: DataFrame, cell: tuple[str, ...] = ("lat_idx", "lon_idx"), time: str = "time") -> DataFrame:
    """df on the cells of axis at each of its times; cells that it lacks are null."""
    # A product by definition: the times are sent to the cells, as long as they are few.
    frame = axis.crossJoin(small(df.select(time).distinct()))
    return frame.join(df, [time, *cell], "left").select(*df.columns)


def densify(df: DataFrame, axes: dict[str, DataFrame]) -> DataFrame:
    """Every combination of the axes' labels, with null values where df has none.

    As many rows as the product of the axes; those of a checked size are broadcast.
    """
    first, *rest = axes.values()
    frame = reduce(lambda a, b: a.crossJoin(small(b)), rest, first)
    return frame.join(df, list(axes), "left")


def append_new(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of new whose keys aren't stored: doing it twice adds nothing. A null in a key equals a null."""
    stored = existing.select(*(F.col(k).alias(f"_{k}") for k in keys))
    return new.join(stored, reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys)), "left_anti")


def append_aligned(existing: DataFrame, new: DataFrame, time: str = "time") -> DataFrame:
    """What of the two together is from new's first time on."""
    start = new.agg(F.min(time).alias("_start"))
    both = existing.unionByName(new)
    return both.join(F.broadcast(start), F.col(time) >= F.col("_start")).drop("_start")


def supersede(prelim: DataFrame, final: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Of each key the final row if there is one, else the preliminary, with the largest values of `by`; is_final says which."""
    both = prelim.withColumn("is_final", F.lit(False)).unionByName(final.withColumn("is_final", F.lit(True)))
    return latest_revision(both, keys, ["is_final", *by])


def missing_periods(calendar: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Periods wanted and not stored."""
    return calendar.select(*keys).distinct().join(present.select(*keys).distinct(), keys, "left_anti")


def coverage(calendar: DataFrame, present: DataFrame, keys: list[str], dataset: str = "dataset") -> DataFrame:
    """Of each dataset the number of periods wanted, there, and missing."""
    there = present.select(*keys).distinct().withColumn("_there", F.lit(1))
    joined = calendar.select(*keys).distinct().join(there, keys, "left")
    return joined.groupBy(dataset).agg(F.count(F.lit(1)).alias("expected"), F.count("_there").alias("present"), (F.count(F.lit(1)) - F.count("_there")).alias("missing"))
