"""Raw grids of any number of datasets to one convention, by rules that are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.columns import decode_packed, fill_to_missing, is_final, lookup, wrap_longitude

RULES = "short_name string, variable string, wrap_lon boolean, fill double, scale double, offset double"


def rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row for each short name: long name, wrap, fill marker, scale, offset."""
    return spark.createDataFrame(rows, RULES)


def rename_dims(df: DataFrame) -> DataFrame:
    """lat or y, lon or x, valid_time to the names used here, as far as df has them."""
    names = {"lat": "latitude", "y": "latitude", "lon": "longitude", "x": "longitude", "valid_time": "time"}
    have = {old: new for old, new in names.items() if old in df.columns}
    if len({*have.values()}) < len(have) or {*have.values()} & {*df.columns}:
        raise ValueError(f"two columns would have one name: {have}")
    return df.withColumnsRenamed(have)


def drop_aux(df: DataFrame, *names: str) -> DataFrame:
    """Without coordinates that describe the file; those it lacks don't matter."""
    return df.drop(*(names or ("number", "step", "surface", "crs", "spatial_ref", "band")))


def rename_variable(df: DataFrame, names: dict[str, str], short: str = "short_name", long: str = "variable") -> DataFrame:
    """The long name for the short one; an unknown short name is an error."""
    return df.withColumn(long, lookup(F.col(short), names)).drop(short)


def select_band(df: DataFrame, band: int, column: str = "band") -> DataFrame:
    return df.where(F.col(column) == band).drop(column)


def squeeze(df: DataFrame, dim: str) -> DataFrame:
    """df without a dimension that has one label; a second label is an error (one aggregate tells)."""
    ends = df.agg(F.min(dim).alias("a"), F.max(dim).alias("b")).first()
    if ends["a"] != ends["b"]:
        raise ValueError(f"{dim} has more than one label")
    return df.drop(dim)


def standardize(df: DataFrame, by: DataFrame, final_only: bool = False, value: str = "band1") -> DataFrame:
    """variable, time, latitude, longitude, revision, is_final, value (float).

    by: rules, one row a short name, so few that they are sent to all tasks; a short name
    without a rule is an error. Nothing is shuffled; a range of coordinates or times that is
    asked of the result reaches the scan as far as it is of the raw columns.
    """
    df = rename_dims(df)
    by = F.broadcast(by.withColumnRenamed("fill", "_fill"))
    out = df.join(by, "short_name", "left")
    known = F.when(F.col("variable").isNotNull() | F.col("short_name").isNull(), F.col("variable")).otherwise(F.raise_error(F.concat(F.lit("no rule for "), F.col("short_name"))))
    clean = decode_packed(fill_to_missing(F.col(value).cast("double"), F.col("_fill")), F.col("scale"), F.col("offset"))
    out = out.select(known.alias("variable"), "time", "latitude", F.when(F.col("wrap_lon"), wrap_longitude(F.col("longitude"))).otherwise(F.col("longitude")).alias("longitude"), "revision", is_final(F.col("expver")).alias("is_final"), clean.cast("float").alias("value"))
    return out.where("is_final") if final_only else out
