"""Grids, listings and catalogues in files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.functions.columns import compact_date
from gridspark.operators.standardize import rename_dims


def read_grid(spark: SparkSession, *paths: str, schema: str | None = None, form: str = "parquet", names: dict[str, str] | None = None, periods: str | None = None, decode: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One grid of one or several files, dimensions by their usual names. A column that a file lacks is null there.

    names: the columns to read, by their names in the files, and what they are called. periods: a
    time column that parts the files; if the spans of two files overlap, that is an error (each
    file's least and largest time is read from its statistics where it has them). decode: what
    makes a grid of a file's rows where other names alone don't.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    grids = []
    for path in paths:
        df = reader.format(form).load(path)
        df = decode(df) if decode else df
        grids.append(rename_dims(df.select(*(F.col(c).alias(names[c]) for c in df.columns if c in names)) if names else df))
    if periods:
        spans = [tuple(df.agg(F.min(periods), F.max(periods)).first()) + (path,) for df, path in zip(grids, paths)]
        spans = sorted((x for x in spans if x[0] is not None), key=lambda x: x[:2])
        for (_, end, a), (start, _, b) in zip(spans, spans[1:]):
            if start <= end:
                raise ValueError(f"{a} and {b} overlap in {periods}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), grids)


def parse_listing(lines: DataFrame, line: str = "value") -> DataFrame:
    """variable, day, name of the daily files that lines of a directory listing name."""
    # Fixed value: how the provider names its daily files.
    name = F.regexp_extract(line, r"PRISM_(?:ppt|tmax|tmin)_[A-Za-z0-9_]*?[0-9]{8}_bil\.zip", 0)
    named = lines.select(name.alias("name")).where("name <> ''")
    return named.select(F.regexp_extract("name", r"^PRISM_([a-z]+)_", 1).alias("variable"), compact_date(F.regexp_extract("name", r"([0-9]{8})_bil", 1)).alias("day"), "name")


def listing_years(lines: DataFrame, line: str = "value") -> DataFrame:
    """year of the yearly folders that lines of a listing name."""
    return lines.select(F.regexp_extract(line, r"([12][0-9]{3})/", 1).alias("year")).where("year <> ''").select(F.col("year").cast("int"))


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """item, version of a JSON object of ids; the string 'null' is no version."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias("item", "version")).withColumn("version", F.nullif("version", F.lit("null")))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document a line."""
    documents.select(F.col("document").alias("value")).write.text(path)
