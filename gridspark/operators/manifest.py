"""Files wanted, there and at the source: what to fetch, refresh or keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The revision after which a period isn't published again.
LAST_REVISION = 8


def revision_action(disk: Column, source: Column, force: Column | None = None) -> Column:
    """download, keep-final, keep, refresh or error, by the revisions on disk and at the source."""
    force = F.lit(False) if force is None else F.coalesce(force, F.lit(False))
    action = F.when(disk.isNull(), "download").when(force, "refresh").when(disk >= LAST_REVISION, "keep-final").when(disk == source, "keep")
    return action.when(disk < source, "refresh").when(disk > source, "error")


def revision_decision(disk: DataFrame, source: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """keys, disk, source, action of every file at the source; one newer on disk than there is an error row."""
    joined = source.select(*keys, F.col("revision").alias("source")).join(disk.select(*keys, F.col("revision").alias("disk")), keys, "left")
    return joined.select(*keys, "disk", "source", revision_action(F.col("disk"), F.col("source"), F.lit(force)).alias("action"))


def reconcile_cache(wanted: DataFrame, local: DataFrame, remote: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """keys, action of each wanted file: download+upload (forced, or nowhere), skip (both), fetch (remote), push (local)."""
    out = wanted.select(*keys).distinct()
    for name, df in (("_local", local), ("_remote", remote)):
        out = out.join(df.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left")
    here, there = F.col("_local").isNotNull(), F.col("_remote").isNotNull()
    action = F.when(F.lit(force) | (~here & ~there), "download+upload").when(here & there, "skip").when(there, "fetch").otherwise("push")
    return out.select(*keys, action.alias("action"))


def available_only(wanted: DataFrame, manifests: list[DataFrame], keys: list[str]) -> DataFrame:
    """Wanted files that some manifest has."""
    have = manifests[0].select(*keys)
    for m in manifests[1:]:
        have = have.unionByName(m.select(*keys))
    return wanted.join(have, keys, "left_semi")


def freshness(source: DataFrame, store: DataFrame, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """dataset, source_latest, store_latest, stale: the source has a later time, or the store none at all."""
    latest = lambda df, name: df.groupBy(dataset).agg(F.max(time).alias(name))
    joined = latest(source, "source_latest").join(latest(store, "store_latest"), dataset, "full_outer")
    stale = F.col("source_latest").isNotNull() & (F.col("store_latest").isNull() | (F.col("source_latest") > F.col("store_latest")))
    return joined.withColumn("stale", F.coalesce(stale, F.lit(False)))


def reject_small(files: DataFrame, least: int = 1000, size: str = "size_bytes") -> DataFrame:
    """Files too small to be whole."""
    return files.where(F.col(size) < least)


def invalid_names(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Rows whose name is none of names; a missing name is invalid as well."""
    return rows.join(names.select(column).distinct(), column, "left_anti")
