"""Catalogue of datasets: items, collections, the root, and the way down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.functions.columns import geo_ring, iso_time


def present(versions: DataFrame, version: str = "version") -> DataFrame:
    """Entries that have a version; 'null' is none."""
    return versions.where(F.col(version) != "null")


def collection_links(items: DataFrame) -> DataFrame:
    """collection, item, rel, href, title: to each item that is there; a collection without items has none."""
    return items.select("collection", "item", F.lit("item").alias("rel"), F.concat(F.lit("ver://"), F.col("version")).alias("href"), F.col("item").alias("title"))


def collection_extent(items: DataFrame) -> DataFrame:
    """Extent and span of each collection: of all its items; an item without an end leaves it open."""
    open_end = F.max(F.col("latest").isNull())
    return items.groupBy("collection").agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"), F.min("earliest").alias("earliest"), F.when(~open_end, F.max("latest")).alias("latest"))


def stac_items(items: DataFrame) -> DataFrame:
    """id, document: one GeoJSON feature an item, with extent, span and asset."""
    box = [F.col(x) for x in ("west", "south", "east", "north")]
    document = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.lit("1.0.0").alias("stac_version"),
        F.col("item").alias("id"),
        F.col("collection"),
        F.array(*box).alias("bbox"),
        F.from_json(geo_ring(*box), "type string, coordinates array<array<array<double>>>").alias("geometry"),
        F.struct(iso_time(F.col("earliest")).alias("start_datetime"), iso_time(F.col("latest")).alias("end_datetime")).alias("properties"),
        F.struct(F.struct(F.concat(F.lit("ver://"), F.col("version")).alias("href")).alias("data")).alias("assets"),
    ))
    return items.select(F.col("item").alias("id"), document.alias("document"))


def stac_collections(items: DataFrame) -> DataFrame:
    """id, document: one collection that has items, with links to them and, if items have them, extent and span of all.

    An item without an end leaves the collection's span open (null).
    """
    link = F.struct(F.col("rel"), F.col("href"), F.col("title"))
    of = collection_links(items).groupBy("collection").agg(F.array_sort(F.collect_list(link)).alias("links"))
    fields = [F.lit("Collection").alias("type"), F.lit("1.0.0").alias("stac_version"), F.col("collection").alias("id")]
    if {"west", "south", "east", "north", "earliest", "latest"} <= {*items.columns}:
        of = of.join(collection_extent(items), "collection")
        spatial = F.struct(F.array(F.array("west", "south", "east", "north")).alias("bbox"))
        temporal = F.struct(F.array(F.array(iso_time(F.col("earliest")), iso_time(F.col("latest")))).alias("interval"))
        fields.append(F.struct(spatial.alias("spatial"), temporal.alias("temporal")).alias("extent"))
    return of.select(F.col("collection").alias("id"), F.to_json(F.struct(*fields, "links")).alias("document"))


def build_catalog(items: DataFrame) -> DataFrame:
    """level, id, parent, href, document of the root, the collections that have items, and the items."""
    items = present(items)
    collections = stac_collections(items).select(F.lit("collection").alias("level"), "id", F.lit("root").alias("parent"), F.sha2("id", 256).alias("href"), "document")
    down = F.struct(F.lit("child").alias("rel"), F.col("href"), F.col("id").alias("title"))
    root = collections.agg(F.array_sort(F.collect_list(down)).alias("links")).select(F.lit("catalog").alias("level"), F.lit("root").alias("id"), F.lit(None).cast("string").alias("parent"), F.sha2(F.lit("root"), 256).alias("href"), F.to_json(F.struct(F.lit("Catalog").alias("type"), F.lit("root").alias("id"), "links")).alias("document"))
    leaves = items.select(F.lit("item").alias("level"), F.col("item").alias("id"), F.col("collection").alias("parent"), F.concat(F.lit("ver://"), F.col("version")).alias("href"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("item").alias("id"), "collection", F.struct(F.struct(F.concat(F.lit("/ver/"), F.col("version")).alias("href")).alias("data")).alias("assets"))).alias("document"))
    return root.unionByName(collections).unionByName(leaves)


_LINKS = "links array<struct<rel:string,href:string,title:string>>"


def walk_catalog(catalog: DataFrame, level: str = "item") -> DataFrame:
    """collection, id, version from the documents: root to collections to items to their assets, or less far."""
    parsed = catalog.withColumn("_d", F.from_json("document", _LINKS)).withColumn("_links", F.col("_d.links"))
    down = parsed.where("level = 'catalog'").select(F.explode("_links").alias("_l")).select(F.col("_l.href").alias("href"))
    collections = parsed.where("level = 'collection'").join(down, "href").select(F.col("id").alias("collection"), F.explode("_links").alias("_l"))
    if level == "collection":
        return collections.select("collection").distinct()
    reached = collections.select("collection", F.col("_l.href").alias("href"), F.col("_l.title").alias("id"))
    items = catalog.where("level = 'item'").select("href", "id", F.expr("substring(get_json_object(document, '$.assets.data.href'), 6)").alias("version"))
    return reached.join(items, ["href", "id"]).select("collection", "id", "version")


def listing(walked: DataFrame) -> DataFrame:
    """line: 'id version' of each item; of an id that is there more than once, the largest version."""
    return walked.groupBy("id").agg(F.max("version").alias("version")).select(F.concat_ws(" ", "id", "version").alias("line"))


def listing_json(walked: DataFrame) -> DataFrame:
    """document: one JSON object of versions by id, ids sorted. For listings that fit one document."""
    each = walked.groupBy("id").agg(F.max("version").alias("version"))
    return each.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", "version"))))).alias("document"))


def find(catalog: DataFrame, name: str) -> DataFrame:
    """Entries with exactly this id."""
    return catalog.where(F.col("id") == name)
