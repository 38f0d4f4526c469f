"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import discard, stored


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest node beside it."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = links.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links(a, b).

    Loops, repeated links and links in both directions count once; a null end drops the link.
    Alternates large-star and small-star steps, which leave a star for each component after a
    logarithmic number of rounds; each round is written to the shared folder, so no plan grows
    and a lost executor costs one round at most. No links: no rows.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    links = stored(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    state = _state(links)
    while state[0]:
        old, links = links, stored(_small_star(_large_star(links)))
        discard(old)
        before, state = state, _state(links)
        if before == state:
            break
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
