"""Where jobs keep intermediate tables, and what is small enough to be sent to all tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that is sent to all tasks at most.
SMALL_ROWS = 1_000_000


def scratch(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which driver and executors share.

    Without that setting a local folder takes its place where all runs in one process (tests);
    elsewhere its lack is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to a fresh folder and read from there: what is used several times is worked out once, and a lost executor costs no more than a read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """df marked for broadcast if it has no more than so many rows (a count tells, which stops there); a larger one is shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextmanager
def cut_to(spark: SparkSession, megabytes: int) -> Iterator[None]:
    """Within, adaptive execution aims at shuffle partitions of so many MB at most; the session's own lower aim stays."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark.conf.get(name, None)
    if own and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) <= megabytes << 20:
        yield
        return
    spark.conf.set(name, f"{megabytes}m")
    try:
        yield
    finally:
        spark.conf.set(name, own) if own else spark.conf.unset(name)
