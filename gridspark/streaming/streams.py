"""New period files as streams: idempotent appends, revisions, freshness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.operators.combine import append_new
from gridspark.operators.stats import latest_revision
from gridspark.sources import store


def _there(spark: SparkSession, path: str) -> bool:
    """Is there such a folder; reads of it give their schema, as it may hold no file yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _each_batch(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame], None]) -> StreamingQuery:
    return stream.writeStream.foreachBatch(lambda batch, _: write(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Appends the rows whose keys aren't stored, once a key: a replay of old files adds nothing.

    Of what is stored only rows between the batch's least and largest value of the first key are
    read, as files say which they hold; so the first key had better grow with time. A null in a
    key equals a null.
    """

    def write(batch: DataFrame) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(keys)
        if _there(spark, path):
            first = F.col(keys[0])
            a, b, nulls = batch.agg(F.min(first), F.max(first), F.count_if(first.isNull())).first()
            within = first.between(F.lit(a), F.lit(b)) if a is not None else F.lit(False)
            stored = spark.read.schema(new.schema).parquet(path)
            new = append_new(stored.where(within | first.isNull() if nulls else within), new, keys)
        new.write.mode("append").parquet(path)

    return _each_batch(stream, checkpoint, write)


def append_store_stream(stream: DataFrame, root: str, checkpoint: str, name: str) -> StreamingQuery:
    """Appends batches to a store of versions, each once: a batch's id, of name and its number, is part of the commit.

    A batch that failed after its version was made, or that a second run with the same checkpoint
    gives again, finds its id there; other writers may append meanwhile. The first batch makes the store.
    """

    def write(batch: DataFrame, number: int) -> None:
        if store.latest_version(batch.sparkSession, root):
            store.append(batch, root, batch=f"{name}:{number}")
        else:
            store.instantiate(batch, root, batch=f"{name}:{number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def revise_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str, scratch: str, revision: str = "revision", value: str = "value", year: str = "year") -> StreamingQuery:
    """Higher revisions take the place of lower ones; only the years that a batch touches are rewritten.

    stream has a column year, by which the store is laid out; rows without one have a place of their
    own, which is touched like a year. The new years are written to
    scratch first, as a job can't overwrite what it reads.
    """

    def write(batch: DataFrame) -> None:
        spark = batch.sparkSession
        rows = batch
        if _there(spark, path):
            touched = [r[0] for r in batch.select(year).distinct().collect()]  # few, and other years' files aren't opened
            own = F.col(year).isin([y for y in touched if y is not None])
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(path).where(own | F.col(year).isNull() if None in touched else own))
        latest_revision(rows, keys, [revision, value]).write.mode("overwrite").parquet(scratch)
        spark.read.schema(batch.schema).parquet(scratch).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)

    return _each_batch(stream, checkpoint, write)


def latest_by_window(stream: DataFrame, delay: str, length: str, dataset: str = "dataset", time: str = "time") -> DataFrame:
    """dataset, window_start, latest, n of each window of event time; rows later than delay are dropped.

    A batch table gives the same windows without dropping anything. Times without a zone are
    read as UTC, as a watermark needs a zone.
    """
    timed = stream.withColumn("_t", F.col(time).cast("timestamp"))
    if stream.isStreaming:
        timed = timed.withWatermark("_t", delay)
    out = timed.groupBy(F.window("_t", length), dataset).agg(F.max("_t").alias("latest"), F.count(F.lit(1)).alias("n"))
    return out.select(dataset, F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("latest").cast("timestamp_ntz").alias("latest"), "n")


def freshness_stream(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", length: str = "1 day") -> StreamingQuery:
    """Appends each window to path once no earlier row can come."""
    return latest_by_window(stream, delay, length).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
