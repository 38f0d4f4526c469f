"""What several operators share: the shared scratch folder and reading tables."""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import scratch


#: Settings of a job over large texts, which queries and the pipeline make: rows and bytes of the batches that tasks
#: exchange with Python, of which an executor holds several at once; and shuffle files go when the write that
#: needed them has ended, as what is read again is a written table.
JOB = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> None:
    """Sets the session to JOB; results don't depend on it."""
    for name, value in JOB.items():
        spark.conf.set(name, value)


#: Where tables that stored() wrote lie, as long as they are held.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which driver and executors share."""
    return scratch(spark)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """df written as a table in the shared folder and read again: later stages start there."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path, partitionBy=list(partition_by) or None)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[made] = path
    return made


def discard(*tables: DataFrame) -> None:
    """Deletes tables that stored() wrote and that nothing will read again."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Characters of a text that a training sample takes at most.
SAMPLED_CHARS = 250_000


def sampled(df: DataFrame, key: str, text: str, n: int) -> list[str]:
    """Texts of about n distinct rows of key and text, and at most 2 n: those with the smallest hashes of both.

    Rows that repeat count once and rows without a key are drawn like others. Of a longer text the
    first SAMPLED_CHARS are taken, so that the driver holds a bounded sample.
    """
    place = F.pmod(F.xxhash64(key, text), F.lit(1 << 30))
    rows = df.where(F.col(text).isNotNull()).select(key, text)
    distinct = rows.select(F.approx_count_distinct(F.xxhash64(key, text))).first()[0]
    share = int((1 << 30) * min(1.0, n / max(distinct, 1)))
    chosen = rows.where(place < share).groupBy(key, text).agg(F.first(place).alias("place")).orderBy("place", key, text).limit(2 * n)
    chosen = chosen.select(key, F.substring(text, 1, SAMPLED_CHARS).alias(text)).collect()
    return [r[text] for r in sorted(chosen, key=lambda r: (r[key] is None, r[key] or 0, r[text]))]


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of whole rows with about max_bytes of a text column each, so that Python holds the strings of one run only."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, done = 0, 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(first, last - first)
        first, done = last, int(ends[last - 1])


def strings(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null reads as empty."""
    return [x or "" for x in column.to_pylist()]
