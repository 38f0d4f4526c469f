"""A store of immutable versions in plain folders.

data/<commit> holds rows, axes/<commit> the sorted labels as they are after that commit,
lists/<commit> the commits that make up a version, and the file versions/<n> says which list the
n-th version is. That file is made last and only where there is none (create without overwriting,
which file systems with a name node do atomically), so a reader sees a version whole or not at all
and of two writers of one number one is refused; append then starts again from what the other has
stored. Data folders are never changed; a revision of a period is written anew and takes the old
one's place by the key's latest revision. compact() makes a version of one commit that holds one
row a key and is read as it is.

A list keeps, for each commit, the state of the rows after it: their number and sums of hashes, a
multiset's hash that rows can be added to and taken from. So an append costs the new rows and the
keys that they revise, and stores of the same rows have one id, however these came to be there.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark.operators.combine import append_new
from gridspark.operators.stats import latest_revision, leading
from gridspark.session import cut_to

KEYS = ["dataset", "time", "lat_idx", "lon_idx"]
#: Of rows of one key the one with the largest counts.
BY = ["revision", "value"]
#: Cells of a side of the squares that a dataset's year is dealt to tasks and files by.
TILE = 128
#: MB of shuffled rows of a square's year above which it goes to several tasks and files.
PART = 16
_LISTED = "n int, commit string, content string, latest boolean, batch string"
#: Sums of hashes are of so many bits.
_HASHES, _BITS = 3, 40
#: How often append starts again because another writer was first.
ATTEMPTS = 10


class Version(NamedTuple):
    """A version's number, and an id that equal contents have in any store."""

    number: int
    id: str


class State(NamedTuple):
    """The number of rows of a multiset and sums of their hashes; states add and subtract as the multisets do."""

    n: int
    sums: tuple[int, ...]

    def plus(self, other: State, sign: int = 1) -> State:
        return State(self.n + sign * other.n, tuple(a + sign * b for a, b in zip(self.sums, other.sums)))

    def said(self) -> str:
        return ",".join(map(str, (self.n, *self.sums)))

    @classmethod
    def read(cls, said: str) -> State:
        n, *sums = map(int, said.split(","))
        return cls(n, tuple(sums))


def _sums(columns: list[Column], there: Column) -> list[Column]:
    """Aggregates: how many rows are there, and the sums of their hashes. Which columns are null is hashed as well."""
    nulls = F.array(*(c.isNull() for c in columns))
    hashes = [(F.xxhash64(F.lit(k), nulls, *columns) % (1 << _BITS)).cast("decimal(38,0)") for k in range(_HASHES)]
    return [F.count_if(there), *(F.coalesce(F.sum(F.when(there, h)), F.lit(0).cast("decimal(38,0)")) for h in hashes)]


def _columns(df: DataFrame) -> list[str]:
    return sorted(c for c in df.columns if c != "year")


def state(df: DataFrame) -> State:
    """Of the rows, whatever their order and tasks. It tells contents apart; it is no safeguard against forgery."""
    n, *sums = df.agg(*_sums([F.col(c) for c in _columns(df)], F.lit(True))).first()
    return State(n, tuple(map(int, sums)))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def latest_version(spark: SparkSession, root: str) -> int:
    """The number of the newest version, or 0 where there is no store."""
    fs, at = _fs(spark, f"{root}/versions")
    if not fs.exists(at):
        return 0
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    return max((int(x) for x in names if x.isdigit()), default=0)


def _create(spark: SparkSession, path: str, text: str) -> None:
    """A file with this text; FileExistsError where there is one."""
    fs, at = _fs(spark, path)
    try:
        out = fs.create(at, False)
    except Exception:
        if fs.exists(at):
            raise FileExistsError(path) from None
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _claim(spark: SparkSession, root: str, number: int, commit: str) -> None:
    """Makes the list of commit the version of this number; FileExistsError where there is one."""
    _create(spark, f"{root}/versions/{number}", commit)


def _listed(spark: SparkSession, root: str, version: int | None) -> list:
    version = version or latest_version(spark, root)
    fs, at = _fs(spark, f"{root}/versions/{version}")
    if not version or not fs.exists(at):
        raise KeyError(version)
    commit = spark.read.text(f"{root}/versions/{version}").first()[0]
    return spark.read.schema(_LISTED).parquet(f"{root}/lists/{commit}").orderBy("n").collect()


def _version(spark: SparkSession, root: str, number: int) -> Version:
    content = _listed(spark, root, number)[-1]["content"]
    return Version(number, spark.range(1).select(F.substring(F.sha2(F.lit(content), 256), 1, 32)).first()[0])


def version_id(spark: SparkSession, root: str, version: int | None = None) -> str:
    """The id of a version, the newest by default: of the rows that reading it gives."""
    return _version(spark, root, version or latest_version(spark, root)).id


def _now(spark: SparkSession, root: str) -> Version:
    return _version(spark, root, latest_version(spark, root))


def commits(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    return [r["commit"] for r in _listed(spark, root, version)]


def _rows(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    schema = lambda c: StructType.fromJson(json.loads(spark.read.text(f"{root}/data/{c}-schema").first()[0]))
    first, *rest = (spark.read.schema(schema(c)).parquet(f"{root}/data/{c}") for c in names)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rest, first)


def _labels(df: DataFrame) -> DataFrame:
    """dataset, dim, time, coord: the distinct labels of the axes; time is null but for the axis of times, coord there."""
    pairs = [F.struct(F.lit("time").alias("dim"), F.col("time"), F.lit(None).cast("long").alias("coord"))]
    pairs += [F.struct(F.lit(c).alias("dim"), F.lit(None).cast(dict(df.dtypes)["time"]).alias("time"), F.col(c).cast("long").alias("coord")) for c in KEYS[2:]]
    return df.select("dataset", F.inline(F.array(*pairs))).where("time is not null or coord is not null").distinct()


def read_axes(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """dataset, dim (time, lat_idx, lon_idx), idx, time, coord of a version: its sorted labels, as kept with it. No rows are read."""
    labels = spark.read.parquet(f"{root}/axes/{_listed(spark, root, version)[-1]['commit']}")
    return labels.withColumn("idx", (F.row_number().over(Window.partitionBy("dataset", "dim").orderBy("time", "coord")) - 1).cast("int"))


def _write(df: DataFrame, root: str) -> tuple[str, DataFrame]:
    """A commit of df, and its rows as written, with their year."""
    commit, df = uuid.uuid4().hex, df.withColumn("year", F.year("time"))
    tile = {f"_{c}": F.floor(F.col(c) / TILE) for c in ("lat_idx", "lon_idx")}
    dealt = df.withColumns(tile).hint("rebalance", *map(F.col, ("dataset", "year", *tile))).drop(*tile)
    with cut_to(df.sparkSession, PART):
        dealt.sortWithinPartitions("dataset", "year", "lat_idx", "lon_idx", "time").write.partitionBy("dataset", "year").parquet(f"{root}/data/{commit}")
    _create(df.sparkSession, f"{root}/data/{commit}-schema", df.schema.json())  # a commit without rows has no file that says it
    return commit, df.sparkSession.read.schema(df.schema).parquet(f"{root}/data/{commit}")


def _publish(spark: SparkSession, root: str, number: int, before: list, commit: str, content: State, axes: DataFrame, latest: bool = False, batch: str | None = None) -> Version:
    """Writes the commit's axes and list, then makes it version `number`."""
    axes.write.parquet(f"{root}/axes/{commit}")
    rows = [(i, r["commit"], r["content"], r["latest"], r["batch"]) for i, r in enumerate(before)] + [(len(before), commit, content.said(), latest, batch)]
    spark.createDataFrame(rows, _LISTED).coalesce(1).write.parquet(f"{root}/lists/{commit}")
    _claim(spark, root, number, commit)
    return _version(spark, root, number)


def instantiate(df: DataFrame, root: str, batch: str | None = None) -> Version:
    """A new store of dataset, time, lat_idx, lon_idx, value, revision; an existing one is an error."""
    spark = df.sparkSession
    if latest_version(spark, root):
        raise FileExistsError(root)
    commit, rows = _write(df, root)
    return _publish(spark, root, 1, [], commit, state(latest_revision(rows.drop("year"), KEYS, BY)), _labels(rows), batch=batch)


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version's rows, the newest by default: of each key the highest revision, ties by the larger value."""
    found = _listed(spark, root, version)
    df = _rows(spark, root, [r["commit"] for r in found]).drop("year")
    return df if len(found) == 1 and found[0]["latest"] else latest_revision(df, KEYS, BY)


def _change(stored: DataFrame, new: DataFrame) -> State:
    """What new rows change of the state: of each of their keys the row that counts now, less the one that did before."""
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS))
    touched = new.select(*(F.col(k).alias(f"_{k}") for k in KEYS)).distinct()
    columns = _columns(new)
    order = [*BY, *(c for c in columns if c not in BY and c not in KEYS)]
    row = F.struct(*order, *KEYS)
    both = stored.join(touched, same, "left_semi").select(*columns, F.lit(True).alias("_old")).unionByName(new.select(*columns, F.lit(False).alias("_old")))
    best = leading(both, [*KEYS, "_old"], order).groupBy(*KEYS).agg(F.max(row).alias("now"), F.max(F.when(F.col("_old"), row)).alias("before"))
    each = [_sums([F.col(side)[c] for c in columns], F.col(side).isNotNull()) for side in ("now", "before")]
    found = list(map(int, best.agg(*(c for side in each for c in side)).first()))
    now, before = (State(x[0], tuple(x[1:])) for x in (found[: _HASHES + 1], found[_HASHES + 1 :]))
    return now.plus(before, -1)


def append(df: DataFrame, root: str, batch: str | None = None) -> Version:
    """Stores the rows whose keys and revisions aren't there yet; without any, the version stays.

    batch: an id of what is appended; a version that holds a commit with it stays as it is, so a
    batch that comes again is stored once, whatever it holds then. Nulls in keys equal nulls. Of
    what is stored only the years between the new rows' first and last time are looked through.
    """
    spark = df.sparkSession
    a, b, timeless = df.agg(F.min("time"), F.max("time"), F.count_if(F.col("time").isNull())).first()
    for _ in range(ATTEMPTS):
        number = latest_version(spark, root)
        before = _listed(spark, root, number)
        if (batch is not None and batch in _batches(before)) or a is None and not timeless:
            return _now(spark, root)
        within = F.col("year").between(a.year, b.year) & F.col("time").between(a, b) if a is not None else F.lit(False)
        stored = _rows(spark, root, [r["commit"] for r in before]).where(within | F.col("time").isNull() if timeless else within)
        commit, new = _write(append_new(stored, df, [*KEYS, "revision"]), root)
        if not new.head(1):
            return _now(spark, root)
        content = State.read(before[-1]["content"]).plus(_change(stored, new))
        axes = spark.read.parquet(f"{root}/axes/{before[-1]['commit']}").unionByName(_labels(new)).distinct()
        try:
            return _publish(spark, root, number + 1, before, commit, content, axes, batch=batch)
        except FileExistsError:  # another writer was first: what it stored counts as there
            continue
    raise TimeoutError(f"{root} was changed by others at each of {ATTEMPTS} attempts")


def _batches(listed: list) -> list[str]:
    return [x for r in listed if r["batch"] for x in r["batch"].split("\n")]


def compact(spark: SparkSession, root: str) -> Version:
    """A version with the rows that read_version gives, in one commit, so that reads shuffle nothing. Its id is that of the version before.

    A version that another writer makes meanwhile is an error, and stays. The one commit carries the
    ids of all batches that came before.
    """
    number = latest_version(spark, root)
    *_, last = found = _listed(spark, root, number)
    commit, rows = _write(read_version(spark, root, number), root)
    axes = spark.read.parquet(f"{root}/axes/{last['commit']}")
    return _publish(spark, root, number + 1, [], commit, state(rows.drop("year")), axes, latest=True, batch="\n".join(_batches(found)) or None)
