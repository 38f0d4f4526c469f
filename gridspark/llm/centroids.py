"""Clustering around centroids in exact integers, each vector's centroid found by a tournament of bisectors.

A vector x is nearer to centroid b than to a when x . 2 (b - a) > |b|^2 - |a|^2: one integer normal
and one threshold a pair. A winner meets the next centroid k - 1 times; only the last winner's
distance is worked out. A vector on the bisector stays with the smaller number.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import stored

#: Integers below this in magnitude: every sum over a vector's products then fits 64 bits.
PLAIN = 1 << 27
#: Bits of the parts in which larger integers are summed.
PART_BITS = 32
#: The first integer that a long can't hold.
BEYOND = 1 << 63
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept_vectors(vectors: DataFrame, size: int) -> DataFrame:
    """vec_id and embedding (doubles) of vectors with so many components, none of them null or not finite."""
    x = vectors["embedding"].cast("array<double>")
    finite = F.forall(x, lambda y: F.coalesce(F.abs(y) < F.lit(math.inf), F.lit(False)))
    return vectors.where((F.size(x) == size) & finite).select(vectors["vec_id"].cast("long").alias("vec_id"), x.alias("embedding"))


def scaled(value: float, scale: int) -> int:
    """floor(scale * value) for any finite double; from 2**52 on a double is a whole number."""
    return math.floor(value * scale) if abs(value) < 1 << 52 else int(value) * scale


def integers(column: pa.Array, size: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows and their integers: those that 64 bits hold with all their sums, then the others as Python's integers."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    large = np.abs(x).max(axis=1, initial=0) >= PLAIN // scale
    if not large.all():
        yield np.flatnonzero(~large), np.floor(x[~large] * scale).astype(np.int64)
    if large.any():
        yield np.flatnonzero(large), np.array([[scaled(v, scale) for v in row] for row in x[large].tolist()], object)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row."""
    return (a * b).sum(axis=1) if a.dtype == object or b.dtype == object else np.einsum("ij,ij->i", a, b)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, object)
        if max(map(abs, c.ravel())) < PLAIN:
            c = c.astype(np.int64)
        square = (c * c).sum(axis=1)
        self.centroids, self.normals, self.thresholds = c, 2 * (c[None] - c[:, None]), square[None] - square[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        won = np.zeros(len(x), np.int64)
        for b in range(1, len(self.centroids)):
            won[_dot(x, self.normals[won, b]) > self.thresholds[won, b]] = b
        return won

    def distances(self, x: np.ndarray, won: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[won]
        return _dot(apart, apart)


def _parts(x: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of integers from the lowest on; the last is signed."""
    while x.dtype == object and any(abs(v) >= PLAIN for v in x.ravel()):
        yield (x & ((1 << PART_BITS) - 1)).astype(np.int64)
        x = x >> PART_BITS
    yield x.astype(np.int64)


def _sums(vectors: DataFrame, centroids: list[list[int]], scale: int) -> DataFrame:
    """A row for each task, cluster and part: how many vectors (told with part 0) and the sums of their components' parts."""
    k, size = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors, n, sums = Bisectors(centroids), np.zeros(k, np.int64), {}
        for batch in batches:
            for _, x in integers(batch.column("embedding"), size, scale):
                won = bisectors.nearest(x)
                n += np.bincount(won, minlength=k)
                for part, y in enumerate(_parts(x)):
                    total = sums.setdefault(part, np.zeros((k, size), np.int64))
                    for c in np.unique(won):
                        total[c] += y[won == c].sum(axis=0)
        rows = [(c, part, int(n[c]) if part == 0 else 0, total[c]) for part, total in sums.items() for c in range(k) if n[c]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [()] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["cluster", "part", "n", "sums"])

    return vectors.select("embedding").mapInArrow(run, "cluster int, part int, n long, sums array<long>")


def next_centroids(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Each centroid's vectors' componentwise floor(sum / count); one without vectors stays. k rows a part come to the driver."""
    size = len(centroids[0])
    wide = [F.expr(f"sum(CAST(sums[{i}] AS decimal(20,0))) AS s{i}") for i in range(size)]
    n, total = [0] * len(centroids), [[0] * size for _ in centroids]
    for row in _sums(vectors, centroids, scale).groupBy("cluster", "part").agg(F.sum("n").alias("n"), *wide).collect():
        n[row["cluster"]] += row["n"]
        for i in range(size):
            total[row["cluster"]][i] += int(row[f"s{i}"]) << PART_BITS * row["part"]
    return [[s // n[c] for s in total[c]] if n[c] else old for c, old in enumerate(centroids)]


def _assigned(vectors: DataFrame, centroids: list[list[int]], scale: int) -> DataFrame:
    size = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for batch in batches:
            cluster, distance = np.zeros(len(batch), np.int32), np.zeros(len(batch), object)
            for at, x in integers(batch.column("embedding"), size, scale):
                cluster[at] = won = bisectors.nearest(x)
                distance[at] = bisectors.distances(x, won)
            held = pa.array([int(d) if d < BEYOND else None for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), held], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> DataFrame:
    """One row a kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are vectors with `size` components, none null, NaN or infinite; each component becomes
    floor(scale * component). The first centroids are the k kept vectors with the smallest SHA-256
    of "1:<vec_id>" (ties, where rows repeat a vec_id, by their components; a null vec_id comes
    last), or all of them where fewer are kept. Each round assigns all vectors and moves the
    centroids; then they are assigned once more. Repeated rows count as often as they stand there.
    Any finite component is computed with exactly; a distance or sum that a long can't hold is null.
    Without kept vectors there are no rows. Other columns are not read.

    Each round reads the vectors once and shuffles a row a task, cluster and part of the numbers;
    the final clusters are written to the shared folder, to be summed and then returned.
    """
    spark, vectors = vectors.sparkSession, kept_vectors(vectors, size)
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(order.asc_nulls_last(), "embedding").limit(k).collect()
    if not first:
        return spark.createDataFrame([], SCHEMA)
    centroids = [[scaled(v, scale) for v in row["embedding"]] for row in first]
    for _ in range(rounds):
        centroids = next_centroids(vectors, centroids, scale)
    assigned = stored(_assigned(vectors, centroids, scale))
    whole = F.col("distance").cast("decimal(20,0)")
    found = {row["cluster"]: row for row in assigned.groupBy("cluster").agg(F.sum(whole).alias("sum"), F.count(F.lit(1)).alias("n"), F.count("distance").alias("known")).collect()}
    sums = {c: int(row["sum"]) if row["n"] == row["known"] else None for c, row in found.items()}
    inertia = None if None in sums.values() else sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def long(value: int | None) -> Column:
        return F.lit(None if value is None or value >= BEYOND else value).cast("long")

    def by_cluster(values: list[Column]) -> Column:
        return F.array(*values)[F.col("cluster")]

    return assigned.select(
        "vec_id", "cluster", "distance", by_cluster([long(sums.get(c)) for c in range(len(centroids))]).alias("cluster_inertia"), long(inertia).alias("inertia"), by_cluster([F.lit(d) for d in digests]).alias("centroid_sha256")
    )


def oracle(k: int = 16, rounds: int = 3) -> str:
    """The same in DuckDB: every distance to every centroid, round by round."""
    distance = "list_sum(list_transform(list_zip(v.x, c.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding, [CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT) FOR y IN embedding] AS x FROM embeddings"
        " WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, embedding) - 1 AS INTEGER) AS c, x AS m FROM v ORDER BY c LIMIT {k})",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min(b) AS b FROM (SELECT v.r, struct_pack(d := CAST({distance} AS BIGINT), c := c.c) AS b FROM v, c{i} c) GROUP BY r)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT a.b.c AS c, t.k, sum(v.x[t.k]) AS s, count(*) AS n FROM a{i} a JOIN v ON v.r = a.r, range(1, 65) t(k) GROUP BY 1, 2)")
            steps.append(f"m{i} AS (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY k) AS m FROM s{i} GROUP BY c)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.m, c.m) AS m FROM c{i} c LEFT JOIN m{i} m ON m.c = c.c)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT v.vec_id, a.b.c AS cluster, a.b.d AS distance, CAST(sum(a.b.d) OVER (PARTITION BY a.b.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON v.r = a.r JOIN c{rounds} c ON c.c = a.b.c
"""
