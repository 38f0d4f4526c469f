"""Near-duplicate vectors by int8 tile products with quantisation error bounds.

Equal vectors are one from the start. The others are dealt to groups, and groups that lie near each
other to bands; each pair of groups is a tile, and the tiles of two bands are one task's, which gets
each of their groups once. In a tile the vectors' int8 forms are multiplied (exact integers, in
float32 or float64 by dimension), and bounds on what both vectors of a pair lost by rounding say
which pairs can reach the threshold at all. Those alone are computed again in double precision from
the vectors themselves. A task returns, for each vector, how many vectors it is linked with there and
one link to the first vector of its component within the task: rows grow with vectors, not pairs.
Bands and tiles whose vectors lie too far apart by their angles to some pivots are not made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import stored
from gridspark.llm.components import components
from gridspark.session import small

#: Vectors of a group, about; full groups of a band, about; rows of a tile multiplied at once; pivots, a bounded sample of the vectors.
GROUP, BAND, ROWS, PIVOTS = 8192, 4, 512, 16
#: Parts that the pairs of bands are dealt to tasks by.
PARTS = 64
#: What a product of unit vectors can be off in double precision, with much to spare.
_OFF = 1e-9
_GROUP = "g long, band long, wide boolean, dim int, size int, ids binary, copies binary, vectors binary, codes binary, scales binary, errors binary, lows array<double>, highs array<double>"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and at least the Euclidean length of unit - scale * codes, by row."""
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    errors = np.linalg.norm(unit - scales[:, None] * codes, axis=1) * (1 + 1e-9) + 1e-12
    return codes, scales, errors


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows as double-precision unit vectors; scaled first, so that no square over- or underflows."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


class _Forest:
    """Components of positions, kept as the smallest position reachable."""

    def __init__(self, n: int):
        self.least = np.arange(n)

    def join(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.least[u], self.least[v]
            if (a == b).all():
                return
            np.minimum.at(self.least, np.maximum(a, b), np.minimum(a, b))
            while (self.least[self.least] != self.least).any():
                self.least = self.least[self.least]


def _linked(unit_a: np.ndarray, unit_b: np.ndarray, u: np.ndarray, v: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs (u, v) those whose product reaches the threshold, each summed in the same way, whatever stands beside it."""
    found = [np.zeros((2, 0), np.int64)]
    for k in range(0, len(u), 1 << 18):
        i, j = u[k : k + (1 << 18)], v[k : k + (1 << 18)]
        found.append(np.stack([i, j])[:, np.einsum("ij,ij->i", unit_a[i], unit_b[j]) >= threshold])
    return tuple(np.concatenate(found, axis=1))


def tile_links(a: dict, b: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of linked vectors (copies count) and components of the vectors of a, then of b.

    a, b: codes, scales, errors, vectors, copies. b None: pairs within a.
    """
    same = b is None
    b = a if same else b
    n_a, n_b, dim = len(a["scales"]), len(b["scales"]), a["codes"].shape[1]
    kind = np.float32 if 127 * 127 * dim < 1 << 24 else np.float64  # holds every product exactly
    unit_a, unit_b = (x["unit"] if "unit" in x else unit_rows(x["vectors"]) for x in (a, b))
    right = b["codes"].astype(kind).T.copy()
    counts, forest = np.zeros(n_a + (0 if same else n_b), np.int64), _Forest(n_a + (0 if same else n_b))
    shift = 0 if same else n_a
    for r in range(0, n_a, ROWS):
        own = slice(r, min(n_a, r + ROWS))
        products = a["codes"][own].astype(kind) @ right
        products *= b["scales"].astype(kind)
        error_a, scale_a = a["errors"][own], a["scales"][own]
        # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|; 1e-6 for the rounding of scales.
        products += ((1 + error_a) / scale_a)[:, None].astype(kind) * b["errors"].astype(kind)
        maybe = products >= ((threshold - error_a - 1e-6) / scale_a)[:, None].astype(kind)
        if same:
            maybe &= np.arange(n_b) > np.arange(own.start, own.stop)[:, None]
        if maybe.sum() * 16 > maybe.size:  # many: one product tells most of them, the sums of pairs those that it leaves in doubt
            exact = unit_a[own] @ unit_b.T
            u, v = np.nonzero(maybe & (exact >= threshold + _OFF))
            more = _linked(unit_a[own], unit_b, *np.nonzero(maybe & (np.abs(exact - threshold) < _OFF)), threshold)
            u, v = np.concatenate([u, more[0]]), np.concatenate([v, more[1]])
        else:
            u, v = _linked(unit_a[own], unit_b, *np.nonzero(maybe), threshold)
        u = u + r
        counts[:n_a] += np.bincount(u, b["copies"][v], n_a).astype(np.int64)
        counts[shift : shift + n_b] += np.bincount(v, a["copies"][u], n_b).astype(np.int64)
        forest.join(u, v + shift)
    return counts, forest.least


def _apart(a: dict, b: dict, far: float) -> bool:
    """Angles to some pivot say that no vector of a is within far of one of b."""
    return bool(((a["lows"] - b["highs"] > far) | (b["lows"] - a["highs"] > far)).any())


def _unpacked(row: dict) -> dict:
    n, dim = row["size"], row["dim"]
    return {"g": row["g"], "band": row["band"], "lows": np.array(row["lows"]), "highs": np.array(row["highs"]), "ids": np.frombuffer(row["ids"], "<i8"), "copies": np.frombuffer(row["copies"], "<i8"), "vectors": np.frombuffer(row["vectors"], "<f8" if row["wide"] else "<f4").reshape(n, dim), "codes": np.frombuffer(row["codes"], np.int8).reshape(n, dim), "scales": np.frombuffer(row["scales"], "<f8"), "errors": np.frombuffer(row["errors"], "<f8")}


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _groups(distinct: DataFrame, group: int) -> DataFrame:
    """Distinct vectors (rep, copies, embedding, dim), packed in groups of about so many near each other."""
    pivots = distinct.orderBy(F.xxhash64("rep"), "rep").select("dim", "embedding").limit(PIVOTS).collect()
    by_dim: dict[int, list] = {}
    for p in pivots:
        by_dim.setdefault(p["dim"], []).append(p["embedding"])
    by_dim = {d: unit_rows(np.array(x, np.float64)) for d, x in by_dim.items()}
    kind = dict(distinct.dtypes)["embedding"]
    wide = kind == "array<double>"

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                if dim in by_dim:
                    mine = np.flatnonzero(dims == dim)
                    out[mine] = (unit_rows(_matrix(batch.column("embedding").take(pa.array(mine)), dim)) @ by_dim[dim].T).argmax(axis=1)
            yield batch.append_column("pivot", pa.array(out))

    near = distinct.mapInArrow(nearest, f"rep long, copies long, embedding {kind}, dim int, pivot int")
    near = stored(near)
    # Rows: pivots times lengths of vectors. A full cell is cut by hash, so no group grows with the table; long vectors have smaller groups.
    cells = near.groupBy("dim", "pivot").agg((F.count(F.lit(1)) * F.greatest(F.col("dim"), F.lit(64)) / (64 * group)).alias("fills"))
    before = F.sum("fills").over(Window.partitionBy("dim").orderBy("pivot")) - F.col("fills")
    cells = cells.select("dim", "pivot", "fills", F.ceil("fills").alias("cuts"), before.alias("before"))
    near = near.join(small(cells), ["dim", "pivot"]).withColumn("cut", F.pmod(F.xxhash64("rep"), "cuts"))
    # Groups in the order of their cells fill bands of BAND groups' size, so that small cells share one.
    place = F.floor((F.col("before") + (F.col("cut") + 0.5) / F.col("cuts") * F.col("fills")) / BAND)
    near = near.withColumns({"g": F.xxhash64("dim", "pivot", "cut"), "band": F.xxhash64("dim", place)})

    def packed(key, table):
        dim = table.column("dim")[0].as_py()
        vectors = _matrix(table.column("embedding"), dim)
        unit = unit_rows(vectors)
        codes, scales, errors = quantise(unit)
        angles = np.arccos(np.clip(unit @ by_dim[dim].T, -1, 1)) if dim in by_dim else np.zeros((len(unit), 0))
        row = {"g": key[0].as_py(), "band": key[1].as_py(), "wide": wide, "dim": dim, "size": len(unit), "ids": table.column("rep").to_numpy().astype("<i8").tobytes(), "copies": table.column("copies").to_numpy().astype("<i8").tobytes(), "vectors": vectors.astype("<f8" if wide else "<f4").tobytes(), "codes": codes.tobytes(), "scales": scales.astype("<f8").tobytes(), "errors": errors.astype("<f8").tobytes(), "lows": angles.min(axis=0).tolist(), "highs": angles.max(axis=0).tolist()}
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), *[pa.binary()] * 6, pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.Table.from_arrays([pa.array([x], k) for x, k in zip(row.values(), kinds)], names=list(row))

    return stored(near.select("g", "band", "rep", "copies", "embedding", "dim").groupBy("g", "band").applyInArrow(packed, _GROUP))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, group: int = GROUP) -> DataFrame:
    """One row a row of vectors: vec_id, n_links, component_id, kept.

    Vectors are linked when their cosine in double precision is at least threshold. Vectors that
    are null, empty, zero, or hold null or non-finite components are linked with nothing, and
    vectors of different lengths not with each other. n_links counts the other rows that a row
    is linked with; component_id is the smallest vec_id reachable, itself included. A row
    without vec_id counts, but names nothing. Rows of one vec_id are one node. An empty table
    gives no rows; other columns are not read.
    """
    kind = dict(vectors.dtypes)["embedding"]
    kind = kind if kind == "array<float>" else "array<double>"  # other numbers are read as doubles
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", good).withColumn("hash", F.when(good, F.xxhash64("embedding")))
    distinct = rows.where("good").groupBy("hash", "embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    # Copies without any vec_id still have to be told apart from others in a tile.
    distinct = stored(distinct.select("hash", "embedding", "copies", "least", F.coalesce("least", -1 - F.abs(F.col("hash") / 2).cast("long")).alias("rep"), F.size("embedding").alias("dim")))
    groups = _groups(distinct.select("rep", "copies", "embedding", "dim"), group)

    far = float(np.arccos(threshold)) + 1e-9
    # One row a band and no vectors: the pairs of bands that can hold a link, dealt to tasks by parts of one side.
    ends = groups.select("band", "dim", F.posexplode(F.arrays_zip("lows", "highs")).alias("pivot", "x")).groupBy("band", "dim", "pivot").agg(F.min("x.lows").alias("low"), F.max("x.highs").alias("high"))
    ends = ends.groupBy("band", "dim").agg(F.array_sort(F.collect_list(F.struct("pivot", "low", "high"))).alias("x"))
    ends = groups.select("band", "dim").distinct().join(ends, ["band", "dim"], "left").withColumn("x", F.coalesce("x", F.array().cast("array<struct<pivot:int,low:double,high:double>>")))
    other = ends.toDF("to", "dim", "y").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    pairs = ends.withColumn("part", F.pmod(F.xxhash64("band"), F.lit(PARTS)).cast("int")).join(other, ["dim", "part"])
    apart = F.exists(F.arrays_zip("x", "y"), lambda p: (p["x"]["low"] - p["y"]["high"] > far) | (p["y"]["low"] - p["x"]["high"] > far))
    pairs = stored(pairs.where((F.col("band") <= F.col("to")) & ~apart).select(F.col("band").alias("lo"), F.col("to").alias("hi")))
    left = pairs.join(groups.withColumn("lo", F.col("band")), "lo").select("lo", "hi", *groups.columns)
    right = pairs.where("lo < hi").join(groups.withColumn("hi", F.col("band")), "hi").select("lo", "hi", *groups.columns)

    def linked(key, table):
        lo, hi = key[0].as_py(), key[1].as_py()
        all_groups = [_unpacked(x) for x in sorted(table.to_pylist(), key=lambda x: (x["band"] != lo, x["g"]))]
        for x in all_groups:
            x["unit"] = unit_rows(x["vectors"])
        starts = np.concatenate([[0], np.cumsum([len(x["ids"]) for x in all_groups])])
        counts, forest = np.zeros(starts[-1], np.int64), _Forest(int(starts[-1]))
        for i, a in enumerate(all_groups):
            for j, b in enumerate(all_groups[i:], i):
                if (lo != hi and not (a["band"] == lo and b["band"] == hi)) or _apart(a, b, far):
                    continue
                own = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in ({i, j} if i == j else (i, j))])
                n, least = tile_links(a, None if i == j else b, threshold)
                counts[own] += n
                forest.join(own, own[least])
        ids, at = np.concatenate([x["ids"] for x in all_groups]), np.flatnonzero(counts)
        return pa.table({"rep": ids[at], "links": counts[at], "first": ids[forest.least[at]]})

    found = left.unionByName(right).groupBy("lo", "hi").applyInArrow(linked, "rep long, links long, first long")
    found = stored(found)
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("first").alias("b")))
    of = distinct.select("hash", "embedding", "rep", "copies", "least").join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    # The component's smallest real vec_id, where copies without one have stood for themselves.
    real = of.groupBy(F.coalesce("component", "rep").alias("component")).agg(F.min("least").alias("smallest"))
    of = of.withColumn("component", F.coalesce("component", "rep")).join(real, "component").select("hash", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "smallest")
    out = rows.join(of, ["hash", "embedding"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("smallest", "vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
