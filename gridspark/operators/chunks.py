"""Long tables to fixed-size chunks of a dense array and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = (("t", "t_idx"), ("y", "lat_idx"), ("x", "lon_idx"))


def filled(cells: str, size: Column, absent: Column | None = None) -> Column:
    """Column cells, an array of structs (k, v) sorted by k, as an array of size values: v at place k, absent elsewhere.

    One pass: each cell brings the absent ones before it. Two cells of one place are an error.
    """
    absent = F.lit(None) if absent is None else absent
    of = F.col(cells)

    def run(x: Column, i: Column) -> Column:
        before = x["k"] - F.coalesce(F.get(of, i - 1)["k"], F.lit(-1)) - 1
        return F.when(before >= 0, F.concat(F.array_repeat(absent, before), F.array(x["v"]))).otherwise(F.raise_error(F.lit("two rows of one cell")))

    rest = size - 1 - F.coalesce(F.get(of, F.size(of) - 1)["k"], F.lit(-1))
    return F.concat(F.flatten(F.transform(of, run)), F.array_repeat(absent, rest))


def pack_chunks(obs: DataFrame, sizes: tuple[int | Column, int | Column, int | Column], shape: tuple[int, int, int], keys: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """keys, t/y/x_chunk, t/y/x_len, values: one row a chunk, values row-major in (t, y, x).

    obs: t_idx, lat_idx, lon_idx, value, one row a cell at most. sizes: of the whole array;
    which can be columns of obs; shape: of a chunk; chunks at an edge are shorter. Absent cells are null; chunks without any
    cell aren't there. A chunk's place follows from indices alone, whatever was there before.
    """
    out = obs
    for (d, idx), size, c in zip(DIMS, sizes, shape):
        out = out.withColumn(f"{d}_chunk", F.floor(F.col(idx) / c).cast("int")).withColumn(f"{d}_len", F.least(F.lit(c), F.lit(size) - F.col(f"{d}_chunk") * c).cast("int"))
    (t, y, x), (ct, cy, cx) = (F.col(i) for _, i in DIMS), shape
    offset = ((t % ct) * F.col("y_len") + y % cy) * F.col("x_len") + x % cx
    names = [f"{d}_{k}" for k in ("chunk", "len") for d in "tyx"]
    chunks = out.groupBy(*keys, *names).agg(F.array_sort(F.collect_list(F.struct(offset.cast("int").alias("k"), F.col("value").alias("v")))).alias("_cells"))
    kind = dict(obs.dtypes)["value"]
    return chunks.withColumn("values", filled("_cells", F.col("t_len") * F.col("y_len") * F.col("x_len"), F.lit(None).cast(kind))).drop("_cells")


def changed_chunks(stored: DataFrame, new: DataFrame, sizes: tuple[int, int, int], shape: tuple[int, int, int], keys: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """The chunks that new cells change or begin, and those that the grown time axis lengthens, as they are afterwards.

    stored: of pack_chunks; new: cells as for pack_chunks, with indices on the grown array of
    these sizes. Cells take their places in the stored arrays by offset; a cell that was there
    gets the new value, also a missing one. The other axes can't grow.
    """
    place, lens = [f"{d}_chunk" for d in "tyx"], [f"{d}_len" for d in "tyx"]
    new_len = {f"{d}_len": F.least(F.lit(c), F.lit(size) - F.col(f"{d}_chunk") * c).cast("int") for (d, _), size, c in zip(DIMS, sizes, shape)}
    grown = {f"_{d}": n for d, n in new_len.items()}
    both = [*keys, *place]
    packed = pack_chunks(new.withColumn("value", F.struct("value")), sizes, shape, keys).withColumnRenamed("values", "_new")
    old = stored.withColumns(grown)
    fits = F.when((F.col("_y_len") == F.col("y_len")) & (F.col("_x_len") == F.col("x_len")) & (F.col("_t_len") >= F.col("t_len")), True).otherwise(F.raise_error(F.lit("only time can grow")).cast("boolean"))
    touched = packed.select(*both)
    open_chunks = old.where(fits & (F.col("_t_len") > F.col("t_len"))).union(old.where(fits & (F.col("_t_len") == F.col("t_len"))).join(touched, both, "left_semi").select(*old.columns))
    joined = open_chunks.select(*both, "values").join(packed.select(*both, "_new"), both, "full_outer").withColumns(new_len)
    kind = dict(stored.dtypes)["values"]
    n = F.col("t_len") * F.col("y_len") * F.col("x_len")
    # Time is the slowest index: what is new of it comes after what is there.
    longer = F.concat(F.coalesce("values", F.array().cast(kind)), F.array_repeat(F.lit(None).cast(kind[len("array<") : -1]), n - F.coalesce(F.size("values"), F.lit(0))))
    merged = F.when(F.col("_new").isNull(), longer).otherwise(F.zip_with(longer, F.col("_new"), lambda a, b: F.when(b.isNull(), a).otherwise(b["value"])))
    return joined.select(*both, *lens, merged.alias("values"))


def append_chunks(stored: DataFrame, new: DataFrame, sizes: tuple[int, int, int], shape: tuple[int, int, int], keys: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """stored with the new cells: the chunks that change in place of what they were; closed chunks aren't unpacked or shuffled by their values."""
    changed = changed_chunks(stored, new, sizes, shape, keys)
    both = [*keys, *(f"{d}_chunk" for d in "tyx")]
    return stored.join(changed.select(*both), both, "left_anti").unionByName(changed)


def unpack_chunks(chunks: DataFrame, shape: tuple[int, int, int], keys: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """keys, t_idx, lat_idx, lon_idx, value of the cells that have a value."""
    cells = chunks.select(*keys, *(f"{d}_{k}" for k in ("chunk", "len") for d in "tyx"), F.posexplode("values").alias("_pos", "value")).where("value is not null")
    plane, line = F.col("y_len") * F.col("x_len"), F.col("x_len")
    within = (F.floor(F.col("_pos") / plane), F.floor(F.col("_pos") % plane / line), F.col("_pos") % line)
    return cells.select(*keys, *((F.col(f"{d}_chunk") * c + w).cast("int").alias(idx) for (d, idx), c, w in zip(DIMS, shape, within)), "value")


def chunk_digests(chunks: DataFrame) -> DataFrame:
    """chunks with digest: of the place and the values, whatever task packed them."""
    place = [c for c in chunks.columns if c != "values"]
    return chunks.withColumn("digest", F.sha2(F.to_json(F.struct(*place, "values"), {"ignoreNullFields": "false"}), 256))


def version_id(digests: DataFrame) -> DataFrame:
    """version_id of chunks with digests: equal for equal contents.

    Digests are combined in 256 groups by their first byte, then the groups, so that no task
    holds them all.
    """
    groups = digests.groupBy(F.substring("digest", 1, 2).alias("_g")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), ""), 256).alias("_d"))
    return groups.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("_g", "_d"))), ""), 256).alias("version_id"))
