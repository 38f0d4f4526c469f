"""Token ids in patched frame-of-reference blocks.

A segment holds the ids of some consecutive documents and can be read alone:

    magic "PFR1", block size (u32), number of ids (u64), number of blocks (u32),
    block starts (u32 each, from the first block's byte 0, and one for the end), blocks

A block holds up to block-size ids: their minimum (u32), the width in bits (u8), the number of
exceptions (u32), the low bits of id - minimum packed at that width, the exceptions' positions
(u16 each) and their remaining high bits (u32 each). The width is what a given share of the
block's ids need; the others are the exceptions. All numbers are little-endian. Segments are
carried as binary values in files that Spark writes, so that a job commits them as a whole,
to any store, and a lost executor leaves no half file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.bpe import json_encoder
from gridspark.llm.common import shared_dir, slices, strings

BLOCK, SHARE = 256, 0.97
#: Ids after which a segment ends with the document at hand.
SEGMENT_IDS = 1 << 19
_HEAD, _BLOCK_HEAD = struct.Struct("<4sIQI"), np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "<u4")])
SEGMENT = "part int, start_in_part long, n_ids long, doc_ids binary, doc_null binary, doc_tokens binary, payload binary"


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of unsigned integers, the low bits of each packed at width bits a value."""
    rows, size = values.shape
    values = values & np.uint32((1 << width) - 1)
    if width > 16:
        bits = ((values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1).astype(np.uint8)
        return np.packbits(bits.reshape(rows, -1), axis=1, bitorder="little")
    eights = np.zeros((rows, -(-size // 8) * 8), dtype=np.uint64)
    eights[:, :size] = values
    eights = eights.reshape(-1, 8)  # eight values take up width bytes: two words of four values each
    low, high = eights[:, 0].copy(), eights[:, 4].copy()
    for k in (1, 2, 3):
        low |= eights[:, k] << np.uint64(k * width)
        high |= eights[:, 4 + k] << np.uint64(k * width)
    four = np.uint64(4 * width)
    words = np.stack([low | high << four, high >> (np.uint64(64) - four)] if width < 16 else [low, high], axis=1)
    return words.view(np.uint8).reshape(-1, 16)[:, :width].reshape(rows, -1)[:, : (size * width + 7) // 8]


def _unpack(packed: np.ndarray, width: int, size: int) -> np.ndarray:
    """size values from each row; eight values take up width bytes, so a window of 5 bytes covers any value."""
    rows, n = packed.shape
    wide = np.zeros((rows, n + 8), dtype=np.uint8)
    wide[:, :n] = packed
    bit = np.arange(size) * width
    at, shift = bit >> 3, (bit & 7).astype(np.uint64)
    word = np.zeros((rows, size), dtype=np.uint64)
    for k in range((width + 14) // 8):
        word |= wide[:, at + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


def _check(block: int, share: float) -> None:
    if not (1 <= block <= 1 << 16 and 0 < share <= 1):
        raise ValueError("block has to be from 1 to 65,536, share above 0 and at most 1")


def encode_segment(ids: np.ndarray, block: int = BLOCK, share: float = SHARE) -> bytes:
    """ids (unsigned 32-bit) as a segment. No ids: a head and no blocks."""
    _check(block, share)
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    n = len(ids)
    count = -(-n // block)
    blocks: list[bytes] = [b""] * count
    for first, last, size in ((0, n // block, block), (n // block, count, n - n // block * block)):
        chunk = 2048
        for a in range(first, last, chunk):
            b = min(last, a + chunk)
            rows = ids[a * block : a * block + (b - a) * size].reshape(b - a, size)
            least = rows.min(axis=1)
            rest = rows - least[:, None]
            at = max(0, int(np.ceil(share * size)) - 1)
            widths = _bit_length(np.partition(rest, at, axis=1)[:, at])
            for width in np.unique(widths):
                mine = np.flatnonzero(widths == width)
                values = rest[mine]
                packed = _pack(values, int(width)) if width else np.zeros((len(mine), 0), np.uint8)
                high = values >> np.uint32(width) if width < 32 else np.zeros_like(values)
                row, position = np.nonzero(high)
                bounds = np.searchsorted(row, np.arange(len(mine) + 1))
                position, over = position.astype("<u2"), high[row, position].astype("<u4")
                heads = np.zeros(len(mine), _BLOCK_HEAD)
                heads["least"], heads["width"], heads["exceptions"] = least[mine], width, np.diff(bounds)
                for k, i in enumerate(mine.tolist()):
                    c, d = bounds[k], bounds[k + 1]
                    blocks[a + i] = heads[k].tobytes() + packed[k].tobytes() + position[c:d].tobytes() + over[c:d].tobytes()
    starts = np.zeros(count + 1, "<u4")
    np.cumsum([len(x) for x in blocks], out=starts[1:])
    return _HEAD.pack(b"PFR1", block, n, count) + starts.tobytes() + b"".join(blocks)


def _head(segment: bytes) -> tuple[int, int, np.ndarray, int]:
    magic, block, n, count = _HEAD.unpack_from(segment)
    if magic != b"PFR1":
        raise ValueError("no token segment")
    return block, n, np.frombuffer(segment, "<u4", count + 1, _HEAD.size), _HEAD.size + 4 * (count + 1)


def decode_segment(segment: bytes) -> np.ndarray:
    """The ids of a segment."""
    block, n, starts, base = _head(segment)
    out = np.zeros(n, dtype=np.uint32)
    count = len(starts) - 1
    if not count:
        return out
    data = np.frombuffer(segment, np.uint8)
    at = base + starts[:-1].astype(np.int64)
    heads = np.ascontiguousarray(data[at[:, None] + np.arange(_BLOCK_HEAD.itemsize)]).view(_BLOCK_HEAD)[:, 0]
    sizes = np.full(count, block)
    sizes[-1] = n - block * (count - 1)
    for width, size in {*zip(heads["width"].tolist(), sizes.tolist())}:
        mine = np.flatnonzero((heads["width"] == width) & (sizes == size))
        n_bytes = (size * width + 7) // 8
        for some in np.array_split(mine, -(-len(mine) // 2048)):
            values = np.zeros((len(some), size), np.uint32)
            body = at[some] + _BLOCK_HEAD.itemsize
            if width:
                values[:] = _unpack(data[body[:, None] + np.arange(n_bytes)], width, size)
            body += n_bytes
            exceptions = heads["exceptions"][some].astype(np.int64)
            row = np.repeat(np.arange(len(some)), exceptions)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
            if len(row):
                position = data[(body[row] + 2 * nth)[:, None] + np.arange(2)].copy().view("<u2")[:, 0]
                over = data[(body[row] + 2 * exceptions[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
                values[row, position] |= over << np.uint32(width)
            values += heads["least"][some][:, None]
            out[some[:, None] * block + np.arange(size)] = values
    return out


def decode_block(segment: bytes, i: int) -> np.ndarray:
    """The ids of block i alone, by the index of block starts."""
    block, n, starts, base = _head(segment)
    count = len(starts) - 1
    if not 0 <= i < count:
        raise IndexError(i)
    body = segment[base + int(starts[i]) : base + int(starts[i + 1])]
    size = block if i < count - 1 else n - block * (count - 1)
    return decode_segment(_HEAD.pack(b"PFR1", size, size, 1) + np.array([0, len(body)], "<u4").tobytes() + body)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, block: int = BLOCK, share: float = SHARE, added: bool = False) -> None:
    """Encodes every whole text, appends end_id to each, and writes segments in ascending doc_id order.

    Null and empty texts have end_id alone. block: from 1 to 65,536 ids, as positions of exceptions
    are 16 bits; share: above 0, to 1. Null doc_ids come first; rows that repeat a doc_id
    follow each other, in an order that their texts give. Other columns are not read. An empty table
    gives no segments. One range shuffle; each task streams its documents.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    _check(block, share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = json_encoder(tokenizer, added), TaskContext.get().partitionId()
        end, start = np.array([end_id], "<u4").tobytes(), 0
        doc_ids, null, sizes, held = [], [], [], []

        def segment() -> pa.RecordBatch:
            nonlocal start
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [part, start, len(ids), np.array(doc_ids, "<i8").tobytes(), bytes(null), np.array(sizes, "<i8").tobytes(), encode_segment(ids, block, share)]
            start += len(ids)
            for x in (doc_ids, null, sizes, held):
                x.clear()
            kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=[x.split()[0] for x in SEGMENT.split(", ")])

        total = 0
        for batch in (part for whole in batches for part in slices(whole)):
            for name, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(strings(batch.column("text")))):
                doc_ids.append(name or 0)
                null.append(name is None)
                sizes.append(len(ids) // 4 + 1)
                held.append(ids + end)
                total += sizes[-1]
                if total >= SEGMENT_IDS:
                    yield segment()
                    total = 0
        if doc_ids:
            yield segment()

    # Rows that share a doc_id, or have none, are dealt to several tasks by a hash of their texts.
    place = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(*place[:2]).sortWithinPartitions(*place)
    ordered.mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with start: the number of ids in all segments before it."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    # One row a writing task: few enough to sum in one task and to send to all.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return segments.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("start_in_part"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of written segments: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row["payload"]).astype("<u4")
                names, null = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["doc_null"], np.uint8).astype(bool)
                sizes = np.frombuffer(row["doc_tokens"], "<i8")
                ends = np.cumsum(sizes)
                cut = [ids[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]
                columns = {"doc_id": pa.array(names, mask=null), "start": pa.array(row["start"] + ends - sizes), "n_tokens": pa.array(sizes), "ids_crc32": pa.array([zlib.crc32(x) for x in cut], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([x.view("<i4") for x in cut], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return read_segments(spark, path).select("start", "doc_ids", "doc_null", "doc_tokens", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def token_block_report(docs: DataFrame, added: bool = False) -> DataFrame:
    """Writes documents as segments to the shared folder and reads every id back."""
    path = shared_dir(docs.sparkSession)
    write_tokens(docs, path, added=added)
    return read_tokens(docs.sparkSession, path)
