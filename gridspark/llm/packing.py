"""Packing of documents into sequences of a fixed length by harmonic classes.

A piece with capacity/(k+1) < length <= capacity/k is of class k, and k pieces of a class fill a
sequence. A document is cut into whole sequences, then its rest into the largest pieces that are
just a k-th of the capacity, rounded down, so that a sequence of them lacks fewer than k tokens;
what is shorter than least tokens stays a piece as it is, of which at least capacity/least go
into a sequence. Each task fills the bins of its classes from its own
rows alone, so there is no shuffle; what its last bins lack at the end is laid end to end, cut
where a sequence is full, and the last sequence is cut to powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.bpe import json_encoder
from gridspark.llm.common import slices, strings

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Sequences of one task have ids from task * 2**40 on.
TASK_IDS = 1 << 40


def piece_lengths(n: int, capacity: int, least: int) -> list[int]:
    """Lengths that a document of n tokens is cut into, in order."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest >= least:
        k = capacity // rest  # rest is of class k, and longer than a part of class k + 1
        size = capacity // k if rest == capacity // k else capacity // (k + 1)
        out.append(size)
        rest -= size
    return out + [rest] * (rest > 0)


class _Bins:
    """The open bins of one task. A piece: (doc_id, start, ids, doc_tokens)."""

    def __init__(self, task: int, capacity: int):
        self.capacity, self.next, self.open, self.rows = capacity, task * TASK_IDS, {}, []

    def put(self, pieces: list[tuple]) -> None:
        """A sequence of these pieces."""
        offset = 0
        for doc_id, start, ids, n in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), n, self.next, offset))
            offset += length
        self.next += 1

    def add(self, piece: tuple) -> None:
        k = self.capacity // (len(piece[2]) // 4)
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            self.put(held)
            self.open[k] = []

    def close(self) -> None:
        """The pieces of unfilled bins, longest classes first, laid end to end."""
        rest = [p for k in sorted(self.open) for p in self.open[k]]
        left = sum(len(p[2]) // 4 for p in rest)
        room, held = 0, []
        for doc_id, start, ids, n in rest:
            while ids:
                if not room:
                    room = min(self.capacity, 1 << (left.bit_length() - 1))
                now = ids[: 4 * room]
                held.append((doc_id, start, now, n))
                size = len(now) // 4
                ids, start, room, left = ids[4 * room :], start + size, room - size, left - size
                if not room:
                    self.put(held)
                    held = []
        self.open = {}


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 2048, end_id: int = 1, least: int = 128, added: bool = False, forget: bool = False) -> DataFrame:
    """Encodes every whole text, appends end_id, and packs all documents' ids.

    One row a piece: doc_id, start (its document's ids before it), length, ids_crc32,
    doc_tokens, sequence_id and offset there. Null and empty texts have end_id alone. Rows are
    documents, whatever their doc_id: repeated or null doc_ids are packed once a row. An empty
    table has no pieces. Other columns are not read. capacity: a power of two; least: from 2 to it.
    forget: tasks give back the pieces of text that they keep encoded, where a job's other stages
    need the memory; else a worker's next task finds them.
    """
    if capacity < 2 or capacity & (capacity - 1) or not 2 <= least <= capacity:
        raise ValueError("capacity has to be a power of two, least from 2 to capacity")
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = json_encoder(tokenizer, added), _Bins(TaskContext.get().partitionId(), capacity)
        end = np.array([end_id], "<u4").tobytes()

        def out() -> pa.RecordBatch:
            columns = zip(*bins.rows) if bins.rows else [[]] * 7
            made = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=[x.split()[0] for x in PIECE.split(", ")])
            bins.rows = []
            return made

        for batch in (part for whole in batches for part in slices(whole)):
            for name, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(strings(batch.column("text")))):
                ids += end
                n, start = len(ids) // 4, 0
                for size in piece_lengths(n, capacity, least):
                    bins.add((name, start, ids[4 * start : 4 * (start + size)], n))
                    start += size
            yield out()
        bins.close()
        if forget:
            encoder.forget()
        yield out()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECE)
