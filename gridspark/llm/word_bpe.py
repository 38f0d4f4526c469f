"""BPE with word ends by a table of distinct words: each word of the corpus is encoded once.

Texts are split at white space, which the tokenizer drops, and before marks, so a text's ids are its
words' ids in turn. Documents are numbered off in blocks: a block holds the words that its documents
have, each once, and the documents as numbers of these. Blocks deal their words to buckets by hash; a
bucket's task holds the table of its distinct words, encodes each once, and joins the ids back to the
blocks. In a block ids are put in the words' positions, and ids are decoded by a join with the
vocabulary's pieces. What is shuffled is a block's words, their ids and its documents' numbers, all
compressed, never a row for each word of each text.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A block ends after the batch that brings it to so many bytes of text or distinct words.
BLOCK_BYTES, BLOCK_WORDS = 16 << 20, 1 << 17
#: Where texts are split: at white space, all of which the tokenizer drops (other white space within a word as well), and
#: between an ASCII letter and a mark that neither a contraction nor an added token begins with, where its pattern always
#: ends a part and normalisation joins nothing.
SPLIT = r"[ \t\n\x0B\f\r]+|(?<=[A-Za-z])(?=[,.;:!?)\]\"])"


@lru_cache(maxsize=2)
def word_encoder(path: str):
    """The library's tokenizer of a file, with truncation and padding off; refuses files whose white space matters."""
    from tokenizers import Tokenizer

    with open(path) as file:
        said = json.load(file)
    splits = (said["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    if said["decoder"] or said["post_processor"] or splits.get("behavior") != "Removed" or not splits.get("invert") or any(x["single_word"] or x["normalized"] or " " in x["content"] for x in said["added_tokens"]):
        raise ValueError(f"{path} is no BPE of words whose white space is dropped")
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """The table of the vocabulary's pieces by id, added tokens too; its size is the file's."""
    vocabulary = word_encoder(path).get_vocab(with_added_tokens=True)
    table = [""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        table[i] = piece
    return table


def _numbers(values: np.ndarray) -> bytes:
    """Unsigned integers of 2 or 4 bytes, as the first byte says, the low bytes of all before the next ones, compressed."""
    kind = "<u4" if values.max(initial=0) >= 1 << 16 else "<u2"
    wide = np.dtype(kind).itemsize
    return bytes([wide]) + ZstdCompressor(level=3).compress(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, wide).T).tobytes())


def _read_numbers(data: bytes) -> np.ndarray:
    wide, planes = data[0], np.frombuffer(ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(wide, -1).T).view(f"<u{wide}").ravel()


def _joined(words: list[str]) -> bytes:
    """Words hold no line feed, as texts are split there."""
    return ZstdCompressor(level=3).compress("\n".join(words).encode())


def _split(data: bytes) -> list[str]:
    text = ZstdDecompressor().decompress(data).decode()
    return text.split("\n") if text else []


def _dealt(words: list[str], buckets: int) -> dict[int, list[int]]:
    """Numbers of words by bucket, a hash of the word."""
    out: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        out.setdefault(zlib.crc32(word.encode()) % buckets, []).append(i)
    return out


BLOCKS = "block long, doc_ids array<long>, counts binary, codes binary, words binary"


def _numbered(words: DataFrame, block_bytes: int, block_words: int) -> DataFrame:
    """Rows of documents (doc_ids, how many words each has, the words' numbers) and at the end of each block a row of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(*values) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, kinds)], ["block", "doc_ids", "counts", "codes", "words"])

        block, known, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in batches:
            lists = batch.column("words")
            found, begins = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            coded = found.dictionary_encode()
            place = np.array([known.setdefault(w, len(known)) if w else -1 for w in coded.dictionary.to_pylist()] or [0], np.int64)
            codes = place[coded.indices.to_numpy(zero_copy_only=False)]
            counts = np.diff(np.concatenate([[0], np.cumsum(codes >= 0)])[begins])
            yield row(block, batch.column("doc_id").to_pylist(), _numbers(counts), _numbers(codes[codes >= 0]), None)
            size += found.nbytes
            if size >= block_bytes or len(known) >= block_words:
                yield row(block, None, None, None, _joined(list(known)))
                block, known, size = block + 1, {}, 0
        if size:
            yield row(block, None, None, None, _joined(list(known)))

    return words.mapInArrow(run, BLOCKS)


def _bucketed(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks' words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                words = _split(data) if data else []
                rows = [(bucket, block, _joined([words[i] for i in at])) for bucket, at in _dealt(words, buckets).items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))], ["bucket", "block", "words"])

    return blocks.mapInArrow(run, "bucket int, block long, words binary")


def _encoded(bucketed: DataFrame, path: str) -> DataFrame:
    """For each block and bucket the ids of its words: how many each has, the ids, and a checksum of the words. Rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bucket, table = word_encoder(path), None, {}
        for batch in batches:
            for own, block, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "words"))):
                if own != bucket:
                    bucket, table = own, {}
                words = _split(data)
                new = [w for w in words if w not in table]
                table |= {w: x.ids for w, x in zip(new, encoder.encode_batch(new, add_special_tokens=False))}
                ids = [table[w] for w in words]
                values = (block, own, _numbers(np.array([len(x) for x in ids])), _numbers(np.array([*chain.from_iterable(ids)], np.int64)), zlib.crc32("\n".join(words).encode()))
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()))], ["block", "bucket", "counts", "ids", "checksum"])

    return bucketed.mapInArrow(run, "block long, bucket int, counts binary, ids binary, checksum long")


def _cut(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(counts[:-1])) if len(counts) else []


def _positioned(blocks: DataFrame, encoded: DataFrame, path: str, buckets: int, with_ids: bool) -> DataFrame:
    """Documents' ids in the positions of their words, and what the ids decode to; a group is a block."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        table = [x.encode() for x in pieces(path)]
        words = next(_split(x) for x in rows.column("words").to_pylist() if x is not None)
        at, ids, texts = _dealt(words, buckets), [b""] * len(words), [None] * len(words)
        for bucket, counts, own, checksum in zip(*(found.column(c).to_pylist() for c in ("bucket", "counts", "ids", "checksum"))):
            numbers = at.pop(bucket, [])
            if zlib.crc32("\n".join(words[i] for i in numbers).encode()) != checksum:
                raise ValueError("the documents were read in another order the second time; give a written table")
            own = _read_numbers(own)
            data, said, a = own.astype("<u4").tobytes(), [table[x] for x in own.tolist()], 0
            for i, b in zip(numbers, np.cumsum(_read_numbers(counts), dtype=np.int64).tolist()):
                if a < b:  # a word without ids says nothing
                    ids[i], texts[i] = data[4 * a : 4 * b], b" ".join(said[a:b])
                a = b
        if at:
            raise ValueError("words of a block are missing")
        silent = None in texts
        out: list[list] = [[] for _ in range(6 if with_ids else 4)]
        for doc_ids, counts, codes in zip(*(rows.column(c).to_pylist() for c in ("doc_ids", "counts", "codes"))):
            if codes is None:
                continue
            for doc_id, numbers in zip(doc_ids, _cut(_read_numbers(codes), _read_numbers(counts))):
                numbers = numbers.tolist()
                all_ids, decoded = b"".join(map(ids.__getitem__, numbers)), b" ".join(filter(None, map(texts.__getitem__, numbers)) if silent else map(texts.__getitem__, numbers))
                values = (doc_id, len(all_ids) // 4, hashlib.sha256(all_ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                for x, value in zip(out, (*values, np.frombuffer(all_ids, "<i4"), decoded.decode()) if with_ids else values):
                    x.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(out)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return blocks.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(run, schema)


def encode_decode_words(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False, block_bytes: int = BLOCK_BYTES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Encodes every whole text as the tokenizers library does with the vocabulary file, and decodes the ids.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded. No
    special tokens are added; the strings of added tokens in a text are these tokens, as the
    library reads them. A null or empty text has no tokens and the digests of nothing. Repeated
    rows and null doc_ids stay, one result a row; other columns are not read; an empty table gives
    no rows.

    Blocks are shuffled once and read from there twice. They are made as batches come, so docs has to
    give the same rows in the same order if a lost task is run again, as tables do; a checksum of
    each block's words ends the job where it doesn't. A task holds one block, and the distinct words
    of one bucket, of which there are eight times spark.sql.shuffle.partitions.
    """
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    buckets = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = F.split(F.coalesce(docs["text"].cast("string"), F.lit("")), SPLIT)
    blocks = _numbered(docs.select(docs["doc_id"].cast("long").alias("doc_id"), words.alias("words")), block_bytes, block_words).repartition("block")
    bucketed = _bucketed(blocks, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return _positioned(blocks, _encoded(bucketed, vocabulary), vocabulary, buckets, with_ids)
