"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

White space decides where byte-level BPE may be cut: a token never reaches over a single
space that stands between two other characters, and such a space begins the next token. So a
text is the sequence of its space-separated pieces, each piece is encoded once by the library
and kept, and the ids of a text are the ids of its pieces one after the other. That gives the
ids of the whole text and costs one library call for each distinct piece.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import slices, strings

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_PLAIN_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
#: Longer pieces are encoded but not kept; so many pieces are kept, and parts of pieces.
KEPT_CHARS, KEPT_PIECES, KEPT_PARTS = 200, 500_000, 100_000

# The byte-level pattern's classes.
#: Up to U+024F, where a table of classes is short: what the byte-level pattern calls white space, letters and numbers.
_S, _L, _N = "\\t-\\r \x85\xa0", "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_LATIN = re.compile("[\0-ɏ]*")
_LATIN_PRETOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
#: A word and marks after it, which are a part each.
_LATIN_WORD_MARKS = re.compile(f"([{_L}]+)([!-/:-@\\[-`{{-~]+)").fullmatch


def byte_chars() -> list[str]:
    """The character that stands for each byte (fixed values): printable Latin-1 bytes for themselves, the others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _pieces(text: str) -> list[str]:
    """The text cut at its single spaces; white space beside a space is no place to cut."""
    if "  " in text or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
        return _PLAIN_SPACE.split(text)
    return text.split(" ")


class _Kept(dict):
    """What make gives for a key; long keys aren't kept, and a full table starts anew."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self._make, self._most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self._make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self._most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers.

    pretokens: the parts of a text that are merged separately; model: the library's BPE over
    characters that stand for bytes.
    """

    def __init__(self, pretokens: Callable[[str], list[str]], model):
        self._pretokens, self._merge = pretokens, model.tokenize
        self._shown = dict(enumerate(byte_chars()))
        self._parts, self._after_space = _Kept(self._part, KEPT_PARTS), _Kept(self._piece, KEPT_PIECES)

    def _part(self, part: str) -> bytes:
        return self._merged(part.encode().decode("latin-1").translate(self._shown))

    def _merged(self, shown: str) -> bytes:
        return array("I", [x.id for x in self._merge(shown)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii():  # a word and the mark after it are a part each
            if piece.isalpha():
                return self._merged("Ġ" + piece)
            if piece[-1:] in {",", "."} and (word := piece[:-1]).isalpha():
                return self._after_space[word] + self._parts[piece[-1]]
        elif piece.isalpha() and _LATIN.fullmatch(piece):  # one part as well
            return self._part(f" {piece}")
        if m := _LATIN_WORD_MARKS(piece):
            return self._after_space[m[1]] + self._parts[m[2]]
        return self._text(f" {piece}")

    def _text(self, text: str) -> bytes:
        return b"".join(map(self._parts.__getitem__, _LATIN_PRETOKENS(text) if _LATIN.fullmatch(text) else self._pretokens(text)))

    def forget(self) -> None:
        """Gives back the memory of what is kept."""
        self._parts.clear()
        self._after_space.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        ids = self._after_space.__getitem__
        cut = map(_pieces, texts)
        return [self._text(pieces[0]) + b"".join(map(ids, pieces[1:])) for pieces in cut]


class AddedEncoder:
    """Reads the strings of a file's added tokens in a text as these tokens, as the library's encode does; what stands between them is encoded alone."""

    def __init__(self, encoder: Encoder, added: dict[str, int]):
        self._encoder, self._ids = encoder, {x: array("I", [i]).tobytes() for x, i in added.items()}
        self.forget = encoder.forget
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def encode(self, texts: list[str]) -> list[bytes]:
        out = self._encoder.encode(texts)
        for i, text in enumerate(texts):
            if any(x in text for x in self._ids):
                parts = self._split(text)
                plain = iter(self._encoder.encode(parts[::2]))
                out[i] = b"".join(self._ids[x] if k % 2 else next(plain) for k, x in enumerate(parts))
        return out


@lru_cache(maxsize=4)
def json_encoder(path: str, added: bool = False) -> Encoder | AddedEncoder:
    """Of a file of a byte-level BPE tokenizer.

    added: strings of the file's added tokens in a text are these tokens, as in the library's
    encode(text, add_special_tokens=False); else they are ordinary text (its encode_special_tokens).
    """
    if added:
        with open(path) as file:
            said = json.load(file)["added_tokens"] or []
        if any(x[k] for x in said for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that take in what is beside them")
        return AddedEncoder(json_encoder(path), {x["content"]: x["id"] for x in said}) if said else json_encoder(path)
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path) as file:
        said = json.load(file)
    if said["normalizer"] or said["pre_tokenizer"]["type"] != "ByteLevel" or said["model"]["type"] != "BPE":
        raise ValueError(f"{path} is no plain byte-level BPE")
    Tokenizer.from_file(path)  # the library's own check of the file
    merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in said["model"]["merges"]]
    model = BPE(vocab=said["model"]["vocab"], merges=merges, cache_capacity=0)
    split = ByteLevel(add_prefix_space=False, use_regex=True)
    return Encoder(lambda text: [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)], model)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that a token is made of in the end, when parts are merged by the ranks, lowest and leftmost first."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(rank, i) for i in range(len(parts) - 1) if (rank := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            return None
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> Encoder:
    """Of a rank file: the tokenizers library with one merge for each token, in the ranks' order.

    Ranks let any two neighbours merge that make a token; the library merges listed pairs. Both
    give the same: where two neighbours make up a token, nothing has merged across the token's
    borders, so what lies between them has become what it becomes alone, and the pair is the one
    that the token alone ends with.
    """
    from tokenizers import Regex
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import Split

    if pattern != public_tokenizers.PATTERN:
        raise ValueError("the places where a text may be cut hold for the byte-level pattern only")
    ranks, chars = read_ranks(path), byte_chars()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    pairs = (last_pair(token, ranks) for token in sorted(ranks, key=ranks.get))
    merges = [(shown[a], shown[b]) for a, b in filter(None, pairs)]
    model = BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)
    split = Split(Regex(pattern), "isolated")
    return Encoder(lambda text: [part for part, _ in split.pre_tokenize_str(text)], model)


@lru_cache(maxsize=2)
def rank_decoder(path: str) -> list[bytes]:
    """Bytes by id, through the byte table: the characters that stand for bytes, reversed."""
    ranks, chars = read_ranks(path), byte_chars()
    byte = {c: b for b, c in enumerate(chars)}
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = bytes(byte[c] for c in (chars[b] for b in token))
    return table


def decode_bytes(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode_pieces(ids: Iterable[int], table: list[bytes]) -> Iterator[str]:
    """Text id by id; bytes of a character that several ids share come out with the last of them."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    for i in ids:
        yield decoder.decode(table[i])
    yield decoder.decode(b"", final=True)


def token_offsets(ids: bytes, decoded: bytes, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """First and last-but-one code point of each token (int32 pairs), and how many tokens hold only a part of a character.

    decoded: the ids' bytes, a whole text in UTF-8; sizes: bytes of a token by id. A token of part of a character covers it whole.
    """
    ends = np.cumsum(sizes[np.frombuffer(ids, "<u4")])
    leads = np.ones(len(decoded) + 1, bool)  # does a character begin here
    leads[:-1] = (np.frombuffer(decoded, np.uint8) & 0xC0) != 0x80
    number = np.cumsum(leads) - 1  # of the character that a byte belongs to
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    pairs = np.stack([number[starts], number[ends - 1] + 1], axis=1).astype("<i4") if len(ends) else np.zeros((0, 2), "<i4")
    return pairs, int((~leads[starts] | ~leads[ends]).sum()) if len(ends) else 0


def encode_decode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encodes every whole text by a rank file and decodes the ids again.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256, offsets_sha256 (of the tokens' first and
    last-but-one code points, little-endian signed 32-bit pairs), n_split (tokens that hold only a
    part of a character) and, if asked for, ids, offsets and decoded. A null or empty text has no tokens and the digests of nothing. Repeated rows and null
    doc_ids stay, one result a row; other columns are not read. No shuffle.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    extra = ", ids array<int>, offsets array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = rank_encoder(vocabulary, pattern), rank_decoder(vocabulary)
        sizes = np.array([len(x) for x in table], np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            ids_sha, decoded_sha, offsets_sha, counts, splits, ids_out, offsets_out, decoded_out = ([] for _ in range(8))
            for ids in encoder.encode(strings(batch.column("text"))):
                decoded = decode_bytes(ids, table)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded).hexdigest())
                offsets, split = token_offsets(ids, decoded, sizes)
                offsets_sha.append(hashlib.sha256(offsets.tobytes()).hexdigest())
                splits.append(split)
                if with_ids:
                    ids_out.append(np.frombuffer(ids, "<i4"))
                    offsets_out.append(offsets.ravel())
                    decoded_out.append(decoded.decode())
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string()), "offsets_sha256": pa.array(offsets_sha, pa.string()), "n_split": pa.array(splits, pa.int64())}
            if with_ids:
                columns |= {"ids": pa.array(ids_out, pa.list_(pa.int32())), "offsets": pa.array(offsets_out, pa.list_(pa.int32())), "decoded": pa.array(decoded_out, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string, n_split long{extra}")
