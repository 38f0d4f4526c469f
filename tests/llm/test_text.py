"""Word hashing, byte-level BPE and token segments."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridspark.llm import bpe, packing, token_blocks
from gridspark.llm.queries import QUERIES
from gridspark.llm.text_hash import bytes_of, runs, words

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, ids string"
TEXTS = ["", None, " ", "\n\n", "Hello there,  world!\n", "é" * 300, "a b c", "<|endoftext|> x", "x" * 5000 + " y", "中文 テスト　z", "a  b \t c", "tail ", "I'll we've 12 ab12"]


@pytest.fixture(scope="module")
def whole():
    """Ids with special strings as ordinary text, which is what the functions do unless added is set."""
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranked():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=3000, seed=1):
    rng = random.Random(seed)
    letters = " \n\t 　\x1c\x85aab'slD1²é中.!ſ"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé \t\n\x0b\x1f,中", max_size=40), max_size=8), st.integers(1, 64))
def test_words_are_those_of_each_text(texts, most):
    data, offsets = bytes_of(pa.array(texts, pa.string()))
    got, known = [], {}
    for a, b in runs(offsets, most):
        w = words(data, offsets[a : b + 1])
        for d in range(b - a):
            got.append(w.hashes[w.first[d] : w.first[d + 1]].tolist())
    want = [x.encode().lower().split() for x in texts]
    assert [len(x) for x in got] == [len(x) for x in want]
    for g, w in zip(got, want):
        for h, word in zip(g, w):
            assert known.setdefault(word, h) == h
    assert len({*known.values()}) == len(known)


def test_pieces_give_the_ids_of_whole_texts(whole):
    texts = odd_texts() + [x or "" for x in TEXTS]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.json_encoder(JSON).encode(texts)] == [whole(x) for x in texts]


def test_queries_read_added_tokens_as_the_library_does(spark, tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    ids = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    texts = [*TEXTS, "a <|endoftext|> x  <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|", "b<|endoftext|>\n c"]
    spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op1_token_blocks"](spark, str(tmp_path)).collect()}
    start = 0
    for i, t in enumerate(texts):
        want = [*ids(t), 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i][3]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    assert packed_right(QUERIES["op8_packing"](spark, str(tmp_path)).collect(), [*enumerate(texts)], 2048, ids) >= 0


def test_ranks_give_the_ids_of_tiktoken_and_decode(ranked):
    texts = odd_texts(seed=2) + [x or "" for x in TEXTS] + ["aaaaaaa" * 9, "xaaaaa aaaaaxx", "\n" * 50]
    table = bpe.rank_decoder(RANKS)
    for text, ids in zip(texts, bpe.rank_encoder(RANKS, public_tokenizers.PATTERN).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == ranked.encode_ordinary(text)
        assert bpe.decode_bytes(ids, table).decode() == text
        assert "".join(bpe.decode_pieces(np.frombuffer(ids, "<u4").tolist(), table)) == text


def test_offsets_cover_the_text(ranked):
    table = bpe.rank_decoder(RANKS)
    sizes = np.array([len(x) for x in table])
    for text in ("été 中文 ok", "🙂 a", "", "abc", "中🙂é" * 9):
        ids = bpe.rank_encoder(RANKS, public_tokenizers.PATTERN).encode([text])[0]
        spans, split = bpe.token_offsets(ids, text.encode(), sizes)
        # Brute force: the characters that a token's bytes fall in.
        of = [i for i, c in enumerate(text) for _ in c.encode()]
        at, want, cut = 0, [], 0
        for i in np.frombuffer(ids, "<u4").tolist():
            mine = of[at : at + len(table[i])]
            want.append([mine[0], mine[-1] + 1])
            cut += of[:at][-1:] == mine[:1] or of[at + len(mine) :][:1] == mine[-1:]
            at += len(mine)
        assert spans.tolist() == want and split == cut


def test_encode_decode_rows(spark, ranked):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "x", ""), (3, "\n\n", "")]
    got = bpe.encode_decode(spark.createDataFrame(rows, DOCS), with_ids=True).collect()
    want = sorted((-1 if i is None else i, ranked.encode_ordinary(t or ""), t or "") for i, t, _ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"], r["decoded"]) for r in got) == want
    for r in got:
        ids = np.array(r["ids"], "<u4").tobytes()
        assert r["offsets_sha256"] == hashlib.sha256(np.array(r["offsets"], "<i4").tobytes()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(r["ids"]), hashlib.sha256(ids).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest())
    assert bpe.encode_decode(spark.createDataFrame([], DOCS)).count() == 0


def test_ranks_and_tiktoken_agree_on_any_text(ranked):
    # Parts that several splits make up are where lists of pairs and ranks could differ.
    with open(RANKS, "rb") as file:
        tokens = [base64.b64decode(x.split()[0]) for x in file]
    rng, encoder = random.Random(8), bpe.rank_encoder(RANKS, public_tokenizers.PATTERN)
    for _ in range(20_000):
        text = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 8))).decode("utf-8", "replace") if rng.random() < 0.5 else "".join(rng.choice("abcde=-") for _ in range(rng.randint(1, 40)))
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == ranked.encode_ordinary(text), text


def test_block_and_share_are_checked():
    for block, share in ((0, 0.5), (1 << 17, 0.5), (256, 1.5), (256, 0.0)):
        with pytest.raises(ValueError):
            token_blocks.encode_segment(np.zeros(3, np.uint32), block, share)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1100), st.sampled_from([1, 2, 300, 50257, 2**32]), st.floats(0.05, 1), st.sampled_from([8, 128, 256]), st.integers(0, 9))
def test_segments_round_trip(n, top, share, block, seed):
    ids = np.minimum(np.random.default_rng(seed).pareto(0.3, n) * 40, top - 1).astype(np.uint32)
    segment = token_blocks.encode_segment(ids, block, share)
    assert (token_blocks.decode_segment(segment) == ids).all()
    for i in range(-(-n // block)):
        assert (token_blocks.decode_block(segment, i) == ids[i * block : (i + 1) * block]).all()
    with pytest.raises(IndexError):
        token_blocks.decode_block(segment, -(-n // block))


def test_segments_are_small():
    ids = np.minimum(np.random.default_rng(0).pareto(0.7, 100_000) * 100, 50_256).astype(np.uint32)
    assert len(token_blocks.encode_segment(ids)) < 2.1 * len(ids)
    with pytest.raises(ValueError):
        token_blocks.decode_segment(b"x" * 100)


def test_token_blocks_against_brute_force(spark, whole):
    rows = [(7 * i % 13, t, "clash") for i, t in enumerate(TEXTS)]
    got = token_blocks.token_block_report(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    start, want = 0, []
    for i, t, _ in sorted(rows):
        ids = [*whole(t), 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in got) == want
    assert token_blocks.token_block_report(spark.createDataFrame([], DOCS)).count() == 0
    odd = token_blocks.token_block_report(spark.createDataFrame([(None, "b", ""), (1, "a", ""), (1, "a", "")], DOCS)).collect()
    assert sorted((r["start"], r["doc_id"]) for r in odd) == [(0, None), (2, 1), (4, 1)]


def packed_right(rows, docs, capacity, ids_of):
    """Every invariant that packing promises."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert {*by_doc} == {i for i, _ in docs}
    for i, text in docs:
        ids, at = [*ids_of(text), 1], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / max(total, 1)


def test_packing(spark, whole):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["the", "packed", "of", "é", "12"]) for _ in range(rng.choice([0, 3, 40, 700, 5000])))) for i in range(200)] + [(900, None)]
    df = spark.createDataFrame([(*x, "") for x in docs], DOCS)
    assert packed_right(packing.pack(df).collect(), docs, 2048, whole) < 0.01
    assert packed_right(packing.pack(df.repartition(9), capacity=64, least=8).collect(), docs, 64, whole) < 0.05
    assert packing.pack(df.limit(0)).count() == 0
    assert packing.pack(spark.createDataFrame([(None, "a", ""), (None, "a", "")], DOCS)).count() == 2
    with pytest.raises(ValueError):
        packing.pack(df, capacity=1000)


@given(st.integers(0, 20_000))
def test_piece_lengths(n):
    lengths = packing.piece_lengths(n, 2048, 64)
    assert sum(lengths) == n and all(0 < x <= 2048 for x in lengths)
    assert all(x == 2048 // (2048 // x) for x in lengths[:-1])  # parts of a sequence, but for the last
    assert len(lengths) <= n // 2048 + 5
