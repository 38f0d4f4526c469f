"""Clustering around centroids, BPE by distinct words, and the audit of filters: against brute force."""

import hashlib
import math
import random
from fractions import Fraction
from itertools import permutations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridspark.llm import centroids, filter_audit, word_bpe
from gridspark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["op11_centroids", "op13_filter_audit"])
def test_query_beside_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got, out = QUERIES[name](spark, SMALL), db.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(out.columns)
    assert sorted(map(tuple, got.select(out.columns).collect())) == sorted(out.fetchall())


# --- centroids


def brute_clusters(rows, k, rounds, size):
    """Over Python's integers: rows of vec_id, components."""
    kept = [(i, [math.floor(Fraction(x) * 64) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    floats = {id(x): v for (_, x), v in zip(kept, [v for _, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)])}
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", floats[id(r[1])]))
    middles = [x for _, x in order[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min(range(len(middles)), key=lambda c: (far(x, middles[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x), []).append(x)
        middles = [[sum(col) // len(groups[c]) for col in zip(*groups[c])] if c in groups else m for c, m in enumerate(middles)]
    won = [(i, c := nearest(x), far(x, middles[c])) for i, x in kept]
    inertia = lambda c: sum(d for _, o, d in won if o == c)
    long = lambda n: n if n < 1 << 63 else None
    known = lambda c: all(d < 1 << 63 for _, o, d in won if c in (o, None))
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return sorted(((i, c, long(d), long(inertia(c)) if known(c) else None, long(sum(d for *_, d in won)) if known(None) else None, sha[c]) for i, c, d in won), key=str)


def clusters(spark, rows, **how):
    df = spark.createDataFrame([(v, i, "x", 1.0) for i, v in rows], "embedding array<double>, vec_id long, cluster string, distance double")
    return sorted(map(tuple, centroids.cluster_vectors(df, **how).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_clusters(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.02, 0.0, 0.015625, 0.5, -1.0, rng.uniform(-1, 1)]) for _ in range(4)]) for i in range(120)]
    rows += rows[:20] + [(None, [0.1, 0.2, 0.3, 0.4]), (None, [0.0] * 4), (500, None), (501, [0.1] * 3), (502, [math.nan, 0.0, 0.0, 0.0]), (503, [math.inf, 0.0, 0.0, 0.0]), (504, [None, 0.0, 0.0, 0.0]), (505, [])]
    got = clusters(spark, rows, k=5, rounds=3, size=4)
    assert got == brute_clusters(rows, 5, 3, 4) and len(got) == 142


def test_clusters_of_large_components(spark):
    """Beyond 64 bits all is computed with exactly; what a long can't hold is null."""
    rows = [(i, [x * 10.0**p, -3.0, 0.25]) for i, (x, p) in enumerate([(1, 0), (-1, 7), (2.5, 9), (-2.5, 12), (1, 300), (-1.7, 308), (3, 5), (4, 5), (1, 1), (2, 2)])]
    assert clusters(spark, rows, k=3, rounds=2, size=3) == brute_clusters(rows, 3, 2, 3)
    near = [r for r in rows if abs(r[1][0]) < 1e9]
    got = clusters(spark, near, k=2, rounds=3, size=3)
    assert got == brute_clusters(near, 2, 3, 3) and all(x is not None for r in got for x in r)


def test_few_vectors_and_none(spark):
    assert clusters(spark, [], k=4, size=2) == [] and clusters(spark, [(1, [0.0])], k=4, size=2) == []
    rows = [(7, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [0.5, 0.5])]
    got = clusters(spark, rows, k=16, size=2)
    assert got == brute_clusters(rows, 16, 3, 2) and {r[1] for r in got} == {0}  # all on every bisector


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-(1 << 90), 1 << 90), min_size=2, max_size=2), min_size=1, max_size=6), st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=1, max_size=6))
def test_the_tournament_finds_the_nearest(wide, tight):
    for middles in (wide, tight):
        x = [*wide[:2], *tight, [0, 0]]
        data = np.array(x, object if middles is wide or max(abs(v) for r in x for v in r) >= centroids.PLAIN else np.int64)
        won = centroids.Bisectors(middles).nearest(data)
        assert [int(c) for c in won] == [min(range(len(middles)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(r, middles[c])), c)) for r in x]


# --- BPE by distinct words


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(WORDS)

    def run(text):
        ids = made.encode(text or "", add_special_tokens=False).ids
        return ids, made.decode(ids, skip_special_tokens=False)

    return run


def odd_texts(n=1500, seed=3):
    rng = random.Random(seed)
    parts = [*" \n\t\r\x0b\x0c\x1c\x85 ̸́̊.,;:!?)](\"'<=>|aBsTéÉWİΣſ1²中", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "word", "Don't", "é", "≠", "😀"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


TEXTS = ["", None, " ", "\n\n", "Hello there,  world!\n", "x" * 5000 + " y", "a<|endoftext|>b", "the the the", "́ a", "end.", "a.̸b W̊", "12ab 3.4", ".", "\x1c"]


@pytest.mark.parametrize("block", [(1, 1), (5000, 60), (8 << 20, 1 << 16)])
def test_words_give_the_ids_of_whole_texts(spark, library, block):
    texts = [*TEXTS, *odd_texts(), *TEXTS]
    df = spark.createDataFrame([(None if i % 97 == 5 else i // 2, t, 3, "clash", [1]) for i, t in enumerate(texts)], "doc_id long, text string, block int, words string, ids array<int>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = word_bpe.encode_decode_words(df.repartition(3), with_ids=True, block_bytes=block[0], block_words=block[1]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for i, t in enumerate(texts):
        ids, text = library(t)
        want.append((None if i % 97 == 5 else i // 2, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_many_words_in_a_document(spark, library):
    """More words than two bytes can number."""
    rng = random.Random(1)
    text = " ".join(np.base_repr(rng.randrange(36**5), 36) for _ in range(80_000))
    ids, said = library(text)
    got = word_bpe.encode_decode_words(spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string"), with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {1: ids, 2: library("a")[0]}


def test_word_query_reads_all_documents(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: r["ids_sha256"] for r in QUERIES["op12_word_bpe"](spark, SMALL).collect()}
    assert got == {r["doc_id"]: hashlib.sha256(np.array(library(r["text"])[0], "<u4").tobytes()).hexdigest() for r in docs}
    assert word_bpe.encode_decode_words(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_only_tokenizers_of_words(tmp_path):
    with pytest.raises(ValueError):
        word_bpe.word_encoder(public_tokenizers.path("byte_bpe_50k.json"))


# --- the audit of filters


def brute_audit(docs, labels):
    white = " \t\n\x0b\x0c\r"
    split = lambda t: "".join(" " if c in white else c for c in t).split(" ")
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = {}
    for i, t, source in docs:
        t = t or ""
        w = [x for x in split(t) if x]
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        known = [x for x in labels if x[0] is not None and x[0] == i]
        parts.setdefault(source or "", []).append((fails, any(x[1] == 1 for x in known), any(x[2] == 1 for x in known)))
    out = []
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                lost, before = [r for r in left if r[0][f]], left
                left = [r for r in left if not r[0][f]]
                shapley[f] += len(lost)
                again = sum(r[0][f] for r in rows) - sum(r[0][f] for r in before)
                only = sum(r[0][f] and sum(r[0].values()) == 1 for r in rows)
                found.append((f, (part, order, step, len(left), len(lost), again, only, sum(r[1] for r in lost), sum(r[2] for r in lost))))
        out += [(*row, shapley[f]) for f, row in found]
    return sorted(out)


def audit_rows(seed=5, n=250):
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "DELTA", "x", "y", "z$", "10%", "é", "中文"]
    texts = ["", None, " ", "A" * 50, "#", "w\x0bv\x1c", "\n".join(f"w{i}" for i in range(200)), " ".join(["same"] * 300)]
    texts += [" ".join(rng.choice(words[: rng.randint(1, 10)]) + str(rng.randrange(rng.choice([1, 400]))) for _ in range(rng.choice([5, 199, 200, 260]))) for _ in range(20)]
    docs = [(rng.choice([None, i, i, i, i // 2]), rng.choice(texts), rng.choice(["a", "a", "a", "b", None, ""])) for i in range(n)]
    labels = [(rng.choice([None, i]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)] + [(4, 1, 1), (4, 0, 0), (10**9, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("range_docs", [1, 7, 1 << 16])
def test_audit(spark, range_docs):
    docs, labels = audit_rows()
    df = spark.createDataFrame([(*r, 1, True) for r in docs], "doc_id long, text string, source string, part int, good boolean").repartition(3)
    known = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id long, quality int, toxic int, text string")
    assert sorted(map(tuple, filter_audit.audit(df, known, range_docs).collect())) == brute_audit(docs, labels)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    got = filter_audit.audit(one, labels).collect()
    assert len(got) == 600 and sorted(map(tuple, got)) == brute_audit([(1, "a", "s")], [])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40)), min_size=7, max_size=7))
def test_sizes_of_unions(sets):
    lists = [np.array(sorted(s), np.int32) for s in sets]
    want = [len(set().union(*([x & only for x in sets[:5]][f] for f in range(5) if s >> f & 1))) for only in (set(range(41)), sets[5], sets[6]) for s in range(32)]
    assert filter_audit.union_sizes(lists) == want


def test_postings_cover_each_document_once(spark):
    docs, labels = audit_rows(seed=6)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    rows = filter_audit.postings(filter_audit.judged(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), 20).collect()
    assert sum(r["n"] for r in rows) == len(docs) and all(r["n"] <= 20 for r in rows)
    assert all(x == sorted(set(x)) and (not x or x[-1] < r["n"]) for r in rows for x in r["lists"])
