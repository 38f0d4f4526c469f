"""Exact duplicates, the n-gram Jaccard join, near-duplicate vectors, components: against brute force."""

import hashlib
import random

import numpy as np
import pytest

from gridspark.llm import embedding_dedup, exact_dedup, ngram_jaccard
from gridspark.llm.components import components

DOCS = "doc_id long, text string, n long, k1 long, norm string"


def table(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 5, 6, "clash") for i, t in rows], DOCS)


def smallest_reachable(nodes, links):
    least = {x: x for x in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(least[a], least[b])
            moved |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


@pytest.mark.parametrize("shape", ["chain", "star", "random", "clique"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {"chain": [(i, i + 1) for i in range(60)], "star": [(99, i) for i in range(60)], "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)], "clique": [(a, b) for a in range(12) for b in range(12)]}[shape]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 5), (7777, 7777)], "a long, b long")).collect()}
    nodes = {x for l in links if l[0] != l[1] for x in l}
    want = smallest_reachable(nodes, [l for l in links if l[0] != l[1]])
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def exact(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_duplicates(spark):
    rng = random.Random(1)
    texts = [None, "", "a", "A", "É", "é", "x" * 9000, "X" * 9000, "İ", "i̇", "a "]
    rows = [(i, texts[min(int(rng.expovariate(0.4)), len(texts) - 1)]) for i in range(300)] + [(None, "a"), (None, "only null"), (5, "a"), (5, "a")]
    rows += [(None, "no id at all")] * 200 + [(7, "one id")] * 200
    want = exact(rows)
    for salts in (1, 3, 64):
        got = exact_dedup.exact_duplicates(table(spark, rows).repartition(7), salts=salts)
        assert sorted((tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == want
    assert exact_dedup.exact_duplicates(table(spark, [])).count() == 0


def test_exact_duplicates_plan_is_native(spark):
    df = exact_dedup.exact_duplicates(table(spark, [(1, "a")]))
    said = df._jdf.queryExecution().toString()
    assert "EvalPython" not in said and "InArrow" not in said


def test_dropping_exact_duplicates_keeps_columns(spark):
    out = exact_dedup.drop_exact_duplicates(table(spark, [(1, "a"), (2, "A"), (3, "b"), (None, "c")]))
    assert out.columns == ["doc_id", "text", "n", "k1", "norm"]
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [2, 3, None]


def test_dropping_exact_duplicates_goes_by_row(spark):
    # A repeated row stays once; a row goes although its doc_id is another text's winner.
    rows = [(1, "a"), (1, "a"), (1, "A"), (2, "b"), (2, "b "), (3, "b"), (None, "c"), (None, "c"), (None, "b"), (4, None), (5, "")]
    out = exact_dedup.drop_exact_duplicates(table(spark, rows)).collect()
    assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in out), key=str) == sorted([(1, "a"), (2, "b "), (3, "b"), (None, "c"), (5, "")], key=str)
    assert exact_dedup.drop_exact_duplicates(table(spark, [])).count() == 0


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    links.append((rows[a][0], rows[b][0]))
    least = smallest_reachable({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), least.get(i)) for (i, _), s in zip(rows, sets)), key=str)


def edited(rng, words, share):
    return " ".join(rng.choice(["new", "odd", "word"]) + str(rng.randrange(99)) if rng.random() < share else w for w in words)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 50), (2, 100)])
def test_jaccard_join(spark, size, percent):
    rng = random.Random(size)
    word = lambda: rng.choice("the of and in to is it on".split()) if rng.random() < 0.5 else f"w{rng.randrange(3000)}"
    passage = " ".join(word() for _ in range(60))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([5, 30, 120]))]
        for _ in range(rng.choice([1, 1, 3, 9])):
            rows.append((len(rows), edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.2]))))
    rows += [(len(rows) + i, f"{passage} {word()} {word()} tail{i}") for i in range(12)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "ONE  two"), (1005, "one"), (None, "one two"), (1006, "one two one two one two one"), (1007, "One Two one two one")]
    got = ngram_jaccard.near_duplicates(table(spark, rows).repartition(3), size, percent).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == jaccard(rows, size, percent)


def test_jaccard_join_at_the_threshold(spark):
    words = [f"w{i}" for i in range(203)]  # 200 shingles of 4
    rows = [(1, " ".join(words))]
    for i, cut in enumerate((29, 30, 31)):  # 170 of 200 is the threshold
        rows.append((10 + i, " ".join(words[cut:])))
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.near_duplicates(table(spark, rows[:1] + rows[2:3]), 4, 85).collect()}
    assert got == {1: 1, 11: 1}
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.near_duplicates(table(spark, rows[:1] + rows[3:4]), 4, 85).collect()}
    assert got == {1: 1, 12: 12}


def test_jaccard_join_of_empty_and_repeated_rows(spark):
    assert ngram_jaccard.near_duplicates(table(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y z q r s"), (1, "x y z q r s"), (3, "x y z q r s")]
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_jaccard.near_duplicates(table(spark, rows)).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]


def test_dropping_near_duplicates(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:98])), (3, "something else altogether here now"), (None, "no id"), (4, None)]
    out = ngram_jaccard.drop_near_duplicates(table(spark, rows))
    assert out.columns == ["doc_id", "text", "n", "k1", "norm"]
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [1, 3, 4, None]


def brute_vectors(rows, threshold=0.95):
    ok = {k: np.array(x, np.float64) for k, (_, x) in enumerate(rows) if x and all(v is not None and np.isfinite(v) for v in x) and any(x)}
    unit = {k: x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) for k, x in ok.items()}
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b]) and unit[a] @ unit[b] >= threshold]
    least = smallest_reachable({i for i, _ in rows}, [(rows[a][0], rows[b][0]) for a, b in links])
    n = {k: 0 for k in range(len(rows))}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return sorted((i, n[k], least[i], least[i] == i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("group", [7, 64, 8192])
def test_near_duplicate_vectors(spark, group):
    rng = np.random.default_rng(group)
    rows = []
    for _ in range(25):
        base = rng.standard_normal(16)
        for _ in range(int(rng.choice([1, 1, 4, 15]))):
            rows.append((len(rows), (base + rng.standard_normal(16) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist()))
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e-30] * 16), (909, [1e30] * 16), (910, [1e-30] * 16)]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id long, embedding array<float>, rep long, g int").repartition(3)
    got = embedding_dedup.near_duplicate_vectors(df, group=group).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == brute_vectors(rows)


def test_vectors_without_rows(spark):
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(0)
    unit = embedding_dedup.unit_rows(rng.standard_normal((200, 48)).astype(np.float32))
    codes, scales, errors = embedding_dedup.quantise(unit)
    back = scales[:, None] * codes
    assert (np.linalg.norm(unit - back, axis=1) <= errors).all()
    gap = np.abs(unit @ unit.T - back @ back.T)
    assert (gap <= errors[:, None] + errors * (1 + errors[:, None]) + 1e-12).all()


def test_vectors_are_compared_in_double_precision(spark):
    # Two vectors whose cosine reaches the threshold in double precision only, and values beyond float.
    near, just = [1.0, 0.0], [0.95 + 1e-12, (1 - (0.95 + 1e-12) ** 2) ** 0.5]
    rows = [(1, near), (2, just), (3, [1e300, 1e299]), (4, [1e-300, 1e-301]), (5, [float("nan"), 1.0]), (6, None)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[1][0] >= 1 and got[2][0] >= 1 and got[2][1] == 1
    assert got[4][1] == got[3][1] and got[5] == (0, 5) and got[6] == (0, 6)


def test_links_do_not_depend_on_what_stands_beside_them():
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    close = base + 0.32 * rng.standard_normal((400, 16))  # many pairs about the threshold
    far = rng.standard_normal((400, 16))

    def packed(x):
        unit = embedding_dedup.unit_rows(x)
        codes, scales, errors = embedding_dedup.quantise(unit)
        return {"codes": codes, "scales": scales, "errors": errors, "vectors": x, "copies": np.ones(len(x), np.int64)}

    unit = embedding_dedup.unit_rows(close)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    alone, _ = embedding_dedup.tile_links(packed(close), None, 0.95)
    among, _ = embedding_dedup.tile_links(packed(np.concatenate([close, far])), None, 0.95)
    assert (alone == want).all() and (among[:400] == want).all()


def test_one_large_component_and_an_outsider(spark):
    # Near copies of one text, more than a block of them, and a text that shares a rare passage with all.
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:50], f"x{i}"])) for i in range(700)] + [(5000, " ".join([*words[:6], *(f"y{i}" for i in range(60))]))]
    got = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.near_duplicates(table(spark, rows)).collect()}
    assert all(got[i] == 0 for i in range(700)) and got[5000] == 5000
