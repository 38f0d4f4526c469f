"""Exact Jaccard join of documents on word n-grams, filtered under several token orders.

Two sets can only be similar enough if they share one of the first few tokens of each, whatever
order all tokens are put in. So a pair is verified only if it shares such a prefix token under
every one of several orders. All orders put rare tokens first; among tokens of like rarity each
has its own pseudo-random order. Rarity is that of a token's rarest word, counted over all
documents in a table of a fixed size, so that words and passages that many documents share come
last and lie in no prefix.

Documents with equal sets are one from the start. Under the first order, all sets that hold a
prefix token are compared with the largest of them and with the one that shares its prefix with
most others, which of a group of copies is the least changed; then components are formed,
and only pairs of sets that share a prefix token and are in different components are left to
compare. So a group of copies costs about two comparisons for each, and no link between
components is lost. Where few sets hold a token these pairs are joined; where many do, blocks of
them are compared within tasks, which return only pairs that the bound below lets pass.

Before the other orders' prefixes and then whole sets are moved, a bound is tried: how many tokens
of each set fall in each of some parts of the hash range. The sum of the parts' smaller numbers is
at least the size of the overlap. Whole sets are compared last.

Tokens are 60 bits of a hash and sets are told apart by 128: of a pair with 1000 tokens each, one
false common token has odds of about 1 in 10**12, and two sets that are taken for one about
1 in 10**38 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import discard, stored
from gridspark.llm.components import components
from gridspark.llm.text_hash import U, Words, bytes_of, mix, runs, words

#: Counters of words: a table of this size is made over all documents and sent to the tasks.
COUNTERS_LOG2 = 18
#: Seeds of the orders after the first.
ORDERS = (0x1F3D5B79A2C4E68F, 0x7A96B5D4E3F20189)
#: Parts of the hash range in which each set's tokens are counted.
PARTS_LOG2 = 8
#: Sets of a token that are paired by a join; sets of a block, where there are more.
FEW, BLOCK = 16, 256
#: So many documents to verify are sent to all executors as a list of ids (8 bytes each); more are found by a shuffle.
LISTED = 500_000
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 64, dtype=np.uint64) | U(1)
_VALUE = U((1 << 60) - 1)
_SEEDS = U(0x243F6A8885A308D3), U(0x13198A2E03707344)


def prefix_size(n: int | np.ndarray, percent: int):
    """Of n tokens in any order, how many come before those that a similar set may lack."""
    return n - (-(-percent * n // 100)) + 1


def _shingles(w: Words, size: int, levels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of each text, and where each text's begin. A token: 4 bits of rarity, 60 of hash."""
    n, n_docs = len(w.hashes), len(w.first) - 1
    counts = np.diff(w.first)
    last = max(0, n - size + 1)
    level = levels[w.hashes >> U(64 - COUNTERS_LOG2)] if levels is not None else None
    total, least = np.zeros(last, U), np.full(last, 15, np.uint8)
    for j in range(size if last else 0):
        total += w.hashes[j : j + last] * _FACTORS[j]
        if level is not None:
            np.minimum(least, level[j : j + last], out=least)
    at = np.flatnonzero(w.doc[:last] == w.doc[size - 1 :][:last]) if last else np.zeros(0, np.int64)
    tokens, doc = mix(total[at]) & _VALUE, w.doc[at]
    if level is not None:
        tokens |= least[at].astype(U) << U(60)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        of = [(w.hashes[w.first[d] : w.first[d + 1]] * _FACTORS[: counts[d]]).sum(dtype=U, keepdims=True) for d in short.tolist()]
        extra = mix(np.concatenate(of) + _FACTORS[size] * counts[short].astype(U)) & _VALUE
        if level is not None:
            extra |= np.array([level[w.first[d] : w.first[d + 1]].min() for d in short.tolist()], U) << U(60)
        tokens, doc = np.concatenate([tokens, extra]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        tokens, doc = tokens[order], doc[order]
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    return tokens[new], np.searchsorted(doc[new], np.arange(n_docs + 1))


def _digests(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """128 bits that say which set it is, whatever the tokens' rarity: sums of hashes."""
    out = []
    for seed in _SEEDS:
        sums = np.zeros(len(tokens) + 1, U)
        np.cumsum(mix((tokens & _VALUE) ^ seed), out=sums[1:])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out


def _part_counts(tokens: np.ndarray, first: np.ndarray) -> pa.Array:
    """By text, tokens in each part of the hash range; null where a count is beyond 16 bits."""
    n_docs, parts = len(first) - 1, 1 << PARTS_LOG2
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    part = ((tokens & _VALUE) >> U(60 - PARTS_LOG2)).astype(np.int64)
    counts = np.bincount(doc * parts + part, minlength=n_docs * parts).reshape(n_docs, parts)
    over = counts.max(axis=1, initial=0) > 32767
    flat = pa.array(np.minimum(counts, 32767).astype(np.int16).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(n_docs + 1, dtype=np.int32) * parts), flat, mask=pa.array(over))


def _texts(batches: Iterator[pa.RecordBatch], size: int, levels: np.ndarray | None = None):
    """doc_ids, words, tokens and where they begin, for runs of whole texts."""
    for batch in batches:
        data, offsets = bytes_of(batch.column("text"))
        for a, b in runs(offsets):
            w = words(data, offsets[a : b + 1])
            yield batch.column("doc_id").slice(a, b - a), w, *_shingles(w, size, levels)


def _summary(docs: DataFrame, size: int) -> DataFrame:
    """A row a document: doc_id, n, k1, k2, parts; and rows counter, seen of word counts."""
    names = ["doc_id", "n", "k1", "k2", "parts", "counter", "seen"]
    parts_type = pa.list_(pa.int16())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << COUNTERS_LOG2, np.int64)
        for doc_ids, w, tokens, first in _texts(batches, size):
            seen += np.bincount((w.hashes >> U(64 - COUNTERS_LOG2)).astype(np.int64), minlength=len(seen))
            n, (k1, k2) = np.diff(first), _digests(tokens, first)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(n), pa.array(k1), pa.array(k2), _part_counts(tokens, first), none, none], names=names)
        at = np.flatnonzero(seen)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(at), parts_type), pa.array(at), pa.array(seen[at])], names=names)

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, parts array<short>, counter long, seen long")


def _rarity(summary: DataFrame) -> np.ndarray:
    """0 (rare) to 15 by counter: how many times twice the median count."""
    seen = np.zeros(1 << COUNTERS_LOG2)
    counted = summary.where("counter is not null").groupBy("counter").agg(F.sum("seen").alias("seen")).toPandas()
    seen[counted["counter"].to_numpy(np.int64)] = counted["seen"].to_numpy(np.float64)
    usual = max(1.0, float(np.median(seen)))
    return np.clip(np.floor(np.log2(np.maximum(seen, 1) / usual)), 0, 15).astype(np.uint8)


def _postings(docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """token, k1 for the first order's prefix of each set, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for _, _, tokens, first in _texts(batches, size, levels):
            k1, k2 = _digests(tokens, first)
            n = np.diff(first)
            take = []
            for d, key in enumerate(zip(k1.tolist(), k2.tolist())):
                if n[d] and key not in known:
                    known.add(key)
                    take.append(d)
            take = np.array(take, np.int64)
            sizes = prefix_size(n[take], percent)
            row = np.repeat(take, sizes)
            at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[row]
            yield pa.RecordBatch.from_arrays([pa.array(tokens[at].view(np.int64)), pa.array(k1[row])], names=["token", "k1"])

    return docs.mapInArrow(run, "token long, k1 long")


def _sets(docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """k1, k2, tokens and the prefixes under the other orders (32 bits of each token), once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        for _, _, tokens, first in _texts(batches, size, levels):
            k1, k2 = _digests(tokens, first)
            rows = []
            for d, key in enumerate(zip(k1.tolist(), k2.tolist())):
                own = tokens[first[d] : first[d + 1]]
                if not len(own) or key in known:
                    continue
                known.add(key)
                rows.append((*key, own.view(np.int64), *(_prefix(own, seed, percent) for seed in ORDERS)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names=["k1", "k2", "tokens", "second", "third"])

    return docs.mapInArrow(run, "k1 long, k2 long, tokens array<long>, second array<int>, third array<int>")


def _prefix(tokens: np.ndarray, seed: int, percent: int) -> np.ndarray:
    order = (tokens & ~_VALUE) | (mix(tokens ^ U(seed)) >> U(4))
    size = int(prefix_size(len(tokens), percent))
    return (np.partition(order, size - 1)[:size] & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _close(a: Column, b: Column, percent: int) -> Column:
    """Sizes that similar sets can have."""
    return (100 * F.least(a, b)) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Links (a, b) of pairs that pass the other orders' filters and are similar enough.

    Sets are made again from the texts of the documents that are in a pair, and of no others.
    """
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    # A list of ids of a checked size goes to all executors; a longer one is joined by a shuffle.
    chosen = docs.join(F.broadcast(wanted) if wanted.count() <= LISTED else wanted, "doc_id", "left_semi")
    sets = stored(_sets(chosen, size, percent, levels))

    def both(pairs: DataFrame, *columns: str) -> DataFrame:
        for x in "ab":
            pairs = pairs.join(sets.select("k1", "k2", *columns).toDF(f"{x}1", f"{x}2", *(f"{x}_{c}" for c in columns)), [f"{x}1", f"{x}2"])
        return pairs

    # The other orders' prefixes decide which pairs' whole sets are moved at all.
    pairs = both(pairs, "second", "third").where(F.arrays_overlap("a_second", "b_second") & F.arrays_overlap("a_third", "b_third"))
    pairs = both(pairs.select("a1", "a2", "b1", "b2", "a", "b"), "tokens")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    links = stored(pairs.where(100 * shared >= percent * (F.size("a_tokens") + F.size("b_tokens") - shared)).select("a", "b"))
    discard(wanted, sets)
    return links


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a1, a2, b1, b2, a, b) of sets of one token with different labels that the bound lets pass.

    members: token, k1, k2, rep, n, parts, label, top and most (the label with most sets of the
    token, and how many), others (all its other sets). The others are dealt to blocks of a
    bounded size, as are the sets of top; each two blocks of others are a group, and each of
    others with each of top. Sets of top never meet each other, so one large component costs as
    many comparisons as there are sets outside it.
    """
    cut = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("k1", "k2"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    is_top = F.col("label") == F.col("top")
    own = members.withColumn("block", F.when(is_top, cut("others") + place(cut("most"))).otherwise(place(cut("others"))))
    # Blocks of others are numbered from 0, those of top after them.
    own = own.withColumn("other", F.explode(F.when(is_top, upto(cut("others"))).otherwise(upto(cut("others") + cut("most")))))
    pairs = own.select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "k1", "k2", "rep", "n", "parts", "label")

    def compared(key, table):
        lo, hi = key[1].as_py(), key[2].as_py()
        n, label = table.column("n").to_numpy(), table.column("label").to_numpy()
        parts = np.full((len(n), 1 << PARTS_LOG2), 32767, np.int16)  # where counts are missing, the other set's count
        column = table.column("parts").combine_chunks()
        given = np.flatnonzero(~np.asarray(column.is_null()))
        parts[given] = column.drop_null().flatten().to_numpy().reshape(-1, 1 << PARTS_LOG2)
        block = table.column("block").to_numpy()
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        found = []
        for k, i in enumerate(left.tolist()):
            to = right[k + 1 :] if lo == hi else right
            to = to[(label[to] != label[i]) & (100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i]))]
            most = np.minimum(parts[to], parts[i]).sum(axis=1, dtype=np.int64)
            to = to[100 * most >= percent * (n[to] + n[i] - most)]
            found.append(np.stack([np.full(len(to), i), to]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        columns = {name: table.column(name).to_numpy() for name in ("k1", "k2", "rep")}
        return pa.table({"a1": columns["k1"][a], "a2": columns["k2"][a], "b1": columns["k1"][b], "b2": columns["k2"][b], "a": columns["rep"][a], "b": columns["rep"][b]})

    return pairs.groupBy("token", "lo", "hi").applyInArrow(compared, "a1 long, a2 long, b1 long, b2 long, a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row a row of docs: doc_id, n_shingles, component_id.

    Words are the runs of characters other than space, tab, line feed, vertical tab, form feed
    and carriage return, A-Z lower-cased; a document's set holds its distinct n-grams of size
    words, or its whole sequence where it has fewer. Two documents are linked when 100 * shared
    >= percent * all n-grams. component_id: the smallest doc_id reachable by links, itself
    included. Null, empty and blank texts have 0 shingles and no links. A row without doc_id
    has no links and no component. Rows of one doc_id are one node, each with its own count.
    An empty table gives no rows; other columns are not read.
    """
    if not (1 <= size < len(_FACTORS) and 1 <= percent <= 100):
        raise ValueError("size has to be from 1 to 63, percent from 1 to 100")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    summary = stored(_summary(docs, size))
    levels = _rarity(summary)
    listed = summary.where("counter is null").select("doc_id", "n", "k1", "k2")
    named = docs.where("doc_id is not null")
    sets = summary.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("parts").alias("parts"))
    sets = stored(sets)
    reps = sets.select("k1", "k2", "rep")

    # A token's counts come from sums within tasks; what is joined to them by token can be split.
    prefixes = _postings(named, size, percent, levels)
    shared = prefixes.groupBy("token").agg(F.min("k1").alias("least"), F.max("k1").alias("most"), F.count(F.lit(1)).alias("size"))
    shared = stored(shared.where("least <> most").select("token", "size"))
    postings = stored(prefixes.join(shared, "token").join(sets.drop("parts"), "k1").select("token", "size", "n", "k1", "k2", "rep").distinct())

    def possible(pairs: DataFrame) -> DataFrame:
        """pairs (a1, a2, b1, b2) that the bound on the overlap lets pass, with doc_ids a and b."""
        for x in "ab":
            pairs = pairs.join(sets.toDF(f"{x}1", f"{x}2", x, f"{x}_n", f"{x}_parts"), [f"{x}1", f"{x}2"])
        most = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
        fits = F.coalesce(100 * most >= percent * (F.col("a_n") + F.col("b_n") - most), F.lit(True))
        return pairs.where(fits).select("a1", "a2", "b1", "b2", "a", "b")

    weights = postings.groupBy("k1", "k2").agg(F.sum("size").alias("weight"))
    key = F.struct("n", "k1", "k2")
    ends = postings.join(weights, ["k1", "k2"]).groupBy("token").agg(F.max(F.struct("weight", key.alias("key"))).alias("centre"), F.max(key).alias("last"))
    ends = ends.select("token", F.explode(F.array_distinct(F.array("centre.key", "last"))).alias("end"))
    pairs = postings.join(ends, "token").where(((F.col("end.k1") != F.col("k1")) | (F.col("end.k2") != F.col("k2"))) & _close(F.col("end.n"), F.col("n"), percent))
    stars = stored(possible(pairs.select(F.col("end.k1").alias("a1"), F.col("end.k2").alias("a2"), F.col("k1").alias("b1"), F.col("k2").alias("b2")).distinct()))
    links = _verified(stars, named, size, percent, levels)
    found = components(links)

    members = postings.drop("size").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")
    labels = members.groupBy("token", "label").count()
    labels = labels.groupBy("token").agg(F.sum("count").alias("size"), F.max(F.struct(F.col("count").alias("most"), F.col("label").alias("top"))).alias("top")).select("token", "size", "top.*")
    members = stored(members.join(labels.where("most < size"), "token"))
    few = members.where(F.col("size") <= FEW)
    side = {x: few.select("token", F.col("n").alias(f"{x}n"), F.col("k1").alias(f"{x}1"), F.col("k2").alias(f"{x}2"), F.col("label").alias(f"{x}_label")) for x in "ab"}
    rest = side["a"].join(side["b"], "token").where((F.col("a_label") < F.col("b_label")) & _close(F.col("an"), F.col("bn"), percent))
    rest = possible(rest.select("a1", "a2", "b1", "b2").distinct())
    many = members.where(F.col("size") > FEW).withColumn("others", F.col("size") - F.col("most"))
    rest = rest.unionByName(_blocks(many.join(sets.select("k1", "k2", "parts"), ["k1", "k2"]), percent)).distinct()
    done = stars.select("a1", "a2", "b1", "b2").unionByName(stars.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2")))
    rest = stored(rest.join(done, ["a1", "a2", "b1", "b2"], "left_anti"))
    if rest.head(1) and (more := _verified(rest, named, size, percent, levels)).head(1):
        found = components(links.unionByName(more))

    discard(shared, postings, stars, members, rest)

    # Rows of one doc_id with different texts are one node.
    same = listed.where("n > 0 and doc_id is not null").join(reps, ["k1", "k2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    several = same.groupBy("a").agg(F.min("b").alias("least"), F.max("b").alias("most")).where("least < most").select("a")
    if several.head(1):
        tied = same.join(several, "a")
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(tied))
    out = listed.join(reps, ["k1", "k2"], "left").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("component", "rep"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(linked, "doc_id").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose doc_id is its component's smallest, with their columns; rows without doc_id stay."""
    gone = stored(near_duplicates(docs, size, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct())
    # A list of ids of a checked size goes to all executors, so that no text is shuffled; a longer one is joined by a shuffle.
    gone = F.broadcast(gone) if gone.count() <= LISTED else gone
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
