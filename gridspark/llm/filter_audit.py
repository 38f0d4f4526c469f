"""How filters interact: what each removes first, again or alone, in every order of applying them.

Each part keeps, by id range, a sorted list of the ids that fail each filter. Whatever order filters
come in, what the first i of them remove is the union of their lists, and what one of them removes
is a difference of two unions; so 32 sizes of unions a part (of all documents, of good and of toxic
ones) say all. Sizes of ranges add up, as a document lies in one range.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.exact_dedup import SALTS

LETTERS = "ABCDE"
ALL = (1 << len(LETTERS)) - 1
_UNIONS = 1 << len(LETTERS)
#: Documents of a part that one set of lists covers at most.
RANGE_DOCS = 1 << 16


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails: few words, repetition, capitals, symbols."""
    white = " \t\n\x0b\f\r"
    inner = F.btrim(text, F.lit(white))  # so that no word is empty, but for a text without words
    words, blank = F.split(inner, f"[{white}]+"), inner == ""
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [blank | (n < 200), ~blank & (100 * distinct < 50 * n), 100 * capitals > 2 * F.length(text), text.rlike("[#$%&*|]")]
    # Sums of bits, not conditions, so that a text is split once.
    return sum((F.shiftleft(fail.cast("int"), i) for i, fail in enumerate(fails)), F.lit(0))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, doc_id, fails (bits of A to E), good and toxic of each row; texts are not moved, their SHA-256 stands for them.

    E: a smaller doc_id has the same text. The smallest doc_id of a text is found by digest and
    salt (a hash of doc_id), then by digest; rows meet it by digest and salt, so a text that is
    a third of all rows is dealt to 64 groups. A doc_id with several labels is good or toxic if
    one of them says so.
    """
    doc_id, text = docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"), failures(text).alias("fails"), F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    known = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(F.max(labels["quality"] == 1).alias("good"), F.max(labels["toxic"] == 1).alias("toxic"))
    merged = rows.groupBy("digest", "salt").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    salts = F.sort_array(F.collect_list("salt"))  # of a text, so SALTS at most
    first = merged.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n"), salts.alias("salts")).where("n > 1")
    first = first.select("digest", "first", F.explode("salts").alias("salt"))
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = rows.join(known, "doc_id", "left").join(first, ["digest", "salt"], "left")
    is_true = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return out.select("part", "doc_id", (F.col("fails") + F.when(again, F.lit(16)).otherwise(F.lit(0))).cast("int").alias("fails"), is_true("good"), is_true("toxic"))


POSTINGS = "part string, first_id long, last_id long, n long, lists array<array<int>>"


def postings(rows: DataFrame, range_docs: int = RANGE_DOCS) -> DataFrame:
    """Lists of failing documents: a row a part and id range of a task: first_id, last_id, n, and lists by filter, then of good and of toxic documents.

    A list holds places in the range's rows by doc_id, ascending, so rows that repeat a doc_id, or
    have none, count one by one. Rows stay where they are: a task sorts its own (which may spill)
    and cuts them at parts and after range_docs rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(part: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            ids, fails = rows.column("doc_id"), rows.column("fails").to_numpy()
            marks = [*(fails & (1 << f) for f in range(len(LETTERS))), rows.column("good").to_numpy(), rows.column("toxic").to_numpy()]
            lists = [np.flatnonzero(x).astype(np.int32) for x in marks]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((part, pa.string()), (ids[0].as_py(), pa.int64()), (ids[-1].as_py(), pa.int64()), (len(rows), pa.int64()), (lists, pa.list_(pa.list_(pa.int32()))))], ["part", "first_id", "last_id", "n", "lists"])

        part, held, n = None, [], 0
        for batch in batches:
            runs = batch.column("part").dictionary_encode()  # parts come sorted: each is one run
            ends = np.cumsum(np.bincount(runs.indices.to_numpy(), minlength=len(runs.dictionary)))
            for name, a, b in zip(runs.dictionary.to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
                while a < b:
                    if held and (name != part or n == range_docs):
                        yield row(part, held)
                        held, n = [], 0
                    taken = min(b - a, range_docs - n)
                    held.append(batch.slice(a, taken))
                    part, n, a = name, n + taken, a + taken
        if held:
            yield row(part, held)

    return rows.sortWithinPartitions("part", "doc_id").mapInArrow(run, POSTINGS)


def merged_size(lists: list[np.ndarray]) -> int:
    """Ids of the union of sorted lists, merged in one go: the stable sort finds the k ascending runs and gallops through them."""
    lists = [x for x in lists if len(x)]
    if len(lists) < 2:
        return len(lists[0]) if lists else 0
    merged = np.sort(np.concatenate(lists), kind="stable")
    return 1 + int(np.count_nonzero(merged[1:] != merged[:-1]))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ids of both lists: the shorter one's are looked up in the longer one, each from where the last was found."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    return a[(at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a)] if len(b) else a[:0]


def union_sizes(lists: list[np.ndarray]) -> list[int]:
    """Sizes of the unions of all subsets of the filters' lists, by the subset's bits: of all documents, then good ones, then toxic ones."""
    failing, out = lists[: len(LETTERS)], []
    for chosen in (failing, *([common(x, only) for x in failing] for only in lists[len(LETTERS) :])):
        out += [merged_size([x for f, x in enumerate(chosen) if s >> f & 1]) for s in range(_UNIONS)]
    return out


def sizes(lists: DataFrame) -> DataFrame:
    """part, n, and sizes: the unions' sizes, summed over all ranges of a part. A task sends one row a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(part: str, n: int, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.string()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.int64()))], ["part", "n", "sizes"])

        part, n, sums = None, 0, 0
        for batch in batches:
            for name, docs, lists in zip(batch.column("part").to_pylist(), batch.column("n").to_pylist(), batch.column("lists")):
                if part is not None and name != part:
                    yield row(part, n, sums)
                    n, sums = 0, 0
                part, n = name, n + docs
                sums = sums + np.array(union_sizes([np.array(x, np.int32) for x in lists.as_py()]), np.int64)
        if part is not None:
            yield row(part, n, sums)

    found = lists.select("part", "n", "lists").mapInArrow(run, "part string, n long, sizes array<long>")
    places = range(3 * _UNIONS)
    summed = found.groupBy("part").agg(F.sum("n").alias("n"), *(F.expr(f"sum(sizes[{i}]) AS s{i}") for i in places))
    return summed.select("part", "n", F.expr(f"array({', '.join(f's{i}' for i in places)}) AS sizes"))


def _steps() -> str:
    """Of every order's steps, as an array: ord, step, filter (0-4), bits of the filters before it, bits with it."""
    out = []
    for order in permutations(range(len(LETTERS))):
        before = 0
        for i, f in enumerate(order):
            out.append(f"named_struct('ord', '{''.join(LETTERS[x] for x in order)}', 'step', {i + 1}, 'f', {f}, 'a', {before}, 'b', {before | 1 << f})")
            before |= 1 << f
    return f"array({', '.join(out)})"


def _shapley(f: int) -> str:
    """What filter f removes, summed over all orders: by the set before it, as many orders as arrange that set and the rest."""
    terms = []
    for s in (s for s in range(_UNIONS) if not s >> f & 1):
        orders = factorial(s.bit_count()) * factorial(len(LETTERS) - 1 - s.bit_count())
        terms.append(f"{orders} * (sizes[{s | 1 << f}] - sizes[{s}])")
    return " + ".join(terms)


def audit(docs: DataFrame, labels: DataFrame, range_docs: int = RANGE_DOCS) -> DataFrame:
    """One row a part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters (a document fails): A under 200 words; B 100 * distinct words < 50 * words; C 100 *
    capitals A-Z > 2 * code points; D one of #$%&*|; E a smaller doc_id has the same text. Null
    text and null source read as empty. Repeated rows count as often as they stand there; equal
    texts of one doc_id don't fail E for each other, and rows without a doc_id neither fail E nor
    make others fail it. An empty table gives no rows. labels that name no document, and columns
    beyond doc_id, text, source, quality and toxic, are not read.
    """
    found = sizes(postings(judged(docs, labels), range_docs))
    shares = F.expr(f"array({', '.join(map(_shapley, range(len(LETTERS))))})")
    rows = found.select("part", "n", "sizes", shares.alias("shares"), F.explode(F.expr(_steps())).alias("at"))
    said = {
        "filter_order": "at.ord",
        "step": "at.step",
        "kept": "n - sizes[at.b]",
        "removed": "sizes[at.b] - sizes[at.a]",
        "redundant": "sizes[shiftleft(1, at.f)] - (sizes[at.b] - sizes[at.a])",
        "unique_fails": f"sizes[{ALL}] - sizes[{ALL} - shiftleft(1, at.f)]",
        "good_lost": f"sizes[{_UNIONS} + at.b] - sizes[{_UNIONS} + at.a]",
        "toxic_lost": f"sizes[{2 * _UNIONS} + at.b] - sizes[{2 * _UNIONS} + at.a]",
        "shapley": "shares[at.f]",
    }
    return rows.select("part", *(F.expr(e).alias(name) for name, e in said.items()))


ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
        len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
        regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)] AS fails
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
g AS MATERIALIZED (SELECT part, fails, len(list_filter(fails, lambda x: x)) AS n_fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
o AS (SELECT '' AS o UNION ALL SELECT o || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)),
s AS (SELECT o AS filter_order, CAST(i AS INTEGER) AS step, ascii(o[i]) - 64 AS f, [ascii(o[j]) - 64 for j in range(1, i)] AS earlier FROM o, range(1, 6) r(i) WHERE length(o) = 5),
j AS (SELECT part, filter_order, step, f, n, good, toxic, n_fails, fails[f] AS fails, len(list_filter(earlier, lambda e: g.fails[e])) > 0 AS gone FROM g, s),
c AS (SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
      CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
      CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
      FROM j GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM c
"""
