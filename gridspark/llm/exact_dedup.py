"""Exact duplicates with built-in functions only, safe where one text fills much of a table.

Three stages, the same for every text and every table. Each compares whole texts, as they are
among the grouping keys: a task combines its own rows by text and salt before anything is
shuffled; the salted groups of a text are merged; the winners of its salts are combined, at most
SALTS rows however many copies there are. The salt is a hash of the row's doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Groups that the rows of a text are dealt to; bits of a long, so 64 at most.
SALTS = 64


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; lower() does the same, faster, where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _salted(docs: DataFrame, salts: int, *more: Column) -> DataFrame:
    """doc_id, norm (the text that is compared), text_sha256, salt, and more, of each row."""
    if not 1 <= salts <= 64:
        raise ValueError("salts has to be from 1 to 64")
    doc_id, text = docs["doc_id"].cast("long"), F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), ascii_lower(text).alias("norm"), F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int").alias("salt"), *more)
    # Said not to be null, or a join's filter would work the digest out once more.
    return rows.withColumn("text_sha256", F.coalesce(F.sha2("norm", 256), F.lit("")))


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row a row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the largest doc_id of equal texts
    stays. Null counts as the empty text. Of rows with the same text and doc_id all are shown,
    and all count; a null doc_id stays only where every doc_id of its text is null. Other
    columns are not read, whatever their names. An empty table gives no rows. Two different
    texts with one SHA-256 (none are known) would end the job with an error.

    Texts are shuffled for the groups alone. The rows find their text's winner by its digest,
    which stands for one text as has been checked, and their salt, for which the winner has a
    row if the text has rows of that salt. Rows that repeat text and doc_id have one salt;
    adaptive execution splits such a partition.
    """
    rows = _salted(docs, salts)
    merged = rows.groupBy("text_sha256", "norm", "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    # Dealt by digest, so that the texts of a digest meet without another shuffle.
    winners = merged.repartition("text_sha256").groupBy("text_sha256", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("group_size"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("has"))
    winners = winners.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.max("has").alias("has"))
    size = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts with one SHA-256")))
    salt = F.explode(F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.expr("has").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0))
    winners = winners.select("text_sha256", "keep_id", size.alias("group_size"), salt.alias("salt"))
    out = rows.select("doc_id", "text_sha256", "salt").join(winners, ["text_sha256", "salt"])
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of each text, with all its columns: that with the largest doc_id.

    A null doc_id is the smallest. Of rows with the same text and doc_id one stays, by a hash of
    all their columns. The rows go through the stages
    themselves, so nothing is joined and no list of documents is made.
    """
    plain = [docs[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rows = _salted(docs, salts, F.struct(docs["doc_id"].cast("long"), F.xxhash64(*plain)).alias("place"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    for keys in (("text_sha256", "norm", "salt"), ("text_sha256", "norm")):
        rows = rows.groupBy(*keys).agg(F.max_by("row", "place").alias("row"), F.max("place").alias("place"))
    return rows.select("row.*")


ORACLE = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, max(doc_id) OVER w IS NULL) AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
