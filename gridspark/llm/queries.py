"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import bpe, centroids, embedding_dedup, exact_dedup, filter_audit, html_text, language_id, license_scan, ngram_jaccard, packing, secret_scan, token_blocks, word_bpe
from gridspark.llm.common import configure, table

Query = Callable[[SparkSession, str], DataFrame]


def query(names: str, operator: Callable[..., DataFrame], **parameters) -> Query:
    """The operator over whole tables, in a session with the settings of a large job."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return operator(*(table(spark, sf_dir, name) for name in names.split()), **parameters)

    return run


QUERIES: dict[str, Query] = {
    "op1_token_blocks": query("documents", token_blocks.token_block_report, added=True),
    "op2_license_scan": query("documents", license_scan.scan),
    "op3_ngram_jaccard": query("documents", ngram_jaccard.near_duplicates, size=4, percent=85),
    "op4_embedding_dedup": query("embeddings", embedding_dedup.near_duplicate_vectors),
    "op5_byte_bpe": query("documents", bpe.encode_decode),
    "op6_exact_dedup": query("documents", exact_dedup.exact_duplicates),
    "op7_html_text": query("pages", html_text.extract),
    "op8_packing": query("documents", packing.pack, added=True),
    "op9_language_id": query("documents", language_id.identify),
    "op10_secret_scan": query("documents", secret_scan.find_secrets),
    "op11_centroids": query("embeddings", centroids.cluster_vectors),
    "op12_word_bpe": query("documents", word_bpe.encode_decode_words),
    "op13_filter_audit": query("documents labels", filter_audit.audit),
}

#: Every pair of sets that share an n-gram, and recursion to the smallest doc_id.
NGRAM_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
       ELSE list_distinct([array_to_string(w[i : i + 3], ' ') for i in range(1, len(w) - 2)]) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n, s FROM s),
t AS (SELECT doc_id, n, unnest(s) AS t FROM n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.t = b.t AND a.doc_id < b.doc_id
      WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
g AS (SELECT vec_id, x, sqrt(list_sum([y * y for y in x])) AS norm FROM v
      WHERE x IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
      WHERE list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.95),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT vec_id AS a, vec_id AS c FROM v UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT v.vec_id, (SELECT count(*) FROM e WHERE e.a = v.vec_id) AS n_links, min(r.c) AS component_id, min(r.c) = v.vec_id AS kept
FROM v JOIN r ON r.a = v.vec_id GROUP BY v.vec_id
"""

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard": NGRAM_JACCARD,
    "op4_embedding_dedup": EMBEDDING_DEDUP,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op11_centroids": centroids.oracle(),
    "op13_filter_audit": filter_audit.ORACLE,
}
