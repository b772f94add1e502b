"""Queries of the dataset manifest, lexical search and substring deduplication, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.llm import merkle, search, substring_dedup
from toitscope.sources.tables import parquet_table

REGISTRY = {}
ORACLE = {}


def registered(query):
    REGISTRY[query.__name__] = query
    return query


@registered
def op11_suffix_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of 13 words that also start in a document of lesser id."""
    found = substring_dedup.without_repeats(parquet_table(spark, folder, "documents"))
    # Of an even number of edges, each minus what stands before: ends count, starts are taken off.
    removed = F.aggregate(F.coalesce("spans", F.array().cast("array<int>")), F.lit(0).cast("bigint"), lambda n, edge: edge - n)
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@registered
def op12_block_max_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    index = search.build_index(parquet_table(spark, folder, "documents"))
    return search.search(index, parquet_table(spark, folder, "benchmark"))


@registered
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a leaf, with its proof, checked against the root as it is met later."""
    return merkle.verified(parquet_table(spark, folder, "documents"))


_LEAF = "sha256(concat({}))".format(
    ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
)

#: The remainder of a CRC is computed byte by byte; all levels of a tree and all steps of a proof by recursion.
ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::BIGINT, range(8)),
           lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS crcs
), marked AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT)),
                lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])) % 2 = 1
           THEN replace(text, chr(10), '') ELSE text END AS cut
  FROM documents, crc_table
), leaves AS (
  SELECT row_number() OVER () AS row, doc_id, source, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="cut")} AS altered FROM marked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM leaves
), nodes AS (
  SELECT 0 AS level, source, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT level + 1, source, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY level, source, place // 3
), subroots AS (
  SELECT source, level AS height, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, place, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM upper WHERE n > 1 GROUP BY level, place // 3
), root AS (
  SELECT digest, level AS height FROM upper WHERE n = 1
), steps AS (
  SELECT p.row, n.level,
         coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < p.place // (3 ** n.level)::BIGINT), '') AS before,
         coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > p.place // (3 ** n.level)::BIGINT), '') AS after
  FROM placed p JOIN nodes n ON n.source IS NOT DISTINCT FROM p.source AND n.n > 1
   AND n.place // 3 = p.place // (3 ** (n.level + 1))::BIGINT
  GROUP BY p.row, n.level
  UNION ALL
  SELECT p.row, s.height + u.level,
         coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place < s.place // (3 ** u.level)::BIGINT), ''),
         coalesce(string_agg(u.digest, '' ORDER BY u.place) FILTER (u.place > s.place // (3 ** u.level)::BIGINT), '')
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
  JOIN upper u ON u.n > 1 AND u.place // 3 = s.place // (3 ** (u.level + 1))::BIGINT
  GROUP BY p.row, s.height, u.level
), folds AS (
  SELECT row, 0 AS level, altered AS digest FROM placed
  UNION ALL
  SELECT f.row, f.level + 1, sha256(s.before || f.digest || s.after) FROM folds f JOIN steps s ON s.row = f.row AND s.level = f.level
), proofs AS (
  SELECT row, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY row
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN root r
LEFT JOIN proofs USING (row)
JOIN folds f ON f.row = p.row AND f.level = s.height + r.height
"""

_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLE["op12_block_max_search"] = f"""
WITH read AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents
), sized AS (
  SELECT row, doc_id, len(terms) AS n, terms FROM read WHERE len(terms) > 0
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sized
), postings AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM sized) GROUP BY row, term
), asked AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) CROSS JOIN whole
), lengths AS (
  SELECT row, doc_id, 50 + (50 * n * docs) // words AS m FROM sized CROSS JOIN whole
), scores AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row) GROUP BY item_id, row, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
