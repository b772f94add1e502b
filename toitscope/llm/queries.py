"""One registered query per corpus operator, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    labelled,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    queries_corpus,
    toxicity,
    warc,
)
from toitscope.sources.tables import parquet_table

REGISTRY = dict(queries_corpus.REGISTRY)
ORACLE = dict(queries_corpus.ORACLE)


def registered(query):
    REGISTRY[query.__name__] = query
    return query


@registered
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again; counts and digests of both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(parquet_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text without the passages that stand earlier in the corpus."""
    docs = parquet_table(spark, folder, "documents").select("doc_id", "text", F.col("text").alias("before"))
    cleaned = line_dedup.drop_repeated_lines(docs, whole=True)
    size = lambda name: F.octet_length(F.coalesce(name, F.lit(""))).cast("bigint")
    return cleaned.select("doc_id", "text", (size("before") - size("text")).alias("bytes_removed"))


@registered
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    parts = packing.pieces(parquet_table(spark, folder, "documents"), tokenizer, public_tokenizers.PATTERN, find_added=True)
    return packing.pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@registered
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label whose cosine is 0.98 or more, as counts of links and components."""
    return embedding_dedup.near_vectors(parquet_table(spark, folder, "embeddings"))


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    scored = docs.select("doc_id", labelled.held_out("doc_id").alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@registered
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    docs = parquet_table(spark, folder, "documents")
    forest = quality.fit(docs, parquet_table(spark, folder, "labels"))
    return _scored(docs, quality.score("text", forest), quality.THRESHOLD)


@registered
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives and read back."""
    pages = parquet_table(spark, folder, "pages")
    kind = pages.schema["page_id"].dataType
    records = warc.read_records(warc.write_archives(pages), with_payload=False)
    return records.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@registered
def op7_minhash_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that share 85 % of their three-word shingles, as components."""
    found = near_dedup.near_texts(parquet_table(spark, folder, "documents"), shingle_words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@registered
def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence of every document, its own or of a directory above.

    Documents have no paths, so each gets one from its source and id: directories of 512 documents, in them
    directories of 64, and the first document of a directory is its licence file.
    """
    docs = parquet_table(spark, folder, "documents")
    outer, inner = F.floor(F.col("doc_id") / 512), F.floor(F.col("doc_id") / 64)
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = (
        F.when(F.col("doc_id") % 512 == 0, F.concat_ws("/", "source", outer, F.lit("LICENSE")))
        .when(F.col("doc_id") % 64 == 0, F.concat_ws("/", "source", outer, inner, F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", "source", outer, inner, name))
    )
    placed = docs.select("doc_id", "text", F.when(F.col("source").isNotNull() & F.col("doc_id").isNotNull(), path).alias("path"))
    return licenses.scan(placed)


@registered
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts; the contract asks for the digest of every row, so all are taken in the first scan."""
    found = exact_dedup.copies(parquet_table(spark, folder, "documents"), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@registered
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = parquet_table(spark, folder, "documents")
    model = toxicity.fit(docs, parquet_table(spark, folder, "labels"))
    return _scored(docs, toxicity.score("text", model), toxicity.THRESHOLD)


#: SHA-1 in base 32: every letter stands for five bits, taken from the two or three hexadecimal digits around them.
ORACLE["op6_warc"] = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) || '00' AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes,
         list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           (((instr('0123456789abcdef', substr(hex, (5 * i) // 4 + 1, 1)) - 1) * 256
             + (instr('0123456789abcdef', substr(hex, (5 * i) // 4 + 2, 1)) - 1) * 16
             + (instr('0123456789abcdef', substr(hex, (5 * i) // 4 + 3, 1)) - 1))
            // (2 ** (7 - (5 * i) % 4))::BIGINT) % 32)::BIGINT, 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest
  FROM payloads
), ranked AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM named
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM ranked
"""

_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))
_LOWER = f"translate(%s, '{licenses.UPPER}', '{licenses.LOWER}')"
_TERMS = "trim(regexp_replace(%s, '[^a-z0-9]+', ' ', 'g'))"

ORACLE["op8_license_scan"] = f"""
WITH placed AS (
  SELECT row_number() OVER () AS row, doc_id, {_LOWER % "coalesce(text, '')"} AS lower,
         CASE WHEN source IS NOT NULL AND doc_id IS NOT NULL THEN
           CASE WHEN doc_id % 512 = 0 THEN concat_ws('/', source, doc_id // 512, 'LICENSE')
                WHEN doc_id % 64 = 0 THEN concat_ws('/', source, doc_id // 512, doc_id // 64, 'LICENSE')
                ELSE concat_ws('/', source, doc_id // 512, doc_id // 64, doc_id || '.txt') END END AS path
  FROM documents
), files AS (
  SELECT *, regexp_replace(path, '/?[^/]*$', '') AS directory, coalesce(path LIKE '%/LICENSE', false) AS gives FROM placed
), templates(template, license, text) AS (VALUES {_TEMPLATES}
), template_terms AS (
  SELECT template, license, term, count(*) AS tf
  FROM (SELECT template, license, unnest(string_split({_TERMS % (_LOWER % "text")}, ' ')) AS term FROM templates) GROUP BY ALL
), vocabulary AS (
  SELECT DISTINCT term FROM template_terms
), totals AS (
  SELECT count(*) AS n FROM files
), met AS (
  SELECT term, count(*) AS df FROM (SELECT DISTINCT row, unnest(string_split({_TERMS % "lower"}, ' ')) AS term FROM files) GROUP BY term
), idf AS (
  SELECT v.term, ln((1 + n)::DOUBLE / (1 + coalesce(df, 0))) + 1 AS idf FROM vocabulary v CROSS JOIN totals LEFT JOIN met USING (term)
), template_weights AS (
  SELECT template, license, term, tf * idf AS w FROM template_terms JOIN idf USING (term)
), template_norms AS (
  SELECT template, sqrt(sum(w * w)) AS norm FROM template_weights GROUP BY template
), segments AS (
  SELECT DISTINCT row, {_TERMS % "segment"} AS segment
  FROM (SELECT row, unnest(string_split(lower, chr(10))) AS segment FROM files
        UNION ALL SELECT row, lower FROM files WHERE gives)
), weights AS (
  SELECT segment, term, count(*) * coalesce(any_value(idf), ln(1 + any_value(n)) + 1) AS w
  FROM (SELECT segment, unnest(string_split(segment, ' ')) AS term FROM (SELECT DISTINCT segment FROM segments))
  LEFT JOIN idf USING (term) CROSS JOIN totals GROUP BY segment, term
), norms AS (
  SELECT segment, sqrt(sum(w * w)) AS own_norm FROM weights GROUP BY segment
), cosines AS (
  SELECT segment, license, round(sum(s.w * t.w) / any_value(norm) / any_value(own_norm), 6) AS cosine
  FROM weights s JOIN template_weights t USING (term) JOIN template_norms USING (template) JOIN norms USING (segment)
  GROUP BY segment, template, license
), best AS (
  SELECT row, license, cosine FROM segments JOIN cosines USING (segment) WHERE cosine >= {licenses.LEAST}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY cosine DESC, license) = 1
), own AS (
  SELECT row, doc_id, path, directory, gives, license, cosine FROM files LEFT JOIN best USING (row)
), gifts AS (
  SELECT directory AS ancestor, license AS gift, cosine AS gift_cosine, path AS gift_path FROM own WHERE gives AND license IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, license, path) = 1
), nearest AS (
  SELECT d.directory, g.* FROM (SELECT DISTINCT directory FROM own) d
  JOIN gifts g ON ancestor = '' OR ancestor = d.directory OR starts_with(d.directory, ancestor || '/')
  QUALIFY row_number() OVER (PARTITION BY d.directory ORDER BY length(ancestor) DESC) = 1
)
SELECT doc_id, path, coalesce(license, gift) AS license,
       CASE WHEN license IS NULL THEN gift_cosine ELSE cosine END AS similarity,
       CASE WHEN license IS NOT NULL THEN 'own' WHEN gift IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN license IS NOT NULL THEN path ELSE gift_path END AS license_path
FROM own LEFT JOIN nearest USING (directory)
"""

ORACLE["op9_exact_dedup"] = """
WITH bodies AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM bodies
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""
