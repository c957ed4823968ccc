"""The queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, knn, near_dup, packing, perplexity, secrets, sharding, substrings, suffixes, warc


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_simhash_near_dup(spark, sf_dir):
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op1_histogram_sort(spark, sf_dir):
    found = sharding.sharded(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_perplexity_quality(spark, sf_dir):
    found = perplexity.judged(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl")


def op3_secret_forest(spark, sf_dir):
    """Per document: candidates, confirmed secrets, their spans, and the digest of the masked text."""
    found = secrets.scanned(_table(spark, sf_dir, "documents"))
    spans = F.transform("findings", lambda f: F.concat_ws("-", f["start"], f["end"]))
    return found.select(F.col("id").alias("doc_id"), "n_candidates", F.size("findings").cast("long").alias("n_secrets"), F.concat_ws(",", spans).alias("spans"), F.sha2(F.coalesce("masked", F.lit("")), 256).alias("masked_sha256"))


def _tokenizer(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_tokenization_automaton(spark, sf_dir):
    return bpe.digests(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op5_voronoi_knn(spark, sf_dir):
    return knn.top_k(_table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op7_legacy_archive_converter(spark, sf_dir):
    return warc.converted(_table(spark, sf_dir, "pages")).drop("payload")


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to FROM f
"""


def op6_substring_doubling(spark, sf_dir):
    found = substrings.deduplicated(_table(spark, sf_dir, "documents"), digest=True)
    return found.toDF("doc_id", "n_words", "n_removed", "kept_sha256")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), h AS (
  SELECT doc_id, list_transform(range(1, greatest(len(ws) - 48, 1)), lambda i: md5(array_to_string(ws[i:i + 49], ' '))) AS hs FROM d
), g AS (
  SELECT doc_id, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS i FROM h
), m AS (
  SELECT doc_id, i, CASE WHEN min(doc_id) OVER (PARTITION BY h) < doc_id THEN 1 ELSE 0 END AS bad FROM g
), w AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d
), f AS (
  SELECT doc_id, i, word,
         coalesce(max(bad) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM w LEFT JOIN m USING (doc_id, i)
)
SELECT d.doc_id, count(word)::BIGINT AS n_words, coalesce(sum(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS kept_sha256
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
"""


def op8_suffix_array_dedup(spark, sf_dir):
    found = suffixes.deduplicated(_table(spark, sf_dir, "documents"), digest=True)
    return found.toDF("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents
), h AS (
  SELECT doc_id, list_transform(range(0, greatest(length(hx) // 2 - 399, 0)), lambda i: md5(substring(hx, 2 * i + 1, 800))) AS hs FROM d
), g AS (
  SELECT doc_id, unnest(hs) AS h, unnest(range(0, len(hs))) AS i FROM h
), m AS (
  SELECT doc_id, i, CASE WHEN count(*) OVER (PARTITION BY h) > 1 THEN 1 ELSE 0 END AS bad FROM g
), b AS (
  SELECT doc_id, unnest(list_transform(range(0, length(hx) // 2), lambda i: substring(hx, 2 * i + 1, 2))) AS x, unnest(range(0, length(hx) // 2)) AS i FROM d
), f AS (
  SELECT doc_id, i, x, coalesce(max(bad) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 399 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM b LEFT JOIN m USING (doc_id, i)
), e AS (
  SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 THEN 1 ELSE 0 END AS head FROM f
)
SELECT d.doc_id, count(x)::BIGINT AS n_bytes, coalesce(sum(gone), 0)::BIGINT AS n_removed, coalesce(sum(head), 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(string_agg(x, '' ORDER BY i) FILTER (WHERE gone = 0), ''))) AS kept_sha256
FROM d LEFT JOIN e USING (doc_id) GROUP BY d.doc_id
"""


def op9_mixture_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op1_histogram_sort, op2_perplexity_quality, op3_secret_forest, op4_tokenization_automaton, op5_voronoi_knn, op6_substring_doubling, op7_legacy_archive_converter, op8_suffix_array_dedup, op9_mixture_packing, op10_simhash_near_dup)}

ORACLES: dict[str, str] = {"op5_voronoi_knn": OP5_SQL, "op7_legacy_archive_converter": OP7_SQL, "op6_substring_doubling": OP6_SQL, "op8_suffix_array_dedup": OP8_SQL}
