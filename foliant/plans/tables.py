"""The shipped tables as the engine's shapes: cards, headed cards, chunk metadata, records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import padded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One card a document; a source is a book."""
    page = F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("source").alias("book"), page.alias("page_num"), padded(page, 5).alias("segment_id"), F.col("text").alias("segment"), F.concat("source", F.lit(".pdf")).alias("source_file"))


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with chapter headings on every 7th page and the page after, and section headings on every 3rd."""
    c = cards(spark, sf_dir)
    head = F.when(F.col("page_num") % 7 == 0, F.concat(F.lit("Chapter "), (F.col("page_num") / 7).cast("int").cast("string"), F.lit(": Part on page "), F.col("page_num").cast("string"), F.lit("\n")))
    head = head.when(F.col("page_num") % 7 == 1, F.concat(F.lit("CHAPTER IV - Near "), F.col("page_num").cast("string"), F.lit("\n")))
    head = head.when(F.col("page_num") == 2, F.lit("Table of Contents 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29 30 31 32\n"))
    part = F.when(F.col("page_num") % 3 == 0, F.concat(F.lit("1."), F.col("page_num").cast("string"), F.lit(" Section at "), F.col("page_num").cast("string"), F.lit("\n")))
    return c.withColumn("segment", F.concat(F.coalesce(head, F.lit("")), F.coalesce(part, F.lit("")), "segment"))


# The same, for the SQL side.
CARDS = """cards AS (
  SELECT doc_id, source AS book, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS page_num,
         CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) > 99999 THEN row_number() OVER (PARTITION BY source ORDER BY doc_id)::VARCHAR
         ELSE lpad(row_number() OVER (PARTITION BY source ORDER BY doc_id)::VARCHAR, 5, '0') END AS segment_id, text AS segment, source || '.pdf' AS source_file
  FROM documents)"""
HEADED = CARDS + """, headed AS (
  SELECT * EXCLUDE (segment), CASE WHEN page_num % 7 = 0 THEN 'Chapter ' || (page_num // 7) || ': Part on page ' || page_num || chr(10)
    WHEN page_num % 7 = 1 THEN 'CHAPTER IV - Near ' || page_num || chr(10)
    WHEN page_num = 2 THEN 'Table of Contents 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29 30 31 32' || chr(10) ELSE '' END
    || CASE WHEN page_num % 3 = 0 THEN '1.' || page_num || ' Section at ' || page_num || chr(10) ELSE '' END || segment AS segment
  FROM cards)"""
