"""From raw documents to packed training sequences, in five written stages.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept, and returns the columns of ``documents`` (the last: packed pieces).
Columns beside those are dropped by the first stage; rows keep null texts and
null ids, which the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm import packing, perplexity, secrets, similar, substrings
from foliant.llm.shared import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REST = ("doc_id", "text", "lang", "source", "n_chars")

#: Pieces cannot be expressed in SQL (tokenizer, SimHash, models).
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the perplexity bands reject."""
    kept = perplexity.judged(docs.select(*COLUMNS), carry=REST).where("kept")
    return kept.select(*[F.col(f"k_{c}").alias(c) for c in COLUMNS])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar texts (five-word shingles, 0.8 or more) those with the smallest ids stay.

    SimHash fingerprints and multi-index hashing find the candidates.  A null
    id, and an id that other texts have too, is stood for by a large number from
    the row's text, so such rows stay only where no like text has an id of its
    own; repeated rows become one.
    """
    rows = docs.select(*COLUMNS)
    texts = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"), F.count("*").alias("n"))
    shared = written(texts.where("doc_id is not null and n > 1").select("doc_id", (F.col("low") < F.col("high")).alias("unclear")), "shared")
    stand_in = F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1)).bitwiseOR(F.lit(1 << 61))
    rows = rows.join(shared, "doc_id", "left").withColumn("row", F.when(F.col("unclear"), stand_in).otherwise(F.coalesce("doc_id", stand_in)))
    gone = similar.repeats(rows.select(F.col("row").alias("id"), "text")).toDF("row")
    one = F.row_number().over(Window.partitionBy("row").orderBy("doc_id", "text", "lang", "source"))
    kept = rows.join(gone, "row", "left_anti")
    own = F.col("doc_id").isNotNull() & F.col("unclear").isNull()  # no other row has the id, so these texts need no exchange
    return kept.where(own).select(*COLUMNS).union(kept.where(~own).withColumn("one", one).where("one = 1").select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out 50-word passages that an earlier document has; untouched texts stay as they are."""
    found = substrings.deduplicated(docs.select(*COLUMNS), carry=REST)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("k_text"))
    return found.select(F.col("k_doc_id").alias("doc_id"), text.alias("text"), F.col("k_lang").alias("lang"), F.col("k_source").alias("source"), F.length(text).cast("long").alias("n_chars"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces confirmed secrets in the texts."""
    found = secrets.scanned(docs.select(*COLUMNS), carry=REST)
    return found.select(F.col("k_doc_id").alias("doc_id"), F.col("masked").alias("text"), F.col("k_lang").alias("lang"), F.col("k_source").alias("source"), F.length("masked").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 1024 tokens in the sources' proportions."""
    import public_tokenizers

    found = packing.packed(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", deduplicated),
    ("substring dedup", substring_dedup),
    ("secret scans", secret_scan),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
