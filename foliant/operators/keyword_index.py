"""A stored keyword index: written once, then read by the terms of a query.

``postings`` are sorted by term over ranges of it, so that a query's terms reach
the scan as pushed filters and skip all other row groups; ``terms`` holds each
term's weight, ``totals`` one row for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import fresh
from .search import B, EPSILON, K1

TABLES = ("postings", "terms", "totals")
_BUILT: dict[tuple, str] = {}


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> str:
    """Writes the index of ``docs`` under ``path``; null texts have no terms but count as documents."""
    spark = docs.sparkSession
    words = docs.select(F.col(id_col).alias("id"), F.coalesce(T.keyword_tokens(F.col(text)), F.array().cast("array<string>")).alias("w"))
    tf = words.select("id", F.size("w").alias("size"), F.explode("w").alias("term")).groupBy("term", "id", "size").agg(F.count("*").alias("tf"))
    tf.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
    words.agg(F.count("*").alias("docs"), F.avg(F.size("w")).alias("mean_size")).write.mode("overwrite").parquet(f"{path}/totals")
    df = spark.read.parquet(f"{path}/postings").groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(spark.read.parquet(f"{path}/totals")))  # one row
    idf = df.select("term", "df", F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    idf.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/terms")
    spark.read.parquet(f"{path}/terms").agg((EPSILON * F.avg("idf")).alias("floor")).write.mode("overwrite").parquet(f"{path}/floor")
    return path


def kept(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> str:
    """The index of a table's files, built at the first call in this application; changed files are another index."""
    spark = docs.sparkSession
    files = sorted(docs.inputFiles())
    file = spark._jvm.org.apache.hadoop.fs.Path
    state = []
    for f in files:
        status = file(f).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file(f))
        state.append((f, status.getLen(), status.getModificationTime()))
    key = (spark.sparkContext.applicationId, id_col, text, *state)
    if key not in _BUILT:
        _BUILT[key] = build(docs, fresh(spark, "keyword-index"), id_col, text)
    return _BUILT[key]


def search(spark: SparkSession, path: str, words: list[str], k: int) -> DataFrame:
    """(id, score > 0) of the k best documents for the query's words (repeats count)."""
    asked = {w: words.count(w) for w in words}
    times = F.coalesce(*[F.when(F.col("term") == w, n) for w, n in asked.items()], F.lit(0))
    some = F.col("term").isin(list(asked))
    totals, floor = (spark.read.parquet(f"{path}/{t}") for t in ("totals", "floor"))
    weights = spark.read.parquet(f"{path}/terms").where(some).crossJoin(F.broadcast(floor))  # one row
    weights = weights.select("term", (times * F.when(F.col("idf") < 0, F.col("floor")).otherwise(F.col("idf"))).alias("weight"))
    hit = spark.read.parquet(f"{path}/postings").where(some).join(F.broadcast(weights), "term")  # a row for each word of the query
    hit = hit.crossJoin(F.broadcast(totals))
    part = F.col("weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean_size")))
    return hit.groupBy("id").agg(F.round(F.sum(part), 6).alias("score")).where("score > 0").orderBy(F.desc("score"), "id").limit(k)
