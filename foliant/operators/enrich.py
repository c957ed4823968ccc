"""Links between pages, exact duplicates, continuity, key terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import counts
from ..functions import text as T

OVERLAP = 0.1


def linked(cards: DataFrame) -> DataFrame:
    w = Window.partitionBy("book").orderBy("segment_id")
    here = F.struct("page_num", "segment_id")
    return cards.withColumns({"prev_page": F.lag(here).over(w), "next_page": F.lead(here).over(w)})


def _hashed(cards: DataFrame) -> DataFrame:
    return cards.where(F.length(T.strip(F.col("segment"))) >= 50).withColumn("hash", T.text_hash(F.col("segment")))


def duplicate_groups(cards: DataFrame) -> DataFrame:
    """(hash, n, first_book, first_page): texts that occur more than once; a group of any size is one row."""
    g = _hashed(cards).groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("book", "page_num")).alias("first"))
    return g.where("n > 1").select("hash", "n", F.col("first.book").alias("first_book"), F.col("first.page_num").alias("first_page"))


def duplicates_marked(cards: DataFrame) -> DataFrame:
    """Cards with is_duplicate and the first card of their group; groups are joined as one row each, so no group meets in a window."""
    key = cards.withColumn("hash", F.when(F.length(T.strip(F.col("segment"))) >= 50, T.text_hash(F.col("segment"))))
    j = key.join(duplicate_groups(cards).drop("n"), "hash", "left")
    dup = F.col("first_book").isNotNull() & ~((F.col("first_book") == F.col("book")) & (F.col("first_page") == F.col("page_num")))
    return j.withColumns({"is_duplicate": dup, "duplicate_book": F.when(dup, F.col("first_book")), "duplicate_page": F.when(dup, F.col("first_page"))}).drop("first_book", "first_page", "hash")


def continuity(cards: DataFrame) -> DataFrame:
    """(book, page_num, overlap, gap) of every page but the first and duplicates: how much of the page before it takes up."""
    w = Window.partitionBy("book").orderBy("page_num")
    t = duplicates_marked(cards).withColumn("tokens", F.array_distinct(T.tokens(F.col("segment"))))
    t = t.withColumn("before", F.lag("tokens").over(w)).where(F.col("before").isNotNull() & ~F.col("is_duplicate") & (F.size("tokens") > 0) & (F.size("before") > 0))
    overlap = T.jaccard(F.col("before"), F.col("tokens"))
    return t.select("book", "page_num", F.round(overlap, 9).alias("overlap"), (overlap < OVERLAP).alias("gap"))


def continuity_audit(cards: DataFrame) -> DataFrame:
    pages = cards.groupBy("book").agg(F.count("*").alias("pages"))
    c = continuity(cards).groupBy("book").agg(F.sum(F.col("gap").cast("int")).alias("gaps"), F.round(F.avg("overlap"), 3).alias("avg_overlap"))
    return pages.join(c, "book", "left").select("book", "pages", F.coalesce("gaps", F.lit(0)).alias("gaps"), F.round(F.coalesce("gaps", F.lit(0)) / F.greatest(F.col("pages") - 1, F.lit(1)), 6).alias("gap_ratio"), "avg_overlap")


def key_terms(cards: DataFrame, k: int = 10) -> DataFrame:
    """(doc_id, rank, term, n): the k most frequent long words, then those that occur more than once."""
    long = F.filter(T.tokens(F.col("segment")), lambda w: F.length(w) > 3)
    t = cards.select("doc_id", F.posexplode(counts.frequent(long, F.lit(k))).alias("i", "t"))
    return t.select("doc_id", (F.col("i") + 1).alias("rank"), "t.term", "t.n")


def audit(cards: DataFrame) -> DataFrame:
    m = duplicates_marked(cards)
    used = ~F.col("is_duplicate") & (F.length("segment") >= 100)
    return m.groupBy("book").agg(F.count("*").alias("cards"), F.sum(F.col("is_duplicate").cast("int")).alias("duplicates"), F.round(F.avg(F.col("is_duplicate").cast("int")), 6).alias("duplicate_ratio"), F.sum(used.cast("int")).alias("extracted"))
