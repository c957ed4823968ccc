"""Chunks: pages cut into overlapping runs of sentences within a token limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

SIZE, OVERLAP, LEAST, CONTEXT = 512, 128, 100, 200


def _tail(sentences: Column, limit: int) -> Column:
    """The longest run of last sentences whose tokens stay within the limit."""
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(s, x):
        n = s["n"] + T.token_count(x)
        fits = s["open"] & (n <= limit)
        return F.struct(F.when(fits, F.concat(F.array(x), s["kept"])).otherwise(s["kept"]).alias("kept"), F.when(fits, n).otherwise(s["n"]).alias("n"), fits.alias("open"))

    return F.aggregate(F.reverse(sentences), start, step, lambda s: s["kept"])


def folded(text: Column, size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST) -> Column:
    """The chunks of one text, by a fold over its sentences in the JVM."""
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("cur"), F.lit(0).alias("n"), none.alias("out"))
    emitted = lambda s: F.when(T.token_count(F.array_join(s["cur"], " ")) >= least, F.concat(s["out"], F.array(F.array_join(s["cur"], " ")))).otherwise(s["out"])
    total = lambda a: F.aggregate(a, F.lit(0), lambda t, x: t + T.token_count(x))

    def step(s, x):
        n = T.token_count(x)
        full = (s["n"] + n > size) & (F.size(s["cur"]) > 0)
        seed = _tail(s["cur"], overlap)
        cur = F.when(full, F.concat(seed, F.array(x))).otherwise(F.concat(s["cur"], F.array(x)))
        return F.struct(cur.alias("cur"), F.when(full, total(seed) + n).otherwise(s["n"] + n).alias("n"), F.when(full, emitted(s)).otherwise(s["out"]).alias("out"))

    whole = F.aggregate(T.sentences(text), start, step, lambda s: F.when(F.size(s["cur"]) > 0, emitted(s)).otherwise(s["out"]))
    return F.when(F.length(T.strip(text)) >= 10, whole).otherwise(none)


def context(file: Column, chapter_num: Column, chapter: Column, section_num: Column, section: Column) -> Column:
    """``Source: f | Chapter n: t | Section n: t``, of what there is, within the context limit."""
    part = lambda name, num, title: F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(f"{name} "), F.coalesce(num, F.lit("None")), F.lit(": "), title))
    whole = F.concat_ws(" | ", F.when(F.coalesce(file, F.lit("")) != "", F.concat(F.lit("Source: "), file)), part("Chapter", chapter_num, chapter), part("Section", section_num, section))
    return F.substring(whole, 1, 4 * CONTEXT)


def chunked(cards: DataFrame, key: str = "book") -> DataFrame:
    """One row a chunk: book, page, place in the page, running id in the book, text, tokens; headings are carried if the cards have them.

    A card without text gives its summary, if it has one.
    """
    source = F.coalesce(F.nullif("segment", F.lit("")), F.col("l1_summary")) if "l1_summary" in cards.columns else F.col("segment")
    carried = [c for c in ("source_file", "chapter_num", "chapter_title", "section_num", "section_title", "doc_id") if c in cards.columns]
    rows = cards.select(key, "page_num", *carried, F.posexplode(folded(source)).alias("ord", "text"))
    # ids follow the pages: chunks per page first, so a book's window holds one small row a page
    per = rows.groupBy(key, "page_num").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy("page_num").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(per.withColumn("before", before).drop("n"), [key, "page_num"])
    return placed.withColumns({"chunk_id": T.padded(F.col("before") + F.col("ord"), 8), "tokens": T.token_count(F.col("text"))}).drop("before")


def audit(chunks: DataFrame, key: str = "book") -> DataFrame:
    return chunks.groupBy(key).agg(F.count("*").alias("chunks"), F.round(F.count("*") / F.countDistinct("page_num"), 6).alias("per_page"), F.round(F.avg("tokens"), 1).alias("avg_tokens"), F.min("tokens").alias("min_tokens"), F.max("tokens").alias("max_tokens"))


def histogram(chunks: DataFrame) -> DataFrame:
    t = F.col("tokens")
    bucket = F.when(t < 100, "<100").when(t < 300, "100-299").when(t <= SIZE, f"300-{SIZE}").otherwise(f">{SIZE}")
    return chunks.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
