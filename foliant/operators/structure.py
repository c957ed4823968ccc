"""Chapters, sections and contents pages of ordered cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T

GAP, SHORTEST, LONGEST = 3, 3, 200


def _first_lines(text: Column, n: int) -> Column:
    return F.filter(F.transform(F.slice(F.split(T.strip(text), "\n", -1), 1, n), T.strip), lambda x: x != "")


def heading(text: Column, patterns: list[str], lines: int) -> Column:
    """(num, title) of the first line that is a heading, by the first pattern that fits; else null."""
    hit = lambda x: T.any_of([x.rlike(p) for p in patterns])
    line = F.get(F.filter(_first_lines(text, lines), hit), F.lit(0))
    out = None
    for p in patterns:
        found = F.struct(F.regexp_extract(line, p, 1).alias("num"), T.strip(F.regexp_extract(line, p, 2)).alias("title"))
        out = F.when(line.rlike(p), found) if out is None else out.when(line.rlike(p), found)
    return out


def chapter_matches(cards: DataFrame) -> DataFrame:
    return cards.withColumn("chapter", heading(F.col("segment"), C.CHAPTERS, 5))


def section_matches(cards: DataFrame) -> DataFrame:
    return cards.withColumn("section", heading(F.col("segment"), C.SECTIONS, 10))


def _fits(title: Column) -> Column:
    return F.length(title).between(SHORTEST, LONGEST)


def chapters(cards: DataFrame) -> DataFrame:
    """(book, page_num, num, title): headings in page order, each at least ``GAP`` pages after the last accepted one.

    A fold over a book's few headings: only pages that match are gathered.
    """
    found = chapter_matches(cards).where(F.col("chapter").isNotNull() & _fits(F.col("chapter.title")))
    rows = F.array_sort(F.collect_list(F.struct("page_num", F.col("chapter.num").alias("num"), F.col("chapter.title").alias("title"))))
    kind = "array<struct<page_num:int,num:string,title:string>>"
    start = F.struct(F.lit(-GAP).alias("last"), F.array().cast(kind).alias("out"))
    step = lambda s, r: F.when(r["page_num"] - s["last"] >= GAP, F.struct(r["page_num"].alias("last"), F.concat(s["out"], F.array(r)).alias("out"))).otherwise(s)
    folded = found.groupBy("book").agg(F.aggregate(rows, start, step, lambda s: s["out"]).alias("out"))
    return folded.select("book", F.inline("out"))


def sections(cards: DataFrame) -> DataFrame:
    """(book, page_num, num, title, chapter_num): section headings of fitting length, with the chapter they stand in."""
    joined = _with_chapters(cards)
    s = section_matches(joined).where(F.col("section").isNotNull() & _fits(F.col("section.title")))
    return s.select("book", "page_num", F.col("section.num").alias("num"), F.col("section.title").alias("title"), "chapter_num")


def _with_chapters(cards: DataFrame) -> DataFrame:
    c = chapters(cards).select("book", "page_num", F.col("num").alias("cn"), F.col("title").alias("ct"))
    so_far = Window.partitionBy("book").orderBy("page_num").rowsBetween(Window.unboundedPreceding, 0)
    j = cards.join(c, ["book", "page_num"], "left")
    return j.withColumns({"chapter_num": F.last("cn", True).over(so_far), "chapter_title": F.last("ct", True).over(so_far)}).drop("cn", "ct")


def filled(cards: DataFrame) -> DataFrame:
    """Cards with the chapter and section they stand in; a new chapter does not end a section."""
    so_far = Window.partitionBy("book").orderBy("page_num").rowsBetween(Window.unboundedPreceding, 0)
    s = section_matches(_with_chapters(cards))
    ok = F.when(_fits(F.col("section.title")), F.col("section"))
    return s.withColumns({"section_num": F.last(ok["num"], True).over(so_far), "section_title": F.last(ok["title"], True).over(so_far)}).drop("section")


def contents_pages(cards: DataFrame, first: int = 20, most: int = 10, digits: int = 50) -> DataFrame:
    """(book, start_page, end_page): the first page that speaks of contents, and the pages after it that are full of digits."""
    rank = F.row_number().over(Window.partitionBy("book").orderBy("page_num"))
    low = F.lower("segment")
    c = cards.select("book", "page_num", rank.alias("i"), T.any_of([low.contains(m) for m in C.CONTENTS_MARKS]).alias("mark"), (F.regexp_count("segment", F.lit("[0-9]")) > digits).alias("full"))
    c = c.where(F.col("i") < first + most)
    start = c.where((F.col("i") <= first) & F.col("mark")).groupBy("book").agg(F.min("i").alias("s"))
    after = c.join(start, "book").where((F.col("i") > F.col("s")) & (F.col("i") < F.col("s") + most))
    stop = after.where(~F.col("full")).groupBy("book").agg(F.min("i").alias("e"))
    last = c.groupBy("book").agg(F.max("i").alias("n"))
    span = start.join(stop, "book", "left").join(last, "book").select("book", "s", F.coalesce(F.col("e") - 1, F.least(F.col("s") + most - 1, "n")).alias("e"))
    j = c.join(span, "book")
    return j.groupBy("book").agg(F.min(F.when(F.col("i") == F.col("s"), F.col("page_num"))).alias("start_page"), F.max(F.when(F.col("i") == F.col("e"), F.col("page_num"))).alias("end_page"))


def audit(cards: DataFrame) -> DataFrame:
    f = filled(cards)
    has = F.col("chapter_num").isNotNull() | F.col("section_num").isNotNull()
    n = F.countDistinct("chapter_num", "chapter_title")
    return f.groupBy("book").agg(F.count("*").alias("total_pages"), n.alias("chapters"), F.sum(has.cast("int")).alias("pages_with_structure"), F.round(F.avg(has.cast("int")), 3).alias("coverage"), F.round(F.count("*") / F.nullif(n, F.lit(0)), 6).alias("avg_chapter_length"))
