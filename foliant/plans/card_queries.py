"""Queries over ordered cards: structure, summaries, enrichment; and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import enrich, structure, summaries
from .tables import CARDS, HEADED, cards, headed
from .text_queries import STOP, sql_sentences, sql_strip, sql_tokens

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def sql_heading(patterns, lines, name):
    first = f"list_filter(list_transform(string_split({sql_strip('segment')}, chr(10))[1:{lines}], lambda x: {sql_strip('x')}), lambda x: x <> '')"
    any_ = " OR ".join(f"regexp_matches(x, '{p}')" for p in patterns)
    pick = lambda g: "CASE " + " ".join(f"WHEN regexp_matches(line, '{p}') THEN regexp_extract(line, '{p}', {g})" for p in patterns) + " END"
    return f"""{name}_lines AS (SELECT *, list_filter({first}, lambda x: {any_})[1] AS line FROM headed),
{name} AS (SELECT * EXCLUDE (line), {pick(1)} AS num, {sql_strip(pick(2))} AS title FROM {name}_lines)"""


CM, SM = sql_heading(C.CHAPTERS, 5, "cm"), sql_heading(C.SECTIONS, 10, "sm")
CH = f"""{CM}, ca AS (SELECT book, list_reduce(list_transform(list(page_num ORDER BY page_num), lambda p: [p]), lambda a, x: CASE WHEN x[1] - a[-1] >= 3 THEN a || x ELSE a END, [-3]) AS pages
  FROM cm WHERE num IS NOT NULL AND length(title) BETWEEN 3 AND 200 GROUP BY book),
ch AS (SELECT cm.book, cm.page_num, num, title FROM cm JOIN ca ON cm.book = ca.book AND list_contains(ca.pages, cm.page_num))"""
FILLED = f"""{HEADED}, {CH}, {SM}, j AS (SELECT h.*, ch.num AS cn, ch.title AS ct, CASE WHEN length(sm.title) BETWEEN 3 AND 200 THEN sm.num END AS sn, CASE WHEN length(sm.title) BETWEEN 3 AND 200 THEN sm.title END AS st
  FROM headed h LEFT JOIN ch USING (book, page_num) JOIN sm USING (book, page_num)),
filled AS (SELECT *, last_value(cn IGNORE NULLS) OVER w AS chapter_num, last_value(ct IGNORE NULLS) OVER w AS chapter_title, last_value(sn IGNORE NULLS) OVER w AS section_num, last_value(st IGNORE NULLS) OVER w AS section_title
  FROM j WINDOW w AS (PARTITION BY book ORDER BY page_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(f"WITH {HEADED}, {CM} SELECT book, page_num, num, title FROM cm WHERE num IS NOT NULL")
def chapter_match(spark, sf_dir):
    c = structure.chapter_matches(headed(spark, sf_dir)).where("chapter is not null")
    return c.select("book", "page_num", F.col("chapter.num").alias("num"), F.col("chapter.title").alias("title"))


@query(f"WITH {HEADED}, {CH} SELECT * FROM ch")
def chapter_detect(spark, sf_dir):
    return structure.chapters(headed(spark, sf_dir))


@query(f"WITH {HEADED}, {SM} SELECT book, page_num, num, title FROM sm WHERE num IS NOT NULL")
def section_match(spark, sf_dir):
    c = structure.section_matches(headed(spark, sf_dir)).where("section is not null")
    return c.select("book", "page_num", F.col("section.num").alias("num"), F.col("section.title").alias("title"))


@query(f"WITH {FILLED} SELECT book, page_num, sn AS num, st AS title, chapter_num FROM filled WHERE sn IS NOT NULL")
def section_detect(spark, sf_dir):
    return structure.sections(headed(spark, sf_dir))


@query(f"WITH {FILLED} SELECT book, page_num, chapter_num, chapter_title, section_num, section_title FROM filled")
def structure_ffill(spark, sf_dir):
    return structure.filled(headed(spark, sf_dir)).select("book", "page_num", "chapter_num", "chapter_title", "section_num", "section_title")


@query(f"""WITH {HEADED}, c AS (SELECT book, page_num, row_number() OVER (PARTITION BY book ORDER BY page_num) AS i,
 {' OR '.join(f"contains(lower(segment), '{m}')" for m in C.CONTENTS_MARKS)} AS mark, len(regexp_extract_all(segment, '[0-9]')) > 50 AS digits FROM headed),
s AS (SELECT book, min(i) AS s FROM c WHERE mark AND i <= 20 GROUP BY book),
e AS (SELECT s.book, s.s, (SELECT coalesce(min(c.i) - 1, least(s.s + 9, (SELECT max(d.i) FROM c d WHERE d.book = s.book))) FROM c WHERE c.book = s.book AND c.i > s.s AND c.i < s.s + 10 AND NOT c.digits) AS e FROM s)
SELECT c.book, min(CASE WHEN c.i = e.s THEN page_num END) AS start_page, max(CASE WHEN c.i = e.e THEN page_num END) AS end_page FROM c JOIN e USING (book) GROUP BY c.book""")
def toc_detect(spark, sf_dir):
    return structure.contents_pages(headed(spark, sf_dir))


@query(f"""WITH {FILLED} SELECT book, count(*)::BIGINT AS total_pages, count(DISTINCT chapter_num || '|' || chapter_title)::BIGINT AS chapters,
 sum((chapter_num IS NOT NULL OR section_num IS NOT NULL)::INTEGER)::BIGINT AS pages_with_structure, round(avg((chapter_num IS NOT NULL OR section_num IS NOT NULL)::INTEGER), 3) AS coverage,
 round(count(*) / nullif(count(DISTINCT chapter_num || '|' || chapter_title), 0), 6) AS avg_chapter_length FROM filled GROUP BY book""")
def structure_audit(spark, sf_dir):
    return structure.audit(headed(spark, sf_dir))


def sql_words(c):
    return f"list_filter(regexp_extract_all(lower({c}), '[A-Za-zА-Яа-я0-9]{{3,}}'), lambda w: NOT list_contains({STOP}, w))"


FREQ = f"""wf AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({sql_words('segment')}) AS word FROM cards) GROUP BY ALL)"""
SCORES = f"""{CARDS}, {FREQ}, s0 AS (SELECT doc_id, {sql_sentences("regexp_replace(segment, '\\n{2,}', chr(1), 'g')", keep='length(x) > 20')} AS ss FROM cards),
s AS (SELECT doc_id, len(ss) AS k, unnest(ss) AS sentence, unnest(range(0, len(ss))) AS i FROM s0),
w AS (SELECT doc_id, i, unnest({sql_words('sentence')}) AS word FROM s), tops AS (SELECT doc_id, max(n) AS top FROM wf GROUP BY doc_id),
m AS (SELECT w.doc_id, w.i, sum(wf.n)::DOUBLE / (count(*) * max(top)) AS mean FROM w JOIN wf USING (doc_id, word) JOIN tops USING (doc_id) GROUP BY ALL),
scores AS (SELECT doc_id, i::INTEGER AS i, sentence, round(mean + (k - i)::DOUBLE / k * 0.1::DOUBLE + least(1.0::DOUBLE, 100.0::DOUBLE / (length(sentence) + 1)) * 0.1::DOUBLE
  + CASE WHEN regexp_matches(sentence, '[0-9]') THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN contains(sentence, ':') THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END, 9) AS score FROM s JOIN m USING (doc_id, i))"""


@query(f"WITH {CARDS}, {FREQ} SELECT doc_id, word, n::BIGINT AS n, n / max(n) OVER (PARTITION BY doc_id) AS frequency FROM wf")
def word_freq(spark, sf_dir):
    return summaries.word_frequencies(cards(spark, sf_dir))


@query(f"WITH {SCORES} SELECT * FROM scores")
def sentence_scores(spark, sf_dir):
    return summaries.sentence_scores(cards(spark, sf_dir))


def sql_summaries(level):
    k, n = summaries.LEVELS[level]
    cut = f"regexp_replace(regexp_replace(left(s, {n}), ' [^ ]*$', ''), '[.,;:\\-]+$', '') || '...'"
    return f"""{SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS r FROM scores),
b AS (SELECT doc_id, string_agg(sentence, ' ' ORDER BY i) AS s FROM r WHERE r <= {k} GROUP BY doc_id),
sums AS (SELECT doc_id, coalesce(CASE WHEN length(s) > {n} THEN {cut} ELSE s END, left({sql_strip('segment')}, 300)) AS summary
  FROM cards LEFT JOIN b USING (doc_id) WHERE length({sql_strip('segment')}) >= 50)"""


@query(f"WITH {sql_summaries('l1')} SELECT * FROM sums")
def summary_l1(spark, sf_dir):
    return summaries.summaries(cards(spark, sf_dir), "l1")


@query(f"WITH {sql_summaries('l2')} SELECT * FROM sums")
def summary_l2(spark, sf_dir):
    return summaries.summaries(cards(spark, sf_dir), "l2")


@query(f"""WITH {sql_summaries('l1')} SELECT book, count(*)::BIGINT AS total_pages, count(summary)::BIGINT AS summarized, round(count(summary) / count(*), 6) AS coverage,
 round(avg(length(summary)), 6) AS avg_length, round(avg(length(segment) / nullif(length(summary), 0)), 2) AS avg_ratio FROM cards LEFT JOIN sums USING (doc_id) GROUP BY book""")
def summary_audit(spark, sf_dir):
    return summaries.audit(cards(spark, sf_dir))


@query(f"""WITH {CARDS} SELECT book, page_num, (lag(page_num) OVER w)::VARCHAR AS prev_num, lag(segment_id) OVER w AS prev_id, (lead(page_num) OVER w)::VARCHAR AS next_num, lead(segment_id) OVER w AS next_id
 FROM cards WINDOW w AS (PARTITION BY book ORDER BY segment_id)""")
def nav_links(spark, sf_dir):
    c = enrich.linked(cards(spark, sf_dir))
    return c.select("book", "page_num", *[F.col(f"{a}_page.{f}").cast("string").alias(f"{a}_{n}") for a in ("prev", "next") for f, n in (("page_num", "num"), ("segment_id", "id"))])


HASH = "md5(" + sql_strip("regexp_replace(lower(segment), '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')") + ")"
DUPS = f"""{CARDS}, hs AS (SELECT *, CASE WHEN length({sql_strip('segment')}) >= 50 THEN {HASH} END AS hash FROM cards),
dg AS (SELECT hash, count(*) AS n, arg_min(book, (book, page_num)) AS first_book, arg_min(page_num, (book, page_num)) AS first_page FROM hs WHERE hash IS NOT NULL GROUP BY hash HAVING count(*) > 1),
dm AS (SELECT hs.*, first_book IS NOT NULL AND NOT (first_book = book AND first_page = page_num) AS is_duplicate, first_book, first_page FROM hs LEFT JOIN dg USING (hash))"""


@query(f"WITH {DUPS} SELECT hash, n::BIGINT AS n, first_book, first_page FROM dg")
def dup_groups(spark, sf_dir):
    return enrich.duplicate_groups(cards(spark, sf_dir))


@query(f"WITH {DUPS} SELECT book, page_num, is_duplicate, CASE WHEN is_duplicate THEN first_book END AS duplicate_book, CASE WHEN is_duplicate THEN first_page END::VARCHAR AS duplicate_page FROM dm")
def dup_mark(spark, sf_dir):
    return enrich.duplicates_marked(cards(spark, sf_dir)).select("book", "page_num", "is_duplicate", "duplicate_book", F.col("duplicate_page").cast("string").alias("duplicate_page"))


GAPS = f"""{DUPS}, t AS (SELECT book, page_num, is_duplicate, list_distinct({sql_tokens('segment')}) AS t FROM dm), l AS (SELECT *, lag(t) OVER (PARTITION BY book ORDER BY page_num) AS b FROM t),
g AS (SELECT book, page_num, len(list_intersect(b, t))::DOUBLE / len(list_distinct(b || t)) AS o FROM l WHERE b IS NOT NULL AND NOT is_duplicate AND len(t) > 0 AND len(b) > 0)"""


@query(f"WITH {GAPS} SELECT book, page_num, round(o, 9) AS overlap, o < 0.1 AS gap FROM g")
def continuity_gaps(spark, sf_dir):
    return enrich.continuity(cards(spark, sf_dir))


@query(f"""WITH {GAPS}, a AS (SELECT book, sum((o < 0.1)::INTEGER) AS gaps, round(avg(round(o, 9)), 3) AS avg_overlap FROM g GROUP BY book), p AS (SELECT book, count(*) AS pages FROM cards GROUP BY book)
SELECT book, pages::BIGINT AS pages, coalesce(gaps, 0)::BIGINT AS gaps, round(coalesce(gaps, 0) / greatest(pages - 1, 1), 6) AS gap_ratio, avg_overlap FROM p LEFT JOIN a USING (book)""")
def continuity_audit(spark, sf_dir):
    return enrich.continuity_audit(cards(spark, sf_dir))


@query(f"""WITH {CARDS}, t0 AS (SELECT doc_id, list_filter({sql_tokens('segment')}, lambda w: length(w) > 3) AS ts FROM cards), t AS (SELECT doc_id, unnest(ts) AS term, unnest(range(0, len(ts))) AS i FROM t0),
n AS (SELECT doc_id, term, count(*) AS n, min(i) AS i FROM t GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS rank FROM n)
SELECT doc_id, rank::INTEGER AS rank, term, n::BIGINT AS n FROM r WHERE rank <= 10 AND n > 1""")
def key_terms(spark, sf_dir):
    return enrich.key_terms(cards(spark, sf_dir))


@query(f"""WITH {DUPS} SELECT book, count(*)::BIGINT AS cards, sum(is_duplicate::INTEGER)::BIGINT AS duplicates, round(avg(is_duplicate::INTEGER), 6) AS duplicate_ratio,
 sum((NOT is_duplicate AND length(segment) >= 100)::INTEGER)::BIGINT AS extracted FROM dm GROUP BY book""")
def extended_audit(spark, sf_dir):
    return enrich.audit(cards(spark, sf_dir))
