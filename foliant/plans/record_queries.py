"""Queries over chunks, validation, run records, status logs and search; and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import SYNONYMS, THRESHOLDS
from ..operators import chunks, enrich, intervals, keyword_index, quality, search, structure, summaries, validation
from .card_queries import FILLED
from .tables import CARDS, HEADED, cards, headed, table
from .text_queries import listed, quoted, sql_keywords, sql_sentences, sql_strip, sql_tokens

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- chunks
TAIL = "a.cur[list_filter(range(1, len(a.cur) + 2), lambda i: coalesce(list_sum(list_transform(a.cur[i:], lambda y: length(y) // 4)), 0) <= 128)[1]:]"
EMIT = "CASE WHEN length(array_to_string(a.cur, ' ')) // 4 >= 100 THEN a.out || [array_to_string(a.cur, ' ')] ELSE a.out END"
FOLD = f"""list_reduce(list_transform({sql_sentences('segment')}, lambda s: {{'cur': [s], 'n': (length(s) // 4)::BIGINT, 'out': []::VARCHAR[]}}),
 lambda a, x: CASE WHEN a.n + x.n > 512 AND len(a.cur) > 0
  THEN {{'cur': {TAIL} || x.cur, 'n': (coalesce(list_sum(list_transform({TAIL}, lambda y: length(y) // 4)), 0) + x.n)::BIGINT, 'out': {EMIT}}}
  ELSE {{'cur': a.cur || x.cur, 'n': a.n + x.n, 'out': a.out}} END, {{'cur': []::VARCHAR[], 'n': 0::BIGINT, 'out': []::VARCHAR[]}})"""
CHUNKS = f"""f AS (SELECT *, {FOLD} AS a FROM cards WHERE length({sql_strip('segment')}) >= 10),
o AS (SELECT book, page_num, doc_id, CASE WHEN len(a.cur) > 0 THEN {EMIT} ELSE a.out END AS out FROM f),
u AS (SELECT book, page_num, doc_id, unnest(out) AS text, unnest(range(0, len(out))) AS ord FROM o),
chunks AS (SELECT book, page_num, doc_id, ord::INTEGER AS ord, lpad((row_number() OVER (PARTITION BY book ORDER BY page_num, ord) - 1)::VARCHAR, 8, '0') AS chunk_id, text, (length(text) // 4)::INTEGER AS tokens FROM u)"""


@query(f"WITH {CARDS}, {CHUNKS} SELECT * FROM chunks")
def chunk_pages(spark, sf_dir):
    return chunks.chunked(cards(spark, sf_dir).drop("source_file")).select("book", "page_num", "doc_id", "ord", "chunk_id", "text", "tokens")


@query(f"WITH {CARDS}, {CHUNKS} SELECT book, count(*)::BIGINT AS chunks, round(count(*) / count(DISTINCT page_num), 6) AS per_page, round(avg(tokens), 1) AS avg_tokens, min(tokens) AS min_tokens, max(tokens) AS max_tokens FROM chunks GROUP BY book")
def chunk_audit(spark, sf_dir):
    return chunks.audit(chunks.chunked(cards(spark, sf_dir)))


@query(f"WITH {CARDS}, {CHUNKS} SELECT CASE WHEN tokens < 100 THEN '<100' WHEN tokens < 300 THEN '100-299' WHEN tokens <= 512 THEN '300-512' ELSE '>512' END AS bucket, count(*)::BIGINT AS n FROM chunks GROUP BY 1")
def token_histogram(spark, sf_dir):
    return chunks.histogram(chunks.chunked(cards(spark, sf_dir)))


@query(f"""WITH {FILLED} SELECT book, page_num, left(array_to_string(list_filter(['Source: ' || source_file, CASE WHEN coalesce(chapter_title, '') <> '' THEN 'Chapter ' || coalesce(chapter_num, 'None') || ': ' || chapter_title END,
 CASE WHEN coalesce(section_title, '') <> '' THEN 'Section ' || coalesce(section_num, 'None') || ': ' || section_title END], lambda x: x IS NOT NULL), ' | '), 800) AS context FROM filled""")
def chunk_context(spark, sf_dir):
    c = structure.filled(headed(spark, sf_dir))
    return c.select("book", "page_num", chunks.context(*[F.col(x) for x in ("source_file", "chapter_num", "chapter_title", "section_num", "section_title")]).alias("context"))


# ---------------------------------------------------------------- validation: each line of a document is a record
LINES = """l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
r AS (SELECT doc_id, i::INTEGER AS page_num, nullif(line, '') AS segment, CASE WHEN (doc_id + i) % 11 <> 0 THEN lpad((i // 2)::VARCHAR, 5, '0') END AS segment_id FROM l0),
m AS (SELECT *, array_to_string(list_filter([CASE WHEN segment_id IS NULL THEN 'segment_id' END, CASE WHEN segment IS NULL THEN 'segment' END, CASE WHEN page_num IS NULL THEN 'page_num' END], lambda x: x IS NOT NULL), ', ') AS gone,
 CASE WHEN length(segment) < 10 THEN 'too short' WHEN length(segment) > 50000 THEN 'too long' WHEN (length(segment) - length(replace(replace(segment, ' ', ''), chr(10), ''))) / length(segment) > 0.5 THEN 'mostly blank' END AS q FROM r),
v AS (SELECT doc_id, page_num, 'RequiredField' AS rule, 'ERROR' AS severity, 'Missing required fields: ' || gone AS message FROM m WHERE gone <> ''
 UNION ALL SELECT doc_id, page_num, 'TextQuality', 'WARNING', q FROM m WHERE q IS NOT NULL
 UNION ALL SELECT doc_id, page_num, 'Range', 'ERROR', 'page_num below 1' FROM m WHERE page_num < 1)"""


def line_records(spark, sf_dir):
    l = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page_num", "line"))
    sid = F.when((F.col("doc_id") + F.col("page_num")) % 11 != 0, T.padded(F.floor(F.col("page_num") / 2), 5))
    return l.select("doc_id", "page_num", F.nullif("line", F.lit("")).alias("segment"), sid.alias("segment_id"))


@query(f"WITH {LINES} SELECT * FROM v")
def validate_rules(spark, sf_dir):
    return validation.violations(line_records(spark, sf_dir), validation.STAGES["structural"](), "doc_id", "page_num")


@query(f"""WITH {LINES}, s AS (SELECT doc_id, sum((severity = 'ERROR')::INTEGER) AS e, sum((severity = 'WARNING')::INTEGER) AS w FROM v GROUP BY doc_id), n AS (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id)
SELECT n.doc_id, n::BIGINT AS records, coalesce(e, 0)::BIGINT AS errors, coalesce(w, 0)::BIGINT AS warnings, coalesce(e, 0) = 0 AS valid FROM n LEFT JOIN s USING (doc_id)""")
def validate_summary(spark, sf_dir):
    return validation.summary(line_records(spark, sf_dir), validation.STAGES["structural"](), "doc_id")


@query(f"WITH {LINES} SELECT rule, severity, count(*)::BIGINT AS n FROM v GROUP BY rule, severity")
def violations_by_rule(spark, sf_dir):
    return validation.by_rule(line_records(spark, sf_dir), validation.STAGES["structural"](), "doc_id")


@query(f"""WITH {LINES}, t AS (SELECT doc_id AS book, segment_id FROM r WHERE segment_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT r.doc_id, r.page_num, array_to_string(list_filter([CASE WHEN coalesce(r.segment_id, '') IN ('', '0') THEN 'missing segment_id' END, CASE WHEN coalesce(segment, '') IN ('', '0') THEN 'missing segment' END,
 CASE WHEN page_num = 0 THEN 'missing page_num' END, CASE WHEN length(regexp_replace(segment, '^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$', '', 'g')) < 10 THEN 'short segment' END, CASE WHEN t.book IS NOT NULL THEN 'repeated segment_id' END], lambda x: x IS NOT NULL), '; ') AS problems
FROM r LEFT JOIN t ON t.book = r.doc_id AND t.segment_id = r.segment_id""")
def finalize_validate(spark, sf_dir):
    c = line_records(spark, sf_dir).withColumns({"book": F.col("doc_id"), "source_file": F.lit("a.pdf")})
    return validation.finalized(c).select("doc_id", "page_num", F.array_join("problems", "; ").alias("problems"))


@query(f"""WITH {LINES} SELECT doc_id, page_num, segment_id, segment FROM r WHERE segment_id IS NOT NULL AND page_num <> 0
 AND length(regexp_replace(segment, '^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$', '', 'g')) >= 10""")
def accepted_cards(spark, sf_dir):
    c = line_records(spark, sf_dir).withColumns({"book": F.col("doc_id"), "source_file": F.lit("a.pdf")})
    return validation.accepted(c).select("doc_id", "page_num", "segment_id", "segment")


@query(f"WITH {LINES} SELECT doc_id, page_num, segment_id IS NULL AS no_id, coalesce(segment, '') AS segment FROM r")
def clean_cards(spark, sf_dir):
    c = line_records(spark, sf_dir).withColumns({"segment_id": F.coalesce("segment_id", F.lit("")), "page_num": F.col("page_num").cast("string")})
    return validation.cleaned(c).select("doc_id", "page_num", F.col("segment_id").isNull().alias("no_id"), F.coalesce("segment", F.lit("")).alias("segment"))


@query(f"""WITH {LINES}, n AS (SELECT doc_id AS book, count(*) AS n, sum((coalesce(segment_id, '') NOT IN ('', '0', 'false'))::INTEGER) AS segment_id, sum((coalesce(segment, '') NOT IN ('', '0', 'false'))::INTEGER) AS segment, sum((page_num <> 0)::INTEGER) AS page_num FROM r GROUP BY 1)
SELECT book, field, filled::BIGINT AS filled, round(filled / n, 6) AS ratio FROM n UNPIVOT (filled FOR field IN (segment_id, segment, page_num))""")
def field_coverage(spark, sf_dir):
    return validation.coverage(line_records(spark, sf_dir).withColumn("book", F.col("doc_id")), ["segment_id", "segment", "page_num"])


@query("""SELECT source AS book, count(*)::BIGINT AS total_pages, round(avg((length(text) >= 50)::INTEGER), 6) AS success_ratio, sum((length(text) < 50)::INTEGER)::BIGINT AS empty_pages, round(avg(length(text)), 6) AS avg_page_length,
 sum((lang = 'en')::INTEGER)::BIGINT AS method_en, sum((lang <> 'en')::INTEGER)::BIGINT AS method_other FROM documents GROUP BY source""")
def structural_audit(spark, sf_dir):
    n = F.length("text")
    count = lambda c: F.sum(c.cast("int"))
    return table(spark, sf_dir, "documents").groupBy(F.col("source").alias("book")).agg(
        F.count("*").alias("total_pages"), F.round(F.avg((n >= 50).cast("int")), 6).alias("success_ratio"), count(n < 50).alias("empty_pages"), F.round(F.avg(n), 6).alias("avg_page_length"), count(F.col("lang") == "en").alias("method_en"), count(F.col("lang") != "en").alias("method_other")
    )


# ---------------------------------------------------------------- run records: one event is one record
RUNS = "runs AS (SELECT event_id AS run, event_type AS stage, user_id AS source, ts, value, value < 50 AS passed FROM events)"


def runs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("run"), F.col("event_type").alias("stage"), F.col("user_id").alias("source"), "ts", "value", (F.col("value") < 50).alias("passed"))


STAGE_NAMES = {"view": "structural", "click": "chunk", "purchase": "embed", "signup": "extended", "error": "summarize"}
METRICS = ["success_ratio", "empty_ratio", "avg_tokens", "embedding_success", "duplicates_ratio", "summary_length"]
BOUNDS = "b(stage, key, bound) AS (VALUES " + ", ".join(f"('{s}', '{k}', {float(v)}::DOUBLE)" for s, own in THRESHOLDS.items() for k, v in own.items()) + ")"


@query(f"""WITH {BOUNDS}, e AS (SELECT event_id AS run, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in STAGE_NAMES.items())} END AS stage, {listed(METRICS)}[(event_id % 6 + 1)::INTEGER] AS metric, round(value / 100, 6) AS value FROM events)
SELECT e.run, e.stage, key, bound, CASE WHEN substr(key, 5) = metric THEN value ELSE -1 END AS value, CASE WHEN substr(key, 5) <> metric THEN 'missing' WHEN (key LIKE 'min\\_%' ESCAPE '\\' AND value < bound) OR (key LIKE 'max\\_%' ESCAPE '\\' AND value > bound) THEN 'violation' ELSE 'ok' END AS status FROM e JOIN b USING (stage)""")
def threshold_check(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    stage = F.create_map(*[F.lit(x) for kv in STAGE_NAMES.items() for x in kv])[F.col("event_type")]
    m = e.select(F.col("event_id").alias("run"), stage.alias("stage"), F.get(F.array(*map(F.lit, METRICS)), (F.col("event_id") % 6).cast("int")).alias("metric"), F.round(F.col("value") / 100, 6).alias("value"))
    return quality.checked(m, quality.limits(spark)).withColumn("value", F.coalesce("value", F.lit(-1.0)))


@query(f"WITH {RUNS} SELECT stage, 'value' AS metric, count(value)::BIGINT AS n, min(value) AS least, max(value) AS most, round(avg(value), 6) AS mean FROM runs GROUP BY stage")
def metric_stats(spark, sf_dir):
    return quality.statistics(runs(spark, sf_dir).withColumn("metric", F.lit("value")))


@query(f"WITH {RUNS} SELECT stage, count(*)::BIGINT AS total, sum(passed::INTEGER)::BIGINT AS passed, sum(1 - passed::INTEGER)::BIGINT AS failed, round(avg(passed::INTEGER), 6) AS pass_rate FROM runs GROUP BY stage")
def pass_rate(spark, sf_dir):
    return quality.pass_rates(runs(spark, sf_dir))


@query(f"WITH {RUNS}, t AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, run DESC) AS r FROM runs) SELECT stage, count(*)::BIGINT AS n, min(run) AS oldest, round(avg(passed::INTEGER), 6) AS pass_rate FROM t WHERE r <= 5 GROUP BY stage")
def recent_trend(spark, sf_dir):
    t = quality.trend(runs(spark, sf_dir), 5)
    return t.groupBy("stage").agg(F.count("*").alias("n"), F.min("run").alias("oldest"), F.round(F.avg(F.col("passed").cast("int")), 6).alias("pass_rate"))


@query(f"WITH {RUNS}, t AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY ts DESC, run DESC)::INTEGER AS r FROM runs) SELECT stage, r, source, value FROM t WHERE r <= 10")
def metric_trend(spark, sf_dir):
    return quality.trend(runs(spark, sf_dir), 10).select("stage", "r", "source", "value")


@query(f"WITH {RUNS}, a AS (SELECT user_id AS source FROM events UNION SELECT c_custkey FROM customer), l AS (SELECT source, arg_max(run, (ts, run)) AS run, arg_max(value, (ts, run)) AS value FROM runs GROUP BY source) SELECT a.source, coalesce(run::VARCHAR, 'No data') AS run, coalesce(value, -1) AS value FROM a LEFT JOIN l USING (source)")
def compare_sources(spark, sf_dir):
    # every source with records, and customers without any
    asked = table(spark, sf_dir, "events").select(F.col("user_id").alias("source")).union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()
    return quality.latest(runs(spark, sf_dir), asked).select("source", F.coalesce(F.col("run").cast("string"), F.lit("No data")).alias("run"), F.coalesce("value", F.lit(-1.0)).alias("value"))


@query(f"WITH {RUNS} SELECT coalesce(stage, 'all') AS stage, count(*)::BIGINT AS runs, sum(passed::INTEGER)::BIGINT AS passed, round(avg(passed::INTEGER), 6) AS pass_rate FROM runs GROUP BY ROLLUP (stage)")
def quality_summary(spark, sf_dir):
    return quality.overall(runs(spark, sf_dir)).withColumn("stage", F.coalesce("stage", F.lit("all")))


@query("SELECT event_type AS operation, count(*)::BIGINT AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most FROM events GROUP BY 1")
def perf_stats(spark, sf_dir):
    return quality.performance(table(spark, sf_dir, "events").select(F.col("event_type").alias("operation"), F.col("value").alias("seconds")))


@query("SELECT user_id % 10 AS stage, sum((event_type = 'error')::INTEGER)::BIGINT AS error, sum((event_type = 'view')::INTEGER)::BIGINT AS view FROM events GROUP BY 1")
def error_summary(spark, sf_dir):
    return quality.errors(table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("stage"), F.col("event_type").alias("kind")), ["error", "view"])


# ---------------------------------------------------------------- status logs
NOW = "2024-12-31 00:00:00"
KINDS = ["click", "error", "purchase", "signup", "view"]
SPANS = f"""i AS (SELECT user_id AS key, event_type AS status, ts AS entered, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '{NOW}') AS "left" FROM events),
iv AS (SELECT *, round((epoch_us("left") - epoch_us(entered)) / 86400000000, 4) AS days FROM i WHERE "left" >= entered)"""


def log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("id"))


@query(f"""WITH {SPANS} SELECT key, status, epoch_us(entered) AS entered_us, epoch_us("left") AS left_us, days FROM iv""")
def status_intervals(spark, sf_dir):
    i = intervals.status_intervals(log(spark, sf_dir), NOW)
    return i.select("key", "status", F.unix_micros("entered").alias("entered_us"), F.unix_micros("left").alias("left_us"), "days")


@query(f"""WITH {SPANS} SELECT key, {', '.join(f"coalesce(round(sum(days) FILTER (WHERE status = '{k}'), 4), 0) AS d_{k}" for k in KINDS)} FROM iv GROUP BY key""")
def status_pivot(spark, sf_dir):
    return intervals.status_pivot(intervals.status_intervals(log(spark, sf_dir), NOW), KINDS)


@query("""WITH k AS (SELECT user_id AS key FROM events UNION SELECT c_custkey FROM customer), g AS (SELECT user_id AS key, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events GROUP BY 1)
SELECT k.key, coalesce(a, -1) AS first_us, coalesce(b, -1) AS last_us, coalesce(round((b - a) / 86400000000, 4), -1) AS days FROM k LEFT JOIN g USING (key)""")
def t2m(spark, sf_dir):
    # every key with a log, and customers without one
    keys = table(spark, sf_dir, "events").select(F.col("user_id").alias("key")).union(table(spark, sf_dir, "customer").select("c_custkey")).distinct()
    t = intervals.lead_times(keys, log(spark, sf_dir))
    us = lambda c: F.coalesce(F.unix_micros(c), F.lit(-1))
    return t.select("key", us("first_at").alias("first_us"), us("last_at").alias("last_us"), F.coalesce("days", F.lit(-1.0)).alias("days"))


# ---------------------------------------------------------------- search
SQL_DOT = "list_sum(list_transform(list_zip(embedding, q), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
COSINE = "cos AS (SELECT vec_id AS id, round(list_inner_product(embedding::DOUBLE[], q::DOUBLE[]) / greatest(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(q::DOUBLE[], q::DOUBLE[])), 1e-12), 6) AS score FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0))"


def question(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("vec_id = 0").select(F.col("embedding").alias("q"))


def semantic(spark, sf_dir, k):
    return search.nearest(table(spark, sf_dir, "embeddings"), question(spark, sf_dir), k)


def terms(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").where("item_id = 0").select(F.explode(T.keyword_tokens(F.col("text"))).alias("term"))


def keyword(spark, sf_dir, k):
    """From the stored index, which the first query over these files writes."""
    words = [r["term"] for r in terms(spark, sf_dir).collect()]  # one query's words
    return keyword_index.search(spark, keyword_index.kept(table(spark, sf_dir, "documents")), words, k)


BM25 = f"""w AS (SELECT doc_id AS id, {sql_keywords('text')} AS w FROM documents), tot AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM w),
tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM w) GROUP BY ALL), idf AS (SELECT term, ln((docs - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tf, tot GROUP BY term, docs),
fl AS (SELECT 0.25::DOUBLE * avg(idf) AS fl FROM idf), ask AS (SELECT term, count(*) AS asked FROM (SELECT unnest({sql_keywords('text')}) AS term FROM benchmark WHERE item_id = 0) GROUP BY term),
bm AS (SELECT tf.id, round(sum(asked * CASE WHEN idf < 0 THEN fl ELSE idf END * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(w.w) / mean))), 6) AS score FROM tf JOIN ask USING (term) JOIN idf USING (term) JOIN w ON w.id = tf.id, fl, tot GROUP BY tf.id)"""
TOP = lambda name, k, extra="": f"SELECT id, score FROM {name} {extra} ORDER BY score DESC, id LIMIT {k}"


@query("SELECT vec_id, array_to_string(list_transform(embedding, lambda x: printf('%.5f', x::DOUBLE / greatest(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12))), ',') AS unit FROM embeddings")
def l2_normalize(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("u", search.normalized(F.col("embedding")))
    return e.select("vec_id", F.array_join(F.transform("u", lambda x: F.format_string("%.5f", x)), ",").alias("unit"))


@query(f"WITH {COSINE} {TOP('cos', 10)}")
def knn_cosine(spark, sf_dir):
    return semantic(spark, sf_dir, 10)


@query(f"""WITH l AS (SELECT vec_id AS id, round(0 - list_distance(embedding::DOUBLE[], q::DOUBLE[]), 6) AS score FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0)) {TOP('l', 10)}""")
def knn_l2(spark, sf_dir):
    return search.nearest(table(spark, sf_dir, "embeddings"), question(spark, sf_dir), 10, "l2")


@query("SELECT label, count(*)::BIGINT AS n, max(len(embedding))::INTEGER AS dim, round(avg(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS mean_norm, round(min(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS least, round(max(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 6) AS most FROM embeddings GROUP BY label")
def embedding_stats(spark, sf_dir):
    n = search.norm(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"), F.round(F.avg(n), 6).alias("mean_norm"), F.round(F.min(n), 6).alias("least"), F.round(F.max(n), 6).alias("most"))


@query(f"WITH {BM25} {TOP('bm', 10, 'WHERE score > 0')}")
def bm25_search(spark, sf_dir):
    return keyword(spark, sf_dir, 10)


def sql_fused(k):
    part = lambda n, s, extra="": f"{n}0 AS ({TOP(s, 2 * k, extra)}), {n} AS (SELECT id, CASE WHEN max(score) OVER () = min(score) OVER () THEN 1.0::DOUBLE ELSE (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) END AS v FROM {n}0)"
    return f"""{COSINE}, {BM25}, {part('se', 'cos')}, {part('kw', 'bm', 'WHERE score > 0')},
fu AS (SELECT coalesce(se.id, kw.id) AS id, coalesce(se.v, 0)::DOUBLE AS semantic, coalesce(kw.v, 0)::DOUBLE AS keyword, round(0.7::DOUBLE * coalesce(se.v, 0) + (1 - 0.7::DOUBLE) * coalesce(kw.v, 0), 6) AS score FROM se FULL JOIN kw ON se.id = kw.id)"""


@query(f"WITH {sql_fused(5)} SELECT id, round(semantic, 6) AS semantic, round(keyword, 6) AS keyword, score FROM fu ORDER BY score DESC, id LIMIT 5")
def hybrid_search(spark, sf_dir):
    h = search.hybrid(semantic(spark, sf_dir, 10), keyword(spark, sf_dir, 10))
    return h.select("id", F.round("semantic", 6).alias("semantic"), F.round("keyword", 6).alias("keyword"), "score").orderBy(F.desc("score"), "id").limit(5)


@query(f"""WITH {sql_fused(5)}, sr AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM se0), kr AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM kw0)
SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS score FROM (SELECT * FROM sr UNION ALL SELECT * FROM kr) GROUP BY id""")
def rrf_fusion(spark, sf_dir):
    return search.reciprocal_rank([semantic(spark, sf_dir, 10), keyword(spark, sf_dir, 10)])


META = f"""{CARDS}, meta AS (SELECT c.doc_id AS id, book, page_num, contains(segment, '|') AS has_table, {sql_tokens('segment')} AS topics FROM cards c)"""


def metadata(spark, sf_dir):
    return cards(spark, sf_dir).select(F.col("doc_id").alias("id"), "book", "page_num", F.col("segment").contains("|").alias("has_table"), T.tokens(F.col("segment")).alias("topics"))


@query(f"WITH {META}, {COSINE}, t AS ({TOP('cos', 100)}) SELECT t.id, score, book, page_num FROM t JOIN meta USING (id) WHERE score >= -0.05 AND page_num BETWEEN 1 AND 20 AND NOT has_table AND book IN ({', '.join(quoted(f'src{i}') for i in range(12))})")
def search_filtered(spark, sf_dir):
    hits = semantic(spark, sf_dir, 100).join(metadata(spark, sf_dir), "id")
    return search.filtered(hits, min_score=-0.05, pages=(1, 20), has_table=False, book=[f"src{i}" for i in range(12)]).select("id", "score", "book", "page_num")


WANTED = ["von", "que", "tion", "onon", "les"]


@query(f"WITH {META} SELECT id, book FROM meta WHERE list_has_any(topics, {listed(WANTED)})")
def filter_any_overlap(spark, sf_dir):
    return search.filtered(metadata(spark, sf_dir), overlap={"topics": WANTED}).select("id", "book")


@query("SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.page_id) AND NOT contains(url, '/de/')")
def incremental_exclude(spark, sf_dir):
    """Pages that are not yet processed, without an excluded pattern."""
    p = table(spark, sf_dir, "pages").where(~F.col("url").contains("/de/"))
    return p.join(table(spark, sf_dir, "labels"), p.page_id == F.col("doc_id"), "left_anti").select("page_id", "url")


EXPAND = "[" + ", ".join(f"CASE WHEN contains(low, {quoted(t)}) THEN replace(low, {quoted(t)}, {quoted(o)}) END" for t, os in SYNONYMS.items() for o in os[:3]) + "]"
EXPANDED = f"""q AS (SELECT item_id, text || ' Deploy ' || CASE WHEN item_id % 2 = 0 THEN 'CI test' ELSE 'agile' END AS text FROM benchmark), lo AS (SELECT *, lower(text) AS low FROM q),
ex AS (SELECT item_id, ([text] || list_filter({EXPAND}, lambda x: x IS NOT NULL AND x <> low))[1:5] AS qs FROM lo)"""


@query(f"WITH {EXPANDED} SELECT item_id, unnest(range(0, len(qs)))::INTEGER AS n, unnest(qs) AS query FROM ex")
def expand_query(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    text = F.concat("text", F.lit(" Deploy "), F.when(F.col("item_id") % 2 == 0, "CI test").otherwise("agile"))
    return search.expanded(b.select("item_id", text.alias("text"))).select("item_id", "n", "query")


def sql_near(v):
    return f"(SELECT vec_id AS id, round(list_inner_product(embedding::DOUBLE[], q::DOUBLE[]) / greatest(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(q::DOUBLE[], q::DOUBLE[])), 1e-12), 6) AS score FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = {v}) ORDER BY score DESC, id LIMIT 20)"


MERGE = "h AS (" + " UNION ALL ".join(f"SELECT {i} AS query_no, id, score FROM {sql_near(v)}" for i, v in enumerate((0, 1, 7))) + "), mq AS (SELECT id, arg_min(score, query_no) AS score FROM h GROUP BY id)"


def several(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    out = None
    for i, v in enumerate((0, 1, 7)):
        h = search.nearest(e, e.where(F.col("vec_id") == v).select(F.col("embedding").alias("q")), 20).withColumn("query_no", F.lit(i))
        out = h if out is None else out.union(h)
    return search.merged(out)


@query(f"WITH {MERGE} SELECT id, score FROM mq")
def multi_query_merge(spark, sf_dir):
    return several(spark, sf_dir)


SEARCH = f"{META}, {MERGE}, hit AS (SELECT id, round(score, 4) AS score, book, page_num FROM mq JOIN meta USING (id) WHERE page_num <= 25 ORDER BY mq.score DESC, id LIMIT 10)"


def searched(spark, sf_dir):
    """Several queries merged, then filtered, then cut to k."""
    hits = search.filtered(several(spark, sf_dir).join(metadata(spark, sf_dir), "id"), pages=(1, 25))
    return hits.orderBy(F.desc("score"), "id").limit(10).select("id", F.round("score", 4).alias("score"), "book", "page_num")


@query(f"WITH {SEARCH} SELECT * FROM hit")
def search_query(spark, sf_dir):
    return searched(spark, sf_dir)


@query(f"""WITH {SEARCH}, ar AS (SELECT doc_id AS id, coalesce((lag(doc_id) OVER w)::VARCHAR, '') AS before, coalesce((lead(doc_id) OVER w)::VARCHAR, '') AS after FROM cards WINDOW w AS (PARTITION BY book ORDER BY doc_id))
SELECT id, score, before, after FROM hit JOIN ar USING (id)""")
def context_expand(spark, sf_dir):
    n = search.neighbours(cards(spark, sf_dir), searched(spark, sf_dir))
    return n.select("id", "score", F.array_join(F.transform("before", lambda x: x.cast("string")), ",").alias("before"), F.array_join(F.transform("after", lambda x: x.cast("string")), ",").alias("after"))


@query(f"""WITH {CARDS}, s AS (SELECT book, count(*) AS n FROM cards GROUP BY book), o AS (SELECT book, (coalesce(sum(n) OVER (ORDER BY book ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS range_start, n FROM s)
SELECT book, doc_id, (range_start + row_number() OVER (PARTITION BY book ORDER BY doc_id) - 1)::BIGINT AS global_id, range_start, (range_start + n)::BIGINT AS range_end FROM cards JOIN o USING (book)""")
def unified_index(spark, sf_dir):
    return search.unified(cards(spark, sf_dir))


@query(f"""WITH {META}, {COSINE}, t AS ({TOP('cos', 20)}), h AS (SELECT t.*, book FROM t JOIN meta USING (id)), b AS (SELECT book, max(score) AS best FROM h GROUP BY book ORDER BY best DESC, book LIMIT 5),
r AS (SELECT h.book, best, row_number() OVER (PARTITION BY h.book ORDER BY score DESC, id)::INTEGER AS rank, id, score FROM h JOIN b USING (book)) SELECT * FROM r WHERE rank <= 3""")
def search_by_book(spark, sf_dir):
    hits = semantic(spark, sf_dir, 20).join(metadata(spark, sf_dir), "id")
    return search.by_book(hits).select("book", "best", "rank", "id", "score")


@query("SELECT source AS book, count(*)::BIGINT AS chunks, count(vec_id)::BIGINT AS vectors, min(len(embedding))::VARCHAR AS dim, count(*) = count(vec_id) AS complete FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY source")
def index_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left")
    return d.groupBy(F.col("source").alias("book")).agg(F.count("*").alias("chunks"), F.count("vec_id").alias("vectors"), F.min(F.when(F.col("vec_id").isNotNull(), F.size("embedding"))).cast("string").alias("dim"), (F.count("*") == F.count("vec_id")).alias("complete"))


QUERIES["search"] = QUERIES.pop("search_query")
ORACLES["search"] = ORACLES.pop("search_query")
