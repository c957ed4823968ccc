"""Queries over the text and JSON functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from ..sources import datasets
from .tables import CARDS, HEADED, cards, headed, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(texts) -> str:
    return "[" + ", ".join(map(quoted, texts)) + "]"


WS = "[ \\t\\n\\r\\x0B\\f]"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def sql_replace(c: str, pairs) -> str:
    for old, new in pairs:
        c = f"replace({c}, {quoted(old)}, {quoted(new)})"
    return c


@query(f"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS page FROM documents),
q AS (SELECT *, length({sql_strip('line')}) AS n FROM p)
SELECT doc_id, page::INTEGER AS page, n::INTEGER AS n_chars, (n < 10 OR (page <= 5 AND n < 20)) AS blank, NOT (n < 10 OR (page <= 5 AND n < 20)) AND n < 50 AS needs_ocr FROM q""")
def page_blankness(spark, sf_dir):
    """Blank pages and pages that need recognition; a page is a line here."""
    p = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page", "line"))
    n = F.length(T.strip(F.col("line")))
    blank = (n < 10) | ((F.col("page") <= 5) & (n < 20))
    return p.select("doc_id", "page", n.alias("n_chars"), blank.alias("blank"), (~blank & (n < 50)).alias("needs_ocr"))


def nation_tables(spark, sf_dir):
    cells = F.array(F.concat(F.lit(" "), F.col("n_nationkey").cast("string")), F.concat(F.col("n_name"), F.lit("  ")))
    t = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", cells.alias("cells")))).alias("rows"))
    return t.select("n_regionkey", F.transform("rows", lambda r: r["cells"]).alias("data"))


NATIONS = """t AS (SELECT n_regionkey, list([' ' || n_nationkey, n_name || '  '] ORDER BY n_nationkey) AS data FROM nation GROUP BY n_regionkey)"""


@query(f"""WITH {NATIONS} SELECT n_regionkey, 'table_1' AS table_id, len(data)::INTEGER AS n_rows, len(data[1])::INTEGER AS n_cols,
array_to_string(list_transform(data, lambda r: array_to_string(list_transform(r, lambda c: trim(c)), '|')), ';') AS cells FROM t WHERE len(data) >= 2 AND len(data[1]) >= 2""")
def tables_filter(spark, sf_dir):
    return datasets.usable_tables(nation_tables(spark, sf_dir)).select("n_regionkey", "table_id", "n_rows", "n_cols", F.array_join(F.transform("data", lambda r: F.array_join(r, "|")), ";").alias("cells"))


@query(f"""WITH {NATIONS}, c AS (SELECT n_regionkey, list_transform(data, lambda r: list_transform(r, lambda c: trim(c))) AS d FROM t)
SELECT n_regionkey, '| ' || array_to_string(d[1], ' | ') || ' |' || chr(10) || '| ' || array_to_string(list_transform(d[1], lambda x: '---'), ' | ') || ' |'
 || chr(10) || array_to_string(list_transform(d[2:], lambda r: '| ' || array_to_string(r, ' | ') || ' |'), chr(10)) AS markdown FROM c""")
def table_markdown(spark, sf_dir):
    t = datasets.usable_tables(nation_tables(spark, sf_dir))
    return t.select("n_regionkey", datasets.markdown(F.col("data")).alias("markdown"))


NAMED = "n AS (SELECT p_partkey, p_name || ' – (' || p_brand || ')®  ' || p_type || ' книга щит №' || p_size AS stem FROM part)"


def named(spark, sf_dir):
    stem = F.concat("p_name", F.lit(" – ("), "p_brand", F.lit(")®  "), "p_type", F.lit(" книга щит №"), F.col("p_size").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", stem.alias("stem"))


def sql_sanitized(c):
    a = f"regexp_replace(regexp_replace({sql_replace(f'lower({c})', C.LATIN.items())}, '[^\\p{{L}}\\p{{N}}]', '_', 'g'), '_+', '_', 'g')"
    return f"(SELECT regexp_replace(CASE WHEN length(a) > 50 THEN left(a, 43) || '_' || left(md5({c}), 6) ELSE a END, '^_+|_+$', '', 'g') FROM (SELECT {a} AS a))"


@query(f"WITH {NAMED} SELECT p_partkey, {sql_sanitized('stem')} || '.pdf' AS name FROM n")
def sanitize_name(spark, sf_dir):
    return named(spark, sf_dir).select("p_partkey", F.concat(T.sanitized(F.col("stem")), F.lit(".pdf")).alias("name"))


@query(f"""WITH {NAMED}, m AS (SELECT p_partkey, stem, stem || '.pdf' AS name, regexp_replace({sql_replace('stem', C.UNSAFE.items())}, ' {{2,}}', ' ', 'g') AS s FROM n),
k AS (SELECT *, regexp_replace(replace(s, ' ', '_'), '^_+|_+$', '', 'g') AS z FROM m)
SELECT p_partkey, array_to_string(list_filter([CASE WHEN length(name) > 40 THEN 'LONG_FILENAME' END, CASE WHEN {' OR '.join(f'contains(name, {quoted(u)})' for u in C.UNSAFE)} THEN 'UNSAFE_CHARS' END,
 CASE WHEN contains(name, '  ') THEN 'MULTIPLE_SPACES' END, CASE WHEN stem <> {sql_strip('stem')} THEN 'WHITESPACE' END], lambda x: x IS NOT NULL), ',') AS issues,
 CASE WHEN length(z) > 36 THEN left(z, 29) || '_' || left(md5(stem), 6) ELSE z END || '.pdf' AS safe FROM k""")
def source_lint(spark, sf_dir):
    stem, name = F.col("stem"), F.concat("stem", F.lit(".pdf"))
    return named(spark, sf_dir).select("p_partkey", F.array_join(T.name_issues(name, stem, 40), ",").alias("issues"), T.safe_name(stem, ".pdf", 40).alias("safe"))


@query(f"WITH {CARDS} SELECT book, segment_id, page_num, segment, book AS merged_from FROM cards")
def merge_datasets(spark, sf_dir):
    c = cards(spark, sf_dir)
    books = [r["book"] for r in c.select("book").distinct().orderBy("book").collect()]  # the datasets' names, one file each
    return datasets.merged([c.where(F.col("book").eqNullSafe(b)).select("book", "segment_id", "page_num", "segment") for b in books])


@query(f"""WITH {CARDS} SELECT book, count(*)::BIGINT AS cards, sha256(string_agg(segment_id || ' ' || sha256(segment), chr(10) ORDER BY segment_id) || chr(10)) AS manifest FROM cards GROUP BY book""")
def manifest_sha256(spark, sf_dir):
    return datasets.manifests(cards(spark, sf_dir))


def sql_normalized(c):
    c = f"translate({c}, chr(65279) || chr(173) || chr(8203) || chr(8204) || chr(8205), '')"
    c = sql_replace(c, C.REPLACED.items())
    for p, r in ((r"([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])", r"\1\2"), (r"[ \t]+", " ")):
        c = f"regexp_replace({c}, '{p}', '{r}', 'g')"
    c = f"regexp_replace(regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '[ \\t\\r\\f]+\\n', chr(10), 'g')"
    return sql_strip(c)


@query(f"SELECT doc_id, {sql_normalized('''text || chr(10) || chr(10) || chr(10) || '«quo-  ' || chr(10) || ' ted»  — end–of' || chr(9) || ' page ' || chr(10)''')} AS normalized FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize(F.concat("text", F.lit("\n\n\n«quo-  \n ted»  — end–of\t page \n"))).alias("normalized"))


@query(f"SELECT doc_id, array_to_string(list_filter(string_split('12' || chr(10) || text || chr(10) || ' - 7 -' || chr(10) || '[ 9 ]', chr(10)), lambda x: NOT ({' OR '.join(f'regexp_matches(x, {quoted(p)})' for p in C.PAGE_NUMBERS)})), chr(10)) AS body FROM documents")
def strip_page_numbers(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.strip_page_numbers(F.concat(F.lit("12\n"), "text", F.lit("\n - 7 -\n[ 9 ]"))).alias("body"))


def sql_watermarks(c):
    for p in C.WATERMARKS:
        c = f"regexp_replace({c}, '{p}', '', 'g')"
    return sql_strip(f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"SELECT doc_id, {sql_watermarks('''text || ' Generated by Tool' || chr(10) || 'see www.books-1.org now downloaded  from here' ''')} AS body FROM documents")
def strip_watermarks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.strip_watermarks(F.concat("text", F.lit(" Generated by Tool\nsee www.books-1.org now downloaded  from here "))).alias("body"))


@query("SELECT doc_id, CASE WHEN length(text) > 100 THEN left(text, 97) || '...' ELSE text END AS short FROM documents")
def truncate_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate_text(F.col("text"), 100).alias("short"))


@query("""WITH b AS (SELECT page_id, strlen(html)::BIGINT * CAST(power(37, page_id % 7) AS BIGINT) AS n FROM pages)
SELECT page_id, CASE WHEN n < 1024 THEN printf('%.2f B', n::DOUBLE) WHEN n < 1024 ** 2 THEN printf('%.2f KB', n / 1024.0::DOUBLE) WHEN n < 1024 ** 3 THEN printf('%.2f MB', n / (1024.0::DOUBLE ** 2))
 WHEN n < 1024 ** 4 THEN printf('%.2f GB', n / (1024.0::DOUBLE ** 3)) WHEN n < 1024 ** 5 THEN printf('%.2f TB', n / (1024.0::DOUBLE ** 4)) ELSE printf('%.2f PB', n / (1024.0::DOUBLE ** 5)) END AS size FROM b""")
def format_size(spark, sf_dir):
    n = F.octet_length("html").cast("long") * F.pow(F.lit(37), F.col("page_id") % 7).cast("long")
    return table(spark, sf_dir, "pages").select("page_id", T.format_size(n).alias("size"))


STOP = listed(C.STOP_WORDS)


def sql_tokens(c):
    return f"list_filter(regexp_extract_all(lower({c}), '[A-Za-zА-Яа-я0-9]{{2,}}'), lambda w: NOT list_contains({STOP}, w))"


def sql_keywords(c):
    return f"list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) > 2)"


@query(f"SELECT doc_id, array_to_string({sql_tokens('text')}, ' ') AS tokens FROM documents")
def tokenize_stop(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens"))


@query(f"SELECT doc_id, array_to_string({sql_keywords('text')}, ' ') AS tokens FROM documents")
def tokenize_bm25(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.keyword_tokens(F.col("text")), " ").alias("tokens"))


def sql_sentences(c, pattern="([.!?])\\s+", keep="x <> ''"):
    return f"list_filter(list_transform(string_split(regexp_replace({c}, '{pattern}', '\\1' || chr(1), 'g'), chr(1)), lambda x: {sql_strip('x')}), lambda x: {keep})"


@query(f"SELECT doc_id, len(s)::INTEGER AS n, array_to_string(s, '|') AS sentences FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents)")
def sentences(spark, sf_dir):
    s = T.sentences(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n"), F.array_join(s, "|").alias("sentences"))


@query("SELECT doc_id, (length(text) // 4)::INTEGER AS tokens FROM documents")
def token_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.token_count(F.col("text")).alias("tokens"))


def sql_flags(c):
    has = lambda marks: "(" + " OR ".join(f"contains({c}, {quoted(m)})" for m in marks) + ")"
    return f"""{has(C.CODE_MARKS)} AS has_code, ({has(C.FORMULA_MARKS)} OR regexp_matches({c}, '{C.FORMULA}')) AS has_formulas, {has(C.DIAGRAM_MARKS)} AS has_diagram,
 (len(regexp_extract_all({c}, '[•*–]')) > 2 OR len(regexp_extract_all({c}, '(?m)^\\s*\\d+\\.')) > 2) AS has_list, ({' OR '.join(f'regexp_matches({c}, {quoted(p)})' for p in C.CITATIONS)}) AS has_citations"""


@query(f"SELECT doc_id, {sql_flags('text')} FROM (SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' see Fig. [3]' WHEN 1 THEN ' * a * b * c' WHEN 2 THEN ' (Smith 2020) def f' ELSE '' END AS text FROM documents)")
def heuristic_flags(spark, sf_dir):
    m = F.col("doc_id") % 5
    c = F.concat("text", F.when(m == 0, " see Fig. [3]").when(m == 1, " * a * b * c").when(m == 2, " (Smith 2020) def f").otherwise(""))
    flags = {"has_code": T.has_code, "has_formulas": T.has_formula, "has_diagram": T.has_diagram, "has_list": T.has_list, "has_citations": T.has_citations}
    return table(spark, sf_dir, "documents").select("doc_id", c.alias("text")).select("doc_id", *[f(F.col("text")).alias(n) for n, f in flags.items()])


@query("""SELECT c_custkey, array_to_string(regexp_extract_all('To: ' || c_name || ' <' || lower(replace(c_name, '#', '.')) || '@mail.example.org>; Desk <desk' || c_nationkey || '@example.com>', '<([^<>\\s]+@[^<>\\s]+\\.[^<>\\s]+)>', 1), '; ') AS emails FROM customer""")
def extract_emails(spark, sf_dir):
    c = F.concat(F.lit("To: "), "c_name", F.lit(" <"), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example.org>; Desk <desk"), F.col("c_nationkey").cast("string"), F.lit("@example.com>"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.emails(c).alias("emails"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.missing') AS VARCHAR) AS missing, coalesce(json_extract_string(props, '$.missing'), 'none') AS fallback FROM events")
def json_path(spark, sf_dir):
    miss = F.get_json_object("props", "$.missing")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), miss.alias("missing"), F.coalesce(miss, F.lit("none")).alias("fallback"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS content_type, false AS has_code, 0::INTEGER AS n_topics FROM events""")
def json_flatten(spark, sf_dir):
    """Nested answers to flat fields with defaults."""
    raw = F.concat(F.lit('{"content_type": "'), "event_type", F.lit('", "technical_content": '), "props", F.lit("}"))
    f = F.from_json(raw, "content_type string, topics array<string>, technical_content struct<k: bigint, has_code: boolean>")
    e = table(spark, sf_dir, "events").select("event_id", f.alias("f"))
    topics = F.coalesce("f.topics", F.array().cast("array<string>"))
    return e.select("event_id", F.col("f.technical_content.k").alias("k"), F.col("f.content_type").alias("content_type"), F.coalesce("f.technical_content.has_code", F.lit(False)).alias("has_code"), F.size(topics).alias("n_topics"))


@query("""WITH a AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'no answer' WHEN 1 THEN 'Answer: {bad} then ' || props || ' done' WHEN 2 THEN props ELSE 'x {"in": ' || props || '} ' || props END AS answer FROM events),
f AS (SELECT event_id, answer, list_filter(regexp_extract_all(answer, '\\{[^{}]*(?:\\{[^{}]*\\}[^{}]*)*\\}'), lambda x: json_valid(x)) AS found FROM a)
SELECT event_id, coalesce(found[1], CASE WHEN json_valid(answer) THEN answer END) AS found FROM f""")
def json_salvage(spark, sf_dir):
    """The JSON object inside an answer, which may hold other braces before it, or none."""
    m = F.col("event_id") % 4
    nested = F.concat(F.lit('x {"in": '), "props", F.lit("} "), "props")
    answer = F.when(m == 0, "no answer").when(m == 1, F.concat(F.lit("Answer: {bad} then "), "props", F.lit(" done"))).when(m == 2, F.col("props")).otherwise(nested)
    return table(spark, sf_dir, "events").select("event_id", T.salvaged(answer).alias("found"))


@query("""SELECT l.doc_id, CASE WHEN quality = 1 THEN 'simple' ELSE 'complex' END AS complexity, coalesce(CASE WHEN toxic = 1 THEN true END, contains(text, '=')) AS flag,
 CASE WHEN toxic = 1 THEN 'lm' ELSE 'heuristic' END AS extraction_method FROM labels l JOIN documents d ON d.doc_id = l.doc_id""")
def fields_merge(spark, sf_dir):
    """Model fields win over heuristic ones key by key."""
    j = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    model, plain = F.when(F.col("toxic") == 1, F.lit(True)), F.col("text").contains("=")
    return j.select("doc_id", F.when(F.col("quality") == 1, "simple").otherwise("complex").alias("complexity"), F.coalesce(model, plain).alias("flag"), F.when(model.isNotNull(), "lm").otherwise("heuristic").alias("extraction_method"))
