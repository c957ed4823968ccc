"""Queries that write and read files, run streams, or fit an index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ann, search
from ..sources import datasets
from ..sources.shared import fresh
from ..streaming import records
from . import pipeline
from .record_queries import question
from .tables import CARDS, cards, headed, table
from .text_queries import sql_normalized

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"WITH {CARDS} SELECT book, segment_id, page_num, segment, source_file FROM cards")
def dataset_roundtrip(spark, sf_dir):
    """Cards written as marked text files and read back."""
    folder = fresh(spark, "datasets")
    datasets.written(cards(spark, sf_dir), folder)
    return datasets.read(spark, folder).where("kind = 'card'").select("book", "segment_id", "page_num", "segment", "source_file")


@query(f"""WITH {CARDS}, l AS (SELECT book, 1 AS rank, '' AS segment_id, to_json({{'segment_id': '__header__', 'book': book, 'version': '2.0.0', 'total_cards': count(*)}})::VARCHAR AS line FROM cards GROUP BY book
 UNION ALL SELECT book, 2, segment_id, to_json({{'segment_id': segment_id, 'page_num': page_num, 'segment': segment, 'source_file': source_file}})::VARCHAR FROM cards
 UNION ALL SELECT book, 3, '', to_json({{'segment_id': '__audit__', 'book': book, 'total_cards': count(*)}})::VARCHAR FROM cards GROUP BY book),
m AS (SELECT book, count(*)::BIGINT AS lines, sha256(string_agg(line || chr(10), '' ORDER BY rank, segment_id)) AS found FROM l GROUP BY book)
SELECT book, lines, found AS stated, found, true AS intact FROM m""")
def dataset_manifest(spark, sf_dir):
    """The digest of each book's file, as its footer states it and as its lines give it."""
    folder = fresh(spark, "datasets")
    datasets.written(cards(spark, sf_dir), folder)
    return datasets.checked(spark, folder)


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return records.records(spark, f"{sf_dir}/events.parquet*", schema).withColumn("stage", F.col("event_type"))


@query("SELECT epoch_us(date_trunc('day', ts)) AS day_us, event_type AS stage, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_metric_stats(spark, sf_dir):
    events = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    done = records.drained(records.windowed(events), "complete")
    return done.select(F.unix_micros("w.start").alias("day_us"), "stage", "n", "total")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_seen(spark, sf_dir):
    return records.drained(records.first_seen(_events(spark, sf_dir), "user_id", "event_type"), "append")


@query("""WITH l AS (SELECT user_id AS source, strftime(ts, '%Y-%m-%d') || ' [' || upper(event_type) || '] run ' || event_id AS line FROM events)
SELECT source, count(*)::BIGINT AS lines, max(contains(line, '[PURCHASE]')::INTEGER)::INTEGER AS completed, max(contains(line, '[ERROR]')::INTEGER)::INTEGER AS failed, count(DISTINCT regexp_extract(line, '\\[([A-Z]+)\\]', 1))::BIGINT AS stages FROM l GROUP BY source""")
def log_status(spark, sf_dir):
    """What each source's log lines say of it."""
    line = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" ["), F.upper("event_type"), F.lit("] run "), F.col("event_id").cast("string"))
    l = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), line.alias("line"))
    has = lambda m: F.max(F.col("line").contains(m).cast("int"))
    return l.groupBy("source").agg(F.count("*").alias("lines"), has("[PURCHASE]").alias("completed"), has("[ERROR]").alias("failed"), F.countDistinct(F.regexp_extract("line", r"\[([A-Z]+)\]", 1)).alias("stages"))


@query()
def normalize_nfkc(spark, sf_dir):
    """Normalisation with compatibility composition, which neither engine has built in."""
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize(F.col("text"), unicode=True).alias("normalized"))


@query()
def embed_documents(spark, sf_dir):
    return search.hashed_vectors(table(spark, sf_dir, "documents")).select("doc_id", "embedding")


@query()
def ivf_search(spark, sf_dir):
    index, centres = ann.indexed(table(spark, sf_dir, "embeddings"), 20)
    return ann.probed(index, centres, question(spark, sf_dir), 10, 8)


@query()
def card_pipeline(spark, sf_dir):
    """All stages from headed cards to chunks with their context."""
    from ..operators import chunks

    rows, _ = pipeline.run(headed(spark, sf_dir))
    context = chunks.context(*[F.col(x) for x in ("source_file", "chapter_num", "chapter_title", "section_num", "section_title")])
    return rows.select("book", "page_num", "chunk_id", "tokens", F.concat(context, F.lit("\n\n"), "text").alias("full_text"))
