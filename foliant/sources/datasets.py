"""Dataset files: reading and writing the marked text format, merging, manifests, tables in cards."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

BEGIN, END = "===DATASET_BEGIN===", "===DATASET_END==="
RESERVED = ["__header__", "__audit__", "__footer__"]
#: Stands in a footer for the digest until the lines before it are hashed.
UNKNOWN = "0" * 64
CARD = "segment_id string, page_num int, segment string, source_file string"


def written(cards: DataFrame, folder: str, version: str = "2.0.0") -> None:
    """One text file set per book: header, cards, audit and footer as JSON lines between the markers.

    Rows are ordered by (book, rank, segment) over partitions, so a book's lines follow each other.  The footer holds
    the SHA-256 of all lines from header to audit, each with its newline, taken in the pass that writes them.
    """
    line = F.to_json(F.struct("segment_id", "page_num", "segment", "source_file"))
    body = cards.select("book", F.lit(2).alias("rank"), "segment_id", line.alias("value"))
    sums = cards.groupBy("book").agg(F.count("*").alias("n"))
    tagged = lambda name, **more: F.to_json(F.struct(F.lit(name).alias("segment_id"), F.col("book"), *[v.alias(k) for k, v in more.items()]))
    parts = [
        sums.select("book", F.lit(0).alias("rank"), F.lit("").alias("segment_id"), F.lit(BEGIN).alias("value")),
        sums.select("book", F.lit(1), F.lit(""), tagged(RESERVED[0], version=F.lit(version), total_cards=F.col("n"))),
        sums.select("book", F.lit(3), F.lit(""), tagged(RESERVED[1], total_cards=F.col("n"))),
        sums.select("book", F.lit(4), F.lit(""), tagged(RESERVED[2], manifest_sha256=F.lit(UNKNOWN), card_count=F.col("n"))),
        sums.select("book", F.lit(5), F.lit(""), F.lit(END)),
    ]
    rows = reduce(DataFrame.union, parts, body).repartition("book").sortWithinPartitions("book", "rank", "segment_id").select("book", "value")
    rows.mapInArrow(_sealed, "book string, value string").write.partitionBy("book").text(folder)


def _sealed(batches):
    """The lines of whole books in their order, with the digest of those before the footer put into it; holds one batch."""
    digest = hashlib.sha256()
    for batch in batches:
        values = batch.column(1).to_pylist()
        for i, value in enumerate(values):
            if value == BEGIN:
                digest = hashlib.sha256()
            elif value.startswith('{"segment_id":"%s"' % RESERVED[2]):
                values[i] = value.replace(UNKNOWN, digest.hexdigest(), 1)
            elif value != END:
                digest.update(value.encode() + b"\n")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string())], ["book", "value"])


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """(book, lines, stated, found, intact): each file's digest as its footer states it and as its lines give it.

    A file without a footer has no stated digest, and is not intact.  Lines are hashed in the file's order, one batch at a time.
    """
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.option("lineSep", "\n").text(folder).select("book", *where, "value").withColumn("at", F.monotonically_increasing_id())

    def run(batches):
        now, digest, n, stated = None, None, 0, None
        for batch in batches:
            for book, file, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (book, file) != now:
                    if now is not None:
                        yield _stated(now[0], n, stated, digest)
                    now, digest, n, stated = (book, file), hashlib.sha256(), 0, None
                if value in (BEGIN, END):
                    continue
                if value.startswith('{"segment_id":"%s"' % RESERVED[2]):
                    stated = value.partition('"manifest_sha256":"')[2][:64]
                else:
                    digest.update(value.encode() + b"\n")
                    n += 1
        if now is not None:
            yield _stated(now[0], n, stated, digest)

    ordered = lines.repartition("book", "file").sortWithinPartitions("book", "file", "block", "at").select("book", "file", "value")
    out = ordered.mapInArrow(run, "book string, lines long, stated string, found string")
    return out.withColumn("intact", F.coalesce(F.col("stated") == F.col("found"), F.lit(False)))


def _stated(book, n, stated, digest):
    return pa.RecordBatch.from_pydict({"book": pa.array([book], pa.string()), "lines": pa.array([n], pa.int64()), "stated": pa.array([stated], pa.string()), "found": pa.array([digest.hexdigest()], pa.string())})


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(book, kind, segment_id, page_num, segment, source_file): lines are cut at newlines only; lines that are no JSON get kind ``bad``."""
    lines = spark.read.option("lineSep", "\n").text(folder).where(~F.col("value").isin(BEGIN, END))
    parsed = lines.select("book", F.from_json("value", CARD).alias("c"))
    kind = F.when(F.col("c.segment_id").isNull(), "bad").when(F.col("c.segment_id").isin(RESERVED), F.regexp_replace("c.segment_id", "_", "")).otherwise("card")
    return parsed.select("book", kind.alias("kind"), "c.*")


def merged(parts: list[DataFrame]) -> DataFrame:
    """All cards of many datasets, each marked with where it came from."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("merged_from", F.col("book")) for p in parts])


def manifests(cards: DataFrame) -> DataFrame:
    """A hash of each book's card digests in order; a card adds some seventy bytes to what is gathered."""
    line = F.concat("segment_id", F.lit(" "), F.sha2(F.encode("segment", "UTF-8"), 256))
    listed = F.array_join(F.array_sort(F.collect_list(line)), "\n")
    return cards.groupBy("book").agg(F.count("*").alias("cards"), F.sha2(F.concat(listed, F.lit("\n")), 256).alias("manifest"))


def usable_tables(tables: DataFrame, rows: int = 2, columns: int = 2) -> DataFrame:
    """Tables of enough rows and columns, cells stripped."""
    cells = F.transform("data", lambda r: F.transform(r, T.strip))
    kept = tables.where((F.size("data") >= rows) & (F.size(F.get("data", F.lit(0))) >= columns))
    return kept.withColumns({"data": cells, "table_id": F.lit("table_1"), "n_rows": F.size("data"), "n_cols": F.size(F.get("data", F.lit(0)))})


def markdown(data: Column) -> Column:
    """A Markdown table; rows are filled or cut to the header's width."""
    head = F.get(data, F.lit(0))
    width = F.size(head)
    row = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    fitted = lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), 1, width)
    body = F.transform(F.slice(data, 2, F.size(data)), lambda r: row(fitted(r)))
    return F.concat_ws("\n", row(head), row(F.array_repeat(F.lit("---"), width)), F.array_join(body, "\n"))
