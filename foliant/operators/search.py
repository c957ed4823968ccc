"""Exact vector search, BM25, hybrid fusion, filters, query expansion and neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import SYNONYMS

K1, B, EPSILON = 1.5, 0.75, 0.25
SEMANTIC = 0.7


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column) -> Column:
    n = F.greatest(norm(a), F.lit(1e-12))
    return F.transform(a, lambda x: x.cast("double") / n)


def nearest(vectors: DataFrame, query: DataFrame, k: int, metric: str = "cosine", id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, score) of the k best rows; larger is better for either metric.

    ``query``: one row with the vector ``q``; it is one record, and so small to send.
    """
    v, q = F.col(vector), F.col("q")
    if metric == "cosine":
        score = dot(v, q) / F.greatest(norm(v) * norm(q), F.lit(1e-12))
    else:
        score = -F.sqrt(F.aggregate(F.zip_with(v, q, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))
    scored = vectors.crossJoin(F.broadcast(query.limit(1))).select(F.col(id_col).alias("id"), F.round(score, 6).alias("score"))
    return scored.orderBy(F.desc("score"), "id").limit(k)


def bm25(docs: DataFrame, terms: DataFrame, k: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score > 0) of the k best documents for the query's terms (repeats count); a negative idf becomes a share of the mean idf."""
    words = docs.select(F.col(id_col).alias("id"), F.coalesce(T.keyword_tokens(F.col(text)), F.array().cast("array<string>")).alias("w"))
    sizes = words.select("id", F.size("w").alias("size"))
    totals = sizes.agg(F.count("*").alias("docs"), F.avg("size").alias("mean_size"))
    tf = words.select("id", F.explode("w").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    idf = tf.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(totals)).select("term", F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    floor = idf.agg((EPSILON * F.avg("idf")).alias("floor"))
    asked = terms.groupBy("term").agg(F.count("*").alias("asked"))
    weights = asked.join(idf, "term").crossJoin(F.broadcast(floor)).select("term", "asked", F.when(F.col("idf") < 0, F.col("floor")).otherwise(F.col("idf")).alias("idf"))
    hit = tf.join(weights, "term").join(sizes, "id").crossJoin(F.broadcast(totals))
    part = F.col("asked") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / F.col("mean_size")))
    scored = hit.groupBy("id").agg(F.round(F.sum(part), 6).alias("score")).where("score > 0")
    return scored.orderBy(F.desc("score"), "id").limit(k)


def min_max(hits: DataFrame, name: str) -> DataFrame:
    """Scores of a result list (at most some 2k rows) to 0..1; a constant list is all ones."""
    ends = hits.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    s = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")))
    return hits.crossJoin(F.broadcast(ends)).select("id", s.alias(name))


def hybrid(semantic: DataFrame, keyword: DataFrame, weight: float = SEMANTIC) -> DataFrame:
    """(id, semantic, keyword, score): both lists' ids; a list that lacks an id gives it nothing."""
    j = min_max(semantic, "semantic").join(min_max(keyword, "keyword"), "id", "full_outer").na.fill(0.0, ["semantic", "keyword"])
    return j.withColumn("score", F.round(weight * F.col("semantic") + (1 - weight) * F.col("keyword"), 6))


def reciprocal_rank(lists: list[DataFrame], constant: int = 60) -> DataFrame:
    """(id, score): ranks of bounded result lists, fused."""
    out = None
    for hits in lists:
        r = hits.select("id", (F.lit(1.0) / (constant + F.row_number().over(Window.orderBy(F.desc("score"), "id")))).alias("part"))
        out = r if out is None else out.union(r)
    return out.groupBy("id").agg(F.round(F.sum("part"), 9).alias("score"))


def filtered(hits: DataFrame, min_score: float | None = None, pages: tuple[int, int] | None = None, overlap: dict | None = None, **equal) -> DataFrame:
    """Metadata filters, all of which must hold; they come after the cut to 2k, so fewer than k may stay.

    A list is any-of; a boolean takes an absent flag for false; ``overlap`` names array columns.
    """
    if min_score is not None:
        hits = hits.where(F.col("score") >= min_score)
    if pages is not None:
        hits = hits.where(F.col("page_num").between(*pages))
    for name, value in equal.items():
        if isinstance(value, bool):
            hits = hits.where(F.coalesce(F.col(name), F.lit(False)) == value)
        else:
            hits = hits.where(F.coalesce(F.col(name), F.lit("")).isin(value if isinstance(value, list) else [value]))
    for name, values in (overlap or {}).items():
        hits = hits.where(F.arrays_overlap(F.col(name), F.array(*[F.lit(v) for v in values])))
    return hits


def expand(query: str, most: int = 3, queries: int = 5) -> list[str]:
    """The query and what synonyms of terms inside it make of it."""
    low, out = query.lower(), [query]
    for term, others in SYNONYMS.items():
        out += [low.replace(term, o) for o in others[:most] if term in low and low.replace(term, o) != low]
    return out[:queries]


def expanded(queries: DataFrame, column: str = "text") -> DataFrame:
    """(…, n, query): the same over a table of queries."""
    low = F.lower(F.col(column))
    parts = [F.when(low.contains(t), F.replace(low, F.lit(t), F.lit(o))) for t, others in SYNONYMS.items() for o in others[:3]]
    more = F.filter(F.array_compact(F.array(*parts)), lambda q: q != low)
    return queries.select("*", F.posexplode(F.slice(F.concat(F.array(F.col(column)), more), 1, 5)).alias("n", "query"))


def merged(hits: DataFrame) -> DataFrame:
    """(id, score) from (query_no, id, score): the first query that finds an id gives its score."""
    r = F.row_number().over(Window.partitionBy("id").orderBy("query_no"))
    return hits.withColumn("r", r).where("r = 1").select("id", "score")


def neighbours(chunks: DataFrame, hits: DataFrame, n: int = 1, id_col: str = "doc_id", text: str = "text", key: str = "book") -> DataFrame:
    """Hits with the ids of the n chunks before and after them in their book."""
    order = Window.partitionBy(key).orderBy(id_col)
    around = chunks.select(id_col, F.collect_list(id_col).over(order.rowsBetween(-n, -1)).alias("before"), F.collect_list(id_col).over(order.rowsBetween(1, n)).alias("after"))
    return hits.join(around, hits["id"] == around[id_col]).select("id", "score", "before", "after")


def unified(chunks: DataFrame, id_col: str = "doc_id", key: str = "book") -> DataFrame:
    """Global ids over all books: a book's offset is the number of chunks in the books before it."""
    sizes = chunks.groupBy(key).agg(F.count("*").alias("size"))
    offset = F.coalesce(F.sum("size").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = sizes.select(F.col(key).alias("b"), offset.alias("range_start"), (offset + F.col("size")).alias("range_end"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(id_col)) - 1
    j = chunks.select(key, id_col, place.alias("place")).join(ranges, F.col(key) == F.col("b"))
    return j.select(key, id_col, (F.col("range_start") + F.col("place")).alias("global_id"), "range_start", "range_end")


def by_book(hits: DataFrame, books: int = 5, each: int = 3, key: str = "book") -> DataFrame:
    """Of a bounded list of hits, the best books and the best hits of each."""
    best = hits.groupBy(key).agg(F.max("score").alias("best")).orderBy(F.desc("best"), key).limit(books)
    r = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "id"))
    return hits.join(best, key).withColumn("rank", r).where(F.col("rank") <= each)


def hashed_vectors(docs: DataFrame, dim: int = 64, text: str = "text") -> DataFrame:
    """A deterministic stand-in for an encoder: term counts hashed to ``dim`` places, normalised."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array

    t = HashingTF(inputCol="w", outputCol="tf", numFeatures=dim).transform(docs.withColumn("w", T.keyword_tokens(F.col(text))))
    return t.withColumn("embedding", normalized(vector_to_array("tf"))).drop("w", "tf")
