"""Extractive summaries of cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import counts
from ..functions import text as T

WEIGHTS = {"position": 0.1, "length": 0.1, "digit": 0.05, "colon": 0.03}
LEVELS = {"l1": (3, 300), "l2": (6, 900)}


def words(c):
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit("[A-Za-zА-Яа-я0-9]{3,}"), 0), lambda w: ~T.is_stop_word(w))


def word_frequencies(cards: DataFrame, key: str = "doc_id", text: str = "segment") -> DataFrame:
    """(key, word, n, frequency): counts in a card and their share of the largest."""
    n = cards.select(key, F.explode(words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    return n.withColumn("frequency", F.col("n") / F.max("n").over(Window.partitionBy(key)))


def _scored(cards: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, scored): an array of (i, sentence, score) of each text's sentences that have words.

    Mean frequencies come from whole numbers (sum of counts, count, largest count), so that the order of addition cannot show.
    """
    rows = cards.select(key, F.col(text).alias("text"), T.summary_sentences(F.col(text)).alias("every"))
    rows = rows.withColumn("found", counts.sentence_sums(words(F.col("text")), F.transform("every", words)))
    every = F.col("every")

    def score(i):
        s, sums = F.get(every, i), F.get(F.col("found.sums"), i)
        value = (
            sums["total"] / (sums["n"] * F.col("found.top"))
            + (F.size(every) - i) / F.size(every) * WEIGHTS["position"]
            + F.least(F.lit(1.0), F.lit(100.0) / (F.length(s) + 1)) * WEIGHTS["length"]
            + F.when(s.rlike("[0-9]"), WEIGHTS["digit"]).otherwise(0.0)
            + F.when(s.contains(":"), WEIGHTS["colon"]).otherwise(0.0)
        )
        return F.struct(i.alias("i"), s.alias("sentence"), F.when(sums["n"] > 0, F.round(value, 9)).alias("score"))

    places = F.when(F.size(every) > 0, F.sequence(F.lit(0), F.size(every) - 1))
    return rows.select(key, "text", F.filter(F.transform(places, score), lambda x: x["score"].isNotNull()).alias("scored"))


def sentence_scores(cards: DataFrame, key: str = "doc_id", text: str = "segment") -> DataFrame:
    """(key, i, sentence, score): mean word frequency plus what place, length, digits and colons add.

    ``inline_outer``, as before an ``inline`` Spark puts a filter on the array's size, which it pushes below the counts: there
    the array is worked out once more, with its sentences split and counted anew for each sentence.
    """
    return _scored(cards, key, text).select(key, F.inline_outer("scored")).where("i is not null")


def summaries(cards: DataFrame, level: str = "l1", key: str = "doc_id", text: str = "segment") -> DataFrame:
    """(key, summary): the best sentences in their order, cut at a word; without sentences, the text's beginning.  Nothing leaves its row."""
    k, limit = LEVELS[level]
    ranked = F.array_sort(F.transform("scored", lambda x: F.struct((-x["score"]).alias("down"), x["i"].alias("i"), x["sentence"].alias("sentence"))))
    best = F.array_sort(F.transform(F.slice(ranked, 1, k), lambda x: F.struct(x["i"].alias("i"), x["sentence"].alias("sentence"))))
    s = F.when(F.size("scored") > 0, F.array_join(F.transform(best, lambda x: x["sentence"]), " "))
    rows = _scored(cards.where(F.length(T.strip(F.col(text))) >= 50), key, text).withColumn("s", s)
    cut = F.concat(F.regexp_replace(F.regexp_replace(F.substring("s", 1, limit), " [^ ]*$", ""), "[.,;:\\-]+$", ""), F.lit("..."))
    short = F.when(F.length("s") > limit, cut).otherwise(F.col("s"))
    return rows.select(key, F.coalesce(short, F.substring(T.strip(F.col("text")), 1, LEVELS["l1"][1])).alias("summary"))


def audit(cards: DataFrame, key: str = "doc_id", text: str = "segment") -> DataFrame:
    s = cards.join(summaries(cards, "l1", key, text), key, "left")
    n = F.length("summary")
    ratio = F.when(n > 0, F.length(text) / n)
    return s.groupBy("book").agg(F.count("*").alias("total_pages"), F.count("summary").alias("summarized"), F.round(F.count("summary") / F.count("*"), 6).alias("coverage"), F.round(F.avg(n), 6).alias("avg_length"), F.round(F.avg(ratio), 2).alias("avg_ratio"))
