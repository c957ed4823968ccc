"""Word counts inside one row: a pass over its words in order, so long texts cost their length and nothing is exchanged."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

SUMS = StructType().add("top", LongType()).add("sums", ArrayType(StructType().add("n", LongType()).add("total", LongType())))
TERMS = ArrayType(StructType().add("term", StringType()).add("n", LongType()))


@F.pandas_udf(SUMS)
def sentence_sums(words: pd.Series, sentences: pd.Series) -> pd.DataFrame:
    """The largest count of a row's words, and for each of its sentences the words and the sum of their counts."""
    top, sums = [], []
    for own, parts in zip(words, sentences):
        count = Counter(() if own is None else own)
        top.append(max(count.values(), default=0))
        sums.append([{"n": len(p), "total": sum(count[w] for w in p)} for p in (() if parts is None else parts)])
    return pd.DataFrame({"top": top, "sums": sums})


@F.pandas_udf(TERMS)
def frequent(words: pd.Series, most: pd.Series) -> pd.Series:
    """The most frequent words of a row, the earlier first among equals; words that come once are left out."""
    return pd.Series([[{"term": w, "n": n} for w, n in Counter(() if own is None else own).most_common(k) if n > 1] for own, k in zip(words, most)], dtype=object)
