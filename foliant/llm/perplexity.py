"""Quality rules: base counts and n-gram perplexity bands.

A modified Kneser-Ney model of characters, one for each language, is counted by
Spark over all documents.  Every n-gram is kept, as a hash of 63 bits, so the
model grows with the different n-grams of the corpus.  The tables are sorted
arrays of hashes with probabilities and back-off weights beside them, looked up
by binary search, once for each different n-gram of a slice.

Bands are language-specific: the median of log perplexity over the language's
documents, less and plus ``BAND`` times the larger distance from the median to a
quartile, from an exact histogram over all documents that pass the base rules.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .shared import bounded, kept_types, removed, written

ORDER = 3
BINS, BIN = 16_384, 1 / 1024
LOW, HIGH, BAND = 0.25, 0.75, 8.0
SHORT = 300
#: Bytes of texts that a worker counts or scores at once, or one text: each code point is a dozen numbers of eight bytes meanwhile.
SLICE_BYTES = 1 << 18
#: No code point costs more than this: one identifier, number or foreign line does not condemn a text.
MOST_LOSS = 4.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
U64 = np.uint64


# ---------------------------------------------------------------- base counts
def base_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document."""
    n = len(offs) - 1
    starts, ends, cut = K.word_spans(buf, offs)
    sums = lambda flags, at: np.concatenate([[0], np.cumsum(flags)])[at]
    chars = sums((buf & 0xC0) != 0x80, np.concatenate([starts, ends]))
    per_word = chars[len(starts) :] - chars[: len(starts)]
    hashes = K.word_hashes(buf, starts, ends)
    return {
        "n_words": np.diff(cut),
        "word_chars": np.diff(sums(per_word, cut)),
        "n_symbols": np.diff(sums(SYMBOLS[buf], offs)),
        "n_dup_lines": _dup_lines(buf, offs, starts, n),
        "n_repeat_words": _repeat_words(hashes, cut, 5),
    }


def _dup_lines(buf, offs, starts, n):
    """Lines with a word that equal an earlier line of their document."""
    breaks = np.flatnonzero(buf == 0x0A)
    begin = np.union1d(offs[:-1], breaks + 1)
    begin = begin[begin < len(buf)]
    if not len(begin):
        return np.zeros(n, np.int64)
    end = np.append(begin[1:], len(buf))
    end = np.where((end > begin) & (buf[np.maximum(end - 1, 0)] == 0x0A), end - 1, end)
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    doc = np.searchsorted(offs, begin, "right") - 1
    begin, end, doc = begin[worded], end[worded], doc[worded]
    lines = K.word_hashes(buf, begin, end)
    order = np.lexsort((lines, doc))
    again = np.zeros(len(order), bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][again], minlength=n)


def _repeat_words(hashes, cut, size):
    """Words inside windows of ``size`` words that the document holds twice or more, the first included."""
    n, m = len(cut) - 1, len(hashes)
    if m < size:
        return np.zeros(n, np.int64)
    doc = K.doc_of(cut, m)
    at = np.flatnonzero(doc[: m - size + 1] == doc[size - 1 :])
    windows = K.chained(hashes, at, size)
    order = np.lexsort((windows, doc[at]))
    same = (windows[order][1:] == windows[order][:-1]) & (doc[at][order][1:] == doc[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(m + 1, np.int64)
    edge[at[twice]] += 1
    np.subtract.at(edge, at[twice] + size, 1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)


# ---------------------------------------------------------------- the model
def _folded(points: np.ndarray) -> np.ndarray:
    """White space and controls as a space, digits as one digit."""
    points = np.where(points < 33, 32, points)
    return np.where((points >= 48) & (points <= 57), 48, points)


def _points(buf: np.ndarray, offs: np.ndarray):
    """Code points, white space as a space, a start mark before each document; document offsets."""
    points = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
    cut = np.searchsorted(np.flatnonzero((buf & 0xC0) != 0x80), offs)
    out = np.zeros(len(points) + len(offs) - 1, np.uint32)
    out[np.arange(len(points)) + K.doc_of(cut, len(points)) + 1] = _folded(points)
    return out, cut + np.arange(len(cut))


def grams(points: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """Per order 1..ORDER, the hash of the n-gram that ends at each code point; -1 where it would leave the document."""
    since = np.arange(len(points)) - np.repeat(cut[:-1], np.diff(cut))
    out, rolled = [], np.zeros(len(points), U64)
    for n in range(1, ORDER + 1):
        head = np.zeros(len(points), U64)
        head[n - 1 :] = points[: len(points) - n + 1]
        rolled = rolled * U64(0x9E3779B97F4A7C15) + head + U64(n)
        # 63 bits of a mixed hash; the n-gram reads backwards, so order n extends order n - 1 to the left
        out.append(np.where(since >= n - 1, (K.mix(rolled) >> U64(1)).astype(np.int64), -1))
    return out


def _contexts(found: list[np.ndarray], n: int) -> np.ndarray:
    """The hash of the first n - 1 code points of each n-gram: the shorter gram one place before."""
    before = np.full(len(found[0]), -1, np.int64)
    before[1:] = found[n - 2][:-1]
    return before


def _keys(model: np.ndarray, h: np.ndarray) -> np.ndarray:
    """What a model's n-gram is sorted and found by."""
    return K.mix(model.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15) ^ h.view(U64))


def _kinds(keys: np.ndarray):
    """Which of the different keys each one is, and where each of those comes first."""
    codes, kinds = pd.factorize(keys)
    first = np.zeros(len(kinds), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


def model_name(lang) -> F.Column:
    """A language's model: one for each language, the null language and '' among them, by the language's 64-bit hash."""
    return F.when(lang.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(lang.cast("string")))


def _counts(batches):
    """The n-grams of (model, text) batches with their counts, one row for each in a slice."""
    for batch in batches:
        models = batch.column(0).to_numpy()
        for a, b, buf, offs in K.slices(batch.column(1), SLICE_BYTES):
            points, cut = _points(buf, offs)
            model = np.repeat(models[a:b], np.diff(cut))
            found = grams(points, cut)
            for n in range(1, ORDER + 1):
                h = found[n - 1]
                context = _contexts(found, n) if n > 1 else np.zeros(len(h), np.int64)
                suffix = found[n - 2] if n > 1 else np.zeros(len(h), np.int64)
                ok = np.flatnonzero(h >= 0)
                codes, first = _kinds(_keys(model[ok], h[ok]))
                at = ok[first]
                columns = (model[at], np.full(len(at), n), h[at], context[at], suffix[at], np.bincount(codes, minlength=len(at)))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["model", "n", "h", "context", "suffix", "c"])


def counted(docs: DataFrame) -> DataFrame:
    """(model, n, h, context, suffix, c) of all n-grams of ``docs`` (model, text), one row for each."""
    rows = docs.mapInArrow(_counts, "model long, n long, h long, context long, suffix long, c long")
    return rows.groupBy("model", "n", "h").agg(F.min("context").alias("context"), F.min("suffix").alias("suffix"), F.sum("c").alias("c"))


def _discounts(c: np.ndarray) -> np.ndarray:
    """The three discounts of modified Kneser-Ney for counts of one, two, and three or more."""
    n1, n2, n3, n4 = (max(1, int((c == k).sum())) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.05, 0.95, 1.9, 2.8]) * [0, 1, 1, 1]


class Model:
    """Arrays sorted by the key of (model, n-gram), one set for each order.

    ``p[n]``: the discounted share of each n-gram of order n in its context;
    ``g[n]``: the weight that it leaves, as a context, to the next lower order.
    ``base``: what each of ``models`` leaves to an unknown code point.
    """

    def __init__(self, table: pd.DataFrame):
        parts = {n: [] for n in range(1, ORDER + 1)}
        names, base = [], []
        for m, own in table.groupby("model"):
            rows = {n: own[own["n"] == n].sort_values("h") for n in range(1, ORDER + 1)}
            h = {n: rows[n]["h"].to_numpy(np.int64) for n in rows}
            g = {n: np.ones(len(h[n])) for n in h}
            for n in range(1, ORDER + 1):
                if n == ORDER:
                    c = rows[n]["c"].to_numpy()
                else:  # how many different code points stand before the n-gram
                    c = np.bincount(np.searchsorted(h[n], rows[n + 1]["suffix"].to_numpy()), minlength=len(h[n]))
                context = np.searchsorted(h[n - 1], rows[n]["context"].to_numpy()) if n > 1 else np.zeros(len(c), np.int64)
                d = _discounts(c)[np.minimum(c, 3)]
                total = np.bincount(context, c, minlength=len(h[n - 1]) if n > 1 else 1)
                left = np.bincount(context, d, minlength=len(total))
                with np.errstate(divide="ignore", invalid="ignore"):
                    p = np.where(c > 0, (c - d) / total[context], 0)
                    rest = np.where(total > 0, left / total, 1)
                if n > 1:
                    g[n - 1] = rest
                else:
                    names.append(m)
                    base.append(max(1e-7, rest[0] / (len(c) + 1)))
                parts[n].append((_keys(np.full(len(c), m), h[n]), p, g, n))
        self.models, self.base = np.array(names, np.int64), np.array(base)
        self.keys, self.p, self.g = {}, {}, {}
        for n, own in parts.items():
            keys = np.concatenate([np.zeros(0, U64), *(k for k, _, _, _ in own)])
            order = np.argsort(keys)
            self.keys[n] = keys[order]
            self.p[n] = np.concatenate([np.zeros(0), *(p for _, p, _, _ in own)])[order].astype(np.float32)
            self.g[n] = np.concatenate([np.zeros(0), *(g[n] for _, _, g, n in own)])[order].astype(np.float32)

    def _of(self, values: dict, n: int, model: np.ndarray, h: np.ndarray, unknown: float) -> np.ndarray:
        """The values of n-grams of order n, by binary search."""
        if not len(self.keys[n]):
            return np.full(len(h), unknown)
        keys = _keys(model, h)
        at = np.minimum(np.searchsorted(self.keys[n], keys), len(self.keys[n]) - 1)
        return np.where(self.keys[n][at] == keys, values[n][at], unknown)

    def scores(self, buf: np.ndarray, offs: np.ndarray, models: np.ndarray):
        """(log perplexity, code points) of each document; a document without text: zero."""
        points, cut = _points(buf, offs)
        found = grams(points, cut)
        longest = found[0]
        for h in found[1:]:
            longest = np.where(h >= 0, h, longest)
        model = np.repeat(models, np.diff(cut)).astype(np.int64)
        codes, first = _kinds(_keys(model, longest))  # the longest n-gram decides what a code point costs
        own = model[first]
        p = self._of(self.p, 1, own, found[0][first], 0) + self.base[np.searchsorted(self.models, own)]
        for n in range(2, ORDER + 1):
            h, context = found[n - 1][first], _contexts(found, n)[first]
            p = np.where(h >= 0, self._of(self.p, n, own, h, 0) + self._of(self.g, n - 1, own, context, 1) * p, p)
        logs = np.minimum(-np.log(p), MOST_LOSS)[codes]
        logs[cut[:-1]] = 0  # the start mark itself
        n = np.diff(cut) - 1
        sums = np.add.reduceat(logs, cut[:-1]) if len(n) else np.zeros(0)
        return np.where(n > 0, sums / np.maximum(n, 1), 0.0), n


# ---------------------------------------------------------------- the operator
def _scores(batches, model: Model):
    """The base counts and log perplexities of (model, text, id, carried columns) batches."""
    for batch in batches:
        models = batch.column(0).to_numpy()
        for a, b, buf, offs in K.slices(batch.column(1), SLICE_BYTES):
            base = base_counts(buf, offs)
            log_ppl, n = model.scores(buf, offs, models[a:b])
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            columns = [batch.column(2)[a:b], batch.column(0)[a:b], *(pa.array(v.astype(np.int64)) for v in base.values()), pa.array(failed), pa.array(log_ppl), pa.array(n), *(c[a:b] for c in batch.columns[3:])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "model", *base, "base_failed", "log_ppl", "n_points", *batch.schema.names[3:]])


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, model, the base counts, base_failed, log_ppl, n_points) of every row, written to the shared folder; then ``carry``, as k_<name>."""
    spark = docs.sparkSession
    bounded(spark)
    frame = docs.select(model_name(F.col(lang_col)).alias("model"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(f"k_{c}") for c in carry])
    model = spark.sparkContext.broadcast(Model(counted(frame.select("model", "text")).toArrow().to_pandas()))

    def run(batches):
        yield from _scores(batches, model.value)

    schema = "id long, model long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, log_ppl double, n_points long"
    return written(frame.mapInArrow(run, schema + kept_types(frame, 3)), "scores")


def bands(scores: DataFrame) -> DataFrame:
    """(of, low, high): a model and the lowest and highest log perplexity that it keeps, from exact counts per bin of ``BIN``."""
    sound = scores.where(~F.col("base_failed"))
    bins = sound.groupBy(F.col("model").alias("of"), F.least(F.floor(F.col("log_ppl") / BIN), F.lit(BINS)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("of")
    bins = bins.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("all", F.sum("n").over(whole))
    at = lambda q: (F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) + 0.5) * BIN
    found = bins.groupBy("of").agg(at(LOW).alias("quarter"), at(0.5).alias("middle"), at(HIGH).alias("three"))
    half = BAND * F.greatest(F.col("middle") - F.col("quarter"), F.col("three") - F.col("middle"), F.lit(BIN))
    return written(found.select("of", (F.col("middle") - half).alias("low"), (F.col("middle") + half).alias("high")), "bands")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, base counts, base_failed, log_ppl, kept) of every row, and the columns named in ``carry``, as k_<name>.

    A document is kept if the base rules pass and its log perplexity lies in its
    language's band, which is widened for short texts, whose means scatter more:
    by ``sqrt(1 + SHORT / code points)``.  Null and empty texts fail the base
    rules; a null language is a language; repeated rows get the same verdict.
    """
    scores = scored(docs, id_col, text_col, lang_col, carry)
    low, high = F.col("low"), F.col("high")
    middle, half = (low + high) / 2, (high - low) / 2
    wide = half * F.sqrt(1 + F.lit(float(SHORT)) / F.greatest("n_points", F.lit(1)))
    inside = F.abs(F.col("log_ppl") - middle) <= wide
    found = scores.join(bands(scores), F.col("model") == F.col("of"), "left")
    return found.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))).drop("model", "n_points", "of", "low", "high")
