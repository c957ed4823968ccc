"""Repeated windows of a fixed number of symbols, found by content-chosen anchors.

Shared by substring dedup (symbols: words) and suffix-array dedup (symbols:
bytes).  Every window has one anchor (see ``kernel.anchors``), so equal windows
meet under one anchor key.  Keys that come once are dropped by a count of bare
keys.  What is left is classed by ``s1, s2``, 128 bits of hash of all the bytes
that a run's windows cover: runs of a class are alike, so a class is decided
once, by its count or its least document, whatever its size.  Only where
*different* classes share an anchor key do windows have to be looked at, one
run for each class.

A row is known by (doc, uid): its id and 64 bits of hash of its text, so only
rows of one id (or without an id) with different texts rest on that hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import removed, written

LAST = 2**63 - 1
#: Symbols of one document that are anchored at a time.
BLOCK = 1 << 20


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(uid, id, doc, text), then ``carry``.  uid tells rows of one id with different texts apart; a null id sorts last."""
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.col(c).alias(f"k_{c}") for c in carry])
    return frame.select(F.xxhash64("text").alias("uid"), "id", F.coalesce("id", F.lit(LAST)).alias("doc"), "text", *[f"k_{c}" for c in carry])


def _blocks(symbols, cut, window):
    """(symbols, offsets, place of the first) of parts to anchor: all at once, or a long document block by block."""
    if len(cut) != 2 or len(symbols) <= BLOCK:
        yield symbols, cut, 0
        return
    for a in range(0, max(1, len(symbols) - window + 1), BLOCK):
        part = symbols[a : a + BLOCK + window - 1]
        yield part, np.array([0, len(part)]), a


def runs(docs: DataFrame, units, window: int, gram: int, levels: tuple[int, ...] = (), lift=np.asarray) -> DataFrame:
    """(uid, doc, key, s1, s2, lo, hi, at), then f<n> and b<n> for each level n, of every anchor run.

    lo, hi and the anchor's at are symbol places in the document; f and b are
    hashes of n symbols from the anchor forward and backward.  ``units(buf, offs)``
    gives a slice's symbols, their document offsets, the bytes that stand for
    them, and a function from the first and last symbols of spans to byte starts
    and ends; ``lift`` makes 64-bit hashes of a block's symbols.
    """
    names = ["uid", "doc", "key", "s1", "s2", "lo", "hi", "at", *(f"{side}{n}" for n in levels for side in "fb")]

    def run(batches):
        for batch in batches:
            for a, _, buf, offs in K.slices(batch.column(2)):
                symbols, cut, raw, spans = units(buf, offs)
                for part, own, base in _blocks(symbols, cut, window):
                    d, lo, hi, at, key, wider = K.anchors(lift(part), own, window, gram, levels)
                    s1, s2 = K.digests(raw, *spans(lo + base, hi + base + window - 1))
                    take = pa.array(d + a)
                    places = [pa.array((x + base - cut[d]).astype(np.int32)) for x in (lo, hi, at)]
                    columns = [batch.column(0).take(take), batch.column(1).take(take), pa.array(K.signed(key)), pa.array(s1), pa.array(s2), *places, *map(pa.array, wider)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    types = ["long"] * 5 + ["int"] * (len(names) - 5)
    return docs.select("uid", "doc", "text").mapInArrow(run, ", ".join(map(" ".join, zip(names, types))))


def candidates(runs_: DataFrame) -> DataFrame:
    """The runs whose anchor key comes more than once, by a count of bare keys; written."""
    spark = runs_.sparkSession
    every = written(runs_, "runs")
    again = written(every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "keys")
    out = written(every.join(again, "key", "left_semi").select(*every.columns), "candidates")
    removed(spark, every, again)
    return out


def classes(found: DataFrame, *more: str) -> DataFrame:
    """(key, s1, s2, n, doc, uid, lo, hi, at, more): one run, of the least document, for each class; written."""
    same = ["key", *more]  # equal contents have equal hashes
    one = found.groupBy("s1", "s2").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in same], F.min(F.struct("doc", "uid", "lo", "hi", "at")).alias("r"))
    return written(one.select("key", "s1", "s2", "n", "r.*", *more), "classes")


def merged(start: np.ndarray, end: np.ndarray):
    """The union of half-open spans, sorted and disjoint."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[head], end[np.append(head[1:], len(start)) - 1]


def flag_spans(flags: np.ndarray):
    """Half-open spans of consecutive True flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
