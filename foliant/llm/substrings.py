"""Substring dedup by level-wise doubling of repeated word windows.

Candidates start at an eighth of the length (7 words of 50), at the places that
content chooses: every full window holds one such anchor, and equal full windows
the same one.  Level by level, what repeats at one length alone is extended to
twice that length, forward or backward from the anchor, whichever the windows
hold (14, then 28 words); what comes once there is dropped.  Runs that are equal
as a whole are one candidate throughout.  Those that survive the last level are
compared at the full length, window by window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .repeats import candidates, classes, keyed, merged, runs
from .shared import kept_types, removed, written

WINDOW = 50
#: How often the shortest length is doubled.
DOUBLINGS = 3


def word_units(buf, offs):
    """A slice's word hashes, their offsets, the words joined by single spaces, and where words begin and end there."""
    starts, ends, cut = K.word_spans(buf, offs)
    joined, begin, end = K.join_words(buf, starts, ends)
    return K.word_hashes(buf, starts, ends), cut, joined.tobytes(), lambda a, b: (begin[a], end[b])


def lengths(window: int) -> list[int]:
    """The levels' lengths, the shortest first, ``window`` left out."""
    gram = -(-window // 2**DOUBLINGS)
    return [gram << k for k in range(DOUBLINGS) if k == 0 or gram << k < window]


def extended(open_: DataFrame, size: int) -> DataFrame:
    """The classes that share ``size`` symbols, forward or backward from the anchor, with another class; written."""
    sides = [f"f{size}", f"b{size}"]
    held = open_.select("key", F.inline(F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("h")) for i, c in enumerate(sides)])))
    again = written(held.where("h >= 0").groupBy("key", "side", "h").agg(F.count("*").alias("c")).where("c > 1").drop("c"), "level")
    for i, c in enumerate(sides):
        own = again.where(F.col("side") == i).select("key", F.col("h").alias(c), F.lit(True).alias(f"again{i}"))
        open_ = open_.join(own, ["key", c], "left")
    out = written(open_.where("again0 or again1").drop("again0", "again1"), "open")
    removed(out.sparkSession, again)
    return out


def windows_of(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """(s1, s2, doc, step, h1, h2): every window of the asked runs, by 128 bits of hash of its words."""
    wanted = asked.groupBy("doc", "uid").agg(F.collect_list(F.struct("s1", "s2", "lo", "hi")).alias("runs"))
    texts = docs.select("uid", "doc", "text").join(wanted, ["doc", "uid"]).select("doc", "text", "runs")

    def run(batches):
        for batch in batches:
            asked_ = batch.column(2)
            for a, b, buf, offs in K.slices(batch.column(1)):
                _, cut, raw, spans = word_units(buf, offs)
                part = asked_.slice(a, b - a)
                flat = part.flatten()
                s1, s2, lo, hi = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                owner = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
                size = (hi - lo + 1).astype(np.int64)
                for x in range(0, len(size), 4096):
                    own = size[x : x + 4096]
                    step = K.ragged(np.zeros(len(own), np.int64), own)
                    r = np.repeat(np.arange(x, x + len(own)), own)
                    start = (lo + cut[owner])[r] + step
                    h1, h2 = K.digests(raw, *spans(start, start + window - 1))
                    yield pa.RecordBatch.from_arrays([pa.array(s1[r]), pa.array(s2[r]), batch.column(0).take(pa.array(owner[r] + a)), pa.array(step.astype(np.int32)), pa.array(h1), pa.array(h2)], ["s1", "s2", "doc", "step", "h1", "h2"])

    return texts.mapInArrow(run, "s1 long, s2 long, doc long, step int, h1 long, h2 long")


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, uid, spans): word spans to remove, for each document that has any; written."""
    spark = docs.sparkSession
    gram, *levels = lengths(window)
    found = candidates(runs(docs, word_units, window, gram, tuple(levels)))
    every = classes(found, *(f"{side}{n}" for n in levels for side in "fb"))
    shared = every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    open_ = written(every.join(shared, "key", "left_semi"), "open")
    done = [found, every]
    for size in levels:
        done.append(open_)
        open_ = extended(open_, size)
    # a run that begins in an earlier document goes whole
    least = every.where("n > 1").select("s1", "s2", F.col("doc").alias("least"))
    whole = found.join(least, ["s1", "s2"]).where("least < doc").select("doc", "uid", F.col("lo").alias("start"), (F.col("hi") + window).alias("end"))
    # the least document of a class is held against other classes, window by window
    windows = written(windows_of(docs, open_, window), "windows")
    first = written(windows.groupBy("h1", "h2").agg(F.min("doc").alias("earliest"), F.max("doc").alias("latest")).where("earliest < latest").drop("latest"), "earliest")
    bad = written(windows.join(first, ["h1", "h2"]).where("earliest < doc").groupBy("s1", "s2", "doc").agg(F.collect_set("step").alias("steps")), "bad")
    steps = found.join(bad, ["s1", "s2", "doc"]).select("doc", "uid", "lo", F.explode("steps").alias("step"))
    single = steps.select("doc", "uid", (F.col("lo") + F.col("step")).alias("start"), (F.col("lo") + F.col("step") + window).alias("end"))
    out = written(whole.union(single).groupBy("doc", "uid").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    removed(spark, *done, open_, windows, first, bad)
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, n_removed, kept): kept holds the kept words, joined by one space (or their digest).  ``carry`` passes columns through, as k_<name>.

    A word goes if a window of ``window`` words that covers it also starts in a
    document with a smaller id.  Null ids count as larger than any other, null
    texts as empty; repeated rows of one id do not remove each other.
    """
    rows = keyed(docs, id_col, text_col, carry)
    spans = removals(rows, window)

    def run(batches):
        for batch in batches:
            marks = batch.column(2)
            for a, b, buf, offs in K.slices(batch.column(1)):
                starts, ends, cut = K.word_spans(buf, offs)
                keep = np.ones(len(starts), bool)
                for i, own in enumerate(marks.slice(a, b - a).to_pylist()):
                    if own:
                        for x, y in zip(*merged(np.array([s["start"] for s in own]), np.array([s["end"] for s in own]))):
                            keep[cut[i] + x : cut[i] + y] = False
                total = np.concatenate([[0], np.cumsum(keep)])[cut]
                left, at, to = K.join_words(buf, starts[keep], ends[keep])
                raw = left.tobytes()
                begin, end = np.append(at, len(raw)), np.append(0, to)
                out = [raw[begin[x] : end[y]] if y > x else b"" for x, y in zip(total[:-1].tolist(), total[1:].tolist())]
                out = [hashlib.sha256(x).hexdigest() for x in out] if digest else [x.decode() for x in out]
                n = np.diff(cut)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n), pa.array(n - np.diff(total)), pa.array(out, pa.string()), *(c[a:b] for c in batch.columns[3:])], ["id", "n_words", "n_removed", "kept", *batch.schema.names[3:]])

    joined = rows.join(spans, ["doc", "uid"], "left").select("id", "text", "spans", *[f"k_{c}" for c in carry])
    return joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string" + kept_types(joined, 3))
