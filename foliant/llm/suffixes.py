"""Suffix-array dedup by column-wise multi-document construction.

A collection's Burrows-Wheeler order and common prefixes are built column by
column: each round puts one more symbol before the suffix of every text.  The
new order is the old one dealt out stably by the new symbols (the texts' next
BWT column), and a new common prefix is one more than the least old one between
the two suffixes.  Symbols come from a sequence of columns that is written once
and read once from end to end; orders and prefixes of the last round alone stay.
The columns of ``COLLECTION_TEXTS`` texts are a few megabytes, so they stay in
memory: a file of a task's own would lie on one machine.

The corpus is cut into collections by content.  A window of ``WINDOW`` bytes has
one anchor, equal windows the same one at the same place, so windows can be equal
only under one anchor key and in the same column.  Surroundings of anchors that
are equal as a whole are one class and need no construction.  The others' windows
are dealt out by their distance to the anchor, ``BIN`` neighbours together, and by
the bytes that all windows of such a bin hold (its core): a collection is what
shares a core, lined up on the anchor.  Where more than ``MOST_TEXTS`` different
texts share one, they are dealt out again by bins of half the width, which puts
the next columns of their context into the core, until the collection is small.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .repeats import candidates, classes, flag_spans, keyed, merged, runs
from .shared import removed, written

WINDOW, GRAM = 400, 32
BIN = 32
MOST_TEXTS = 2000
COLLECTION_TEXTS = 12_000
END = 0xFF  # never a byte of UTF-8
PIECE = "s1 long, s2 long, doc long, uid long, lo int, hi int, at int, n long, piece binary"
CORE = ["b", "c1", "c2"]


def byte_units(buf, offs):
    return buf, offs, buf.tobytes(), lambda a, b: (a, b + 1)


def range_least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of values[a+1 : b+1] for each pair a < b, by tables of doubling width."""
    out = values[b].copy()
    far = np.flatnonzero(b - a > 1)
    if not len(far):
        return out
    span = (b - a)[far]
    level = np.frexp(span)[1] - 1
    table = values
    for k in range(int(level.max()) + 1):
        here = level == k
        if here.any():
            i = far[here]
            out[i] = np.minimum(table[a[i] + 1], table[b[i] - (1 << k) + 1])
        table = np.minimum(table[: -(1 << k)], table[1 << k :])
    return out


def repeated(texts: list[np.ndarray], anchor: np.ndarray, first: np.ndarray, last: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For each text, flags of its windows that start at first..last and also start in another text of the collection.

    ``anchor``: the place in each text that is lined up.
    """
    m = len(texts)
    size = np.array([len(t) for t in texts])
    left, right = int(anchor.max(initial=0)), int((size - anchor).max(initial=0))
    flat = np.concatenate(texts) if m else np.zeros(0, np.uint8)
    begin = np.cumsum(size) - size
    out = [np.zeros(max(0, int(b) - int(a) + 1), bool) for a, b in zip(first, last)]
    row = np.arange(m)
    found_rows, found_columns = [], []
    columns = io.BytesIO()
    for c in range(right - 1, -left - 1, -1):
        at = anchor + c
        inside = (at >= 0) & (at < size)
        column = np.full(m, END, np.uint8)
        column[inside] = flat[(begin + at)[inside]]
        columns.write(column.tobytes())
    columns.seek(0)
    order, prefix = row, np.zeros(m, np.int32)
    for c in range(right - 1, -left - 1, -1):
        column = np.frombuffer(columns.read(m), np.uint8)
        symbol = column[order]
        deal = np.argsort(symbol, kind="stable")
        order = order[deal]
        symbol = symbol[deal]
        new = np.zeros(m, np.int32)
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] != END)) + 1
        new[same] = np.minimum(range_least(prefix, deal[same - 1], deal[same]) + 1, window)
        prefix = new
        if c <= 0:
            pair = np.flatnonzero(prefix >= window)
            if len(pair):
                hit = np.unique(np.concatenate([order[pair], order[pair - 1]]))
                at = anchor[hit] + c
                ok = (at >= first[hit]) & (at <= last[hit])
                found_rows.append(hit[ok])
                found_columns.append((at - first[hit])[ok])
    if found_rows:
        for i, k in zip(np.concatenate(found_rows).tolist(), np.concatenate(found_columns).tolist()):
            out[i][k] = True
    return out


def _table(types: str, *columns) -> pa.RecordBatch:
    """A batch of the named types: "name type, ..."."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in types.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def _surroundings(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """What the asked runs' windows cover, as ``PIECE``: n rows of the class, and the bytes from lo to the end of the window at hi."""
    wanted = asked.groupBy("doc", "uid").agg(F.collect_list(F.struct("s1", "s2", "lo", "hi", "at", "n")).alias("runs"))

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for doc, uid, text, own in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), batch.column(3).to_pylist()):
                raw = text.as_py().encode()
                for r in own:
                    rows.append((r["s1"], r["s2"], doc, uid, r["lo"], r["hi"], r["at"], r["n"], raw[r["lo"] : r["hi"] + window]))
                    held += len(rows[-1][-1])
                if held > K.SLICE_BYTES:
                    yield _table(PIECE, *zip(*rows))
                    rows, held = [], 0
            if rows:
                yield _table(PIECE, *zip(*rows))

    texts = docs.select("uid", "doc", "text").join(wanted, ["doc", "uid"]).select("doc", "uid", "text", "runs")
    return texts.mapInArrow(run, PIECE)


def _bins(lo, hi, at, size):
    """Row, bin, first and last window start of every bin of ``size`` window places that a row has windows in."""
    low, high = (at - hi) // size, (at - lo) // size
    row = np.repeat(np.arange(len(lo)), high - low + 1)
    b = K.ragged(low, high - low + 1)
    last = at[row] - b * size
    return row, b, np.maximum(lo[row], last - size + 1), np.minimum(hi[row], last)


def _binned(pieces: DataFrame, size: int, window: int) -> DataFrame:
    """(s1, s2, doc, uid, n, b, c1, c2, p1, p2, start, count): every bin of a piece, with digests of its core and of all that its windows cover."""
    types = "s1 long, s2 long, doc long, uid long, n long, b int, c1 long, c2 long, p1 long, p2 long, start int, count int"

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lo, hi, at = (batch.column(i).to_numpy().astype(np.int64) for i in (4, 5, 6))
            texts = batch.column(8).cast(pa.large_binary())
            place = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts)]
            raw = texts.buffers()[2].to_pybytes()
            row, b, x, y = _bins(lo, hi, at, size)
            base = place[row] - lo[row]
            core = base + at[row] - b * size
            c, p = K.digests(raw, core, core - size + 1 + window), K.digests(raw, base + x, base + y + window)
            take = pa.array(row)
            yield _table(types, *(batch.column(i).take(take) for i in (0, 1, 2, 3, 7)), b, *c, *p, x, y - x + 1)

    return pieces.mapInArrow(run, types)


def _parts(pieces: DataFrame, kinds: DataFrame, size: int, window: int) -> DataFrame:
    """``PIECE`` of each of ``kinds`` (CORE, p1, p2, m, s1, s2, hot), with its core and whether that is hot."""
    types = "b int, c1 long, c2 long, hot int, " + PIECE
    wanted = kinds.groupBy("s1", "s2").agg(F.collect_list(F.struct(*CORE, "p1", "p2", "m", "hot")).alias("bins"))

    def run(batches):
        for batch in batches:
            rows = []
            for doc, uid, lo, hi, at, text, bins in zip(*(c.to_pylist() for c in batch.columns)):
                for w in bins:
                    last = at - w["b"] * size
                    x, y = max(lo, last - size + 1), min(hi, last)
                    rows.append((w["b"], w["c1"], w["c2"], w["hot"], w["p1"], w["p2"], doc, uid, x, y, at, w["m"], text[x - lo : y - lo + window]))
                if len(rows) > 4096:
                    yield _table(types, *zip(*rows))
                    rows = []
            if rows:
                yield _table(types, *zip(*rows))

    return pieces.join(wanted, ["s1", "s2"]).select("doc", "uid", "lo", "hi", "at", "piece", "bins").mapInArrow(run, types)


def _constructed(batches, window: int):
    """Spans of the repeated windows of lone pieces; input sorted by core, collections cut between cores."""
    types = "doc long, uid long, start int, end int"

    def solve(rows):
        cols = list(zip(*rows))
        texts = [np.frombuffer(p, np.uint8) for p in cols[9]]
        lo, hi, at = (np.array(cols[i], np.int64) for i in (5, 6, 7))
        flags = repeated(texts, at - lo, np.zeros(len(rows), np.int64), hi - lo, window)
        out = [(r[3], r[4], r[5] + int(a), r[5] + int(b) - 1 + window) for r, f in zip(rows, flags) if r[8] == 1 and f.any() for a, b in zip(*flag_spans(f))]
        return _table(types, *zip(*out)) if out else None

    rows: list = []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if len(rows) >= COLLECTION_TEXTS and r[:3] != rows[-1][:3]:
                if (out := solve(rows)) is not None:
                    yield out
                rows = []
            rows.append(r)
    if rows and (out := solve(rows)) is not None:
        yield out


def _dealt(pieces: DataFrame, window: int, most: int) -> list[DataFrame]:
    """Spans (doc, uid, start, end) of the repeated windows of lone pieces; deletes ``pieces``."""
    spark, size = pieces.sparkSession, min(BIN, window // 2)
    spans = []
    while True:
        bins = written(_binned(pieces, size, window), "bins")
        kinds = bins.groupBy(*CORE, "p1", "p2").agg(F.sum("n").alias("m"), F.count("*").alias("k"), F.min(F.struct("s1", "s2")).alias("r"))
        kinds = written(kinds.select(*CORE, "p1", "p2", "m", "k", "r.*"), "kinds")
        # what is equal as a whole is repeated as a whole
        equal = bins.where("n = 1").join(kinds.where("k > 1").select("b", "p1", "p2"), ["b", "p1", "p2"])
        spans.append(written(equal.select("doc", "uid", "start", (F.col("start") + F.col("count") - 1 + window).alias("end")), "equal"))
        removed(spark, bins)
        cores = written(kinds.groupBy(*CORE).agg(F.count("*").alias("c")).where("c > 1").select(*CORE, (F.col("c") > most).cast("int").alias("hot")), "cores")
        parts = written(_parts(pieces, kinds.join(cores, CORE), size, window), "parts")
        removed(spark, kinds, pieces)
        small = parts.where("hot = 0" if size > 1 else "true").select(*CORE, "doc", "uid", "lo", "hi", "at", "n", "piece")
        lined = small.repartition(*CORE).sortWithinPartitions(*CORE)
        spans.append(written(lined.mapInArrow(lambda x: _constructed(x, window), "doc long, uid long, start int, end int"), "built"))
        done = size == 1 or cores.where("hot = 1").isEmpty()
        removed(spark, cores)
        if done:
            removed(spark, parts)
            return spans
        pieces = written(parts.where("hot = 1").select(*[f.split()[0] for f in PIECE.split(", ")]), "pieces")
        removed(spark, parts)
        size //= 2


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, most: int = MOST_TEXTS) -> DataFrame:
    """(doc, uid, spans): byte spans to remove, for each document that has any; written."""
    spark = docs.sparkSession
    found = candidates(runs(docs, byte_units, window, gram, lift=K.byte_symbols))
    every = classes(found)
    whole = found.join(every.where("n > 1").select("s1", "s2"), ["s1", "s2"]).select("doc", "uid", F.col("lo").alias("start"), (F.col("hi") + window).alias("end"))
    shared = every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    pieces = written(_surroundings(docs, every.join(shared, "key", "left_semi"), window), "pieces")
    parts = _dealt(pieces, window, most)
    for own in parts:
        whole = whole.union(own.select("doc", "uid", "start", "end"))
    out = written(whole.groupBy("doc", "uid").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    removed(spark, found, every, *parts)
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, most: int = MOST_TEXTS, digest: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): kept holds the bytes left (or their digest, a string).

    A byte goes if a ``window``-byte string that covers it also starts anywhere
    else; all strings are judged on the input.  A null text is empty; null ids are
    ids of no order here; repeated rows remove each other.
    """
    rows = keyed(docs, id_col, text_col)
    spans = removals(rows, window, gram, most)

    def run(batches):
        for batch in batches:
            marks = batch.column(2)
            for a, b, buf, offs in K.slices(batch.column(1)):
                keep = np.ones(len(buf), bool)
                n_spans = np.zeros(b - a, np.int64)
                for i, own in enumerate(marks.slice(a, b - a).to_pylist()):
                    if own:
                        lo, hi = merged(np.array([s["start"] for s in own]), np.array([s["end"] for s in own]))
                        n_spans[i] = len(lo)
                        for x, y in zip(lo.tolist(), hi.tolist()):
                            keep[offs[i] + x : offs[i] + y] = False
                cut = np.concatenate([[0], np.cumsum(keep)])[offs]
                raw = buf[keep].tobytes()
                out = [raw[x:y] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                kept = pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string()) if digest else pa.array(out, pa.binary())
                n = np.diff(offs)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n), pa.array(n - np.diff(cut)), pa.array(n_spans), kept], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(spans, ["doc", "uid"], "left").select("id", "text", "spans")
    return joined.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept " + ("string" if digest else "binary"))
