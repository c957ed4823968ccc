"""Groups of similar texts: SimHash candidates, verified by shingle similarity.

Three fingerprints stand for a text: that of its shingles (``near_dup``) and two
of its set of words, which edits disturb less.  Multi-index hashing with
``SEGMENTS`` segments finds the texts that are within ``RADIUS`` bits by any of
them.  Table rows and probes of one key meet in one place and leave a forest of
links, never all pairs.  Fingerprints miss most pairs that differ by a block of
words, so texts also meet by MinHash: ``BANDS`` keys of ``ROWS`` minima over the
very shingles that verification compares.  A pair of similarity j misses all of
them with chance ``(1 - j**ROWS)**BANDS``, however the words differ: at 0.8 three
in a million.

Two texts are linked if the exact Jaccard similarity of their sets of
``SHINGLE``-word shingles is at least ``SIMILAR``; a group is what links reach, and
its least id stays.  Links are sought bucket by bucket (texts that share a key):

1. every text is compared with the least of each of its buckets, first with
   that of the most of its ``FIRST`` bands' buckets, then, by all bands, with
   those that it is not yet grouped with; buckets of one group are not opened;
2. buckets whose texts then are still in several groups, of at most ``SMALL``
   texts, compare across those groups in one task;
3. the texts of larger ones (a passage that many share) are dealt out again by
   their rarest shingles: similar texts share one of the rarest fifth, whatever
   they share besides; then steps 1 and 2;
4. what is left is compared ``HEADS`` texts a round with all others of the
   bucket, in blocks, until its texts are in one group or few enough.

Equal texts are one row throughout, and texts of one group are never compared.
Before texts travel to be compared, their ``cells`` do: how many shingles fall
in each of ``CELLS`` cells.  Two texts share no more than the lesser count of each
cell, so a pair whose cells add up to too little is no link, whatever its words.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .near_dup import _ball, shingle_hashes
from .near_dup import SHINGLE as FINGERPRINT_SHINGLE
from .shared import removed, written

SHINGLE, SIMILAR = 5, 0.8
RADIUS, SEGMENTS = 5, 3
BANDS, ROWS = 24, 4
#: Bands that texts meet by first: a pair at 0.8 shares one of them with chance 0.88, at 0.9 with 0.99.
FIRST = 4
SMALL, HEADS, BLOCK = 200, 250, 250
SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)
BOUNDS = [64 * i // SEGMENTS for i in range(SEGMENTS + 1)]
#: Bits of a segment's key that are not looked at when it is dealt out: 1536 places.
LOW = 14
PAIRS = 1 << 19
#: Cells in which a text's different shingles are counted, a byte each, behind their number in four.
CELLS = 128
#: The rarest shingles are told by counts in 2**ORDER_BITS cells; where shingles share a cell the order is coarser, the links are the same.
ORDER_BITS = 20
#: Table rows and probes of fingerprints that a task sorts, about.
ROWS_SORTED = 400_000
#: Rows of up to five longs that are broadcast at most (40 MB); more are joined by an exchange.
MOST_SENT = 1_000_000
MULTIPLIERS, OFFSETS = np.random.default_rng(20240502).integers(0, 1 << 64, (2, BANDS * ROWS), dtype=np.uint64) | np.array([[1], [0]], np.uint64)


def bands(h: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The ``BANDS`` MinHash keys of each document's shingle hashes; without shingles, those of no minimum."""
    full = np.flatnonzero(np.diff(cut))
    out = np.zeros((len(cut) - 1, BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(cut) - 1, b, np.uint64)
        for i in range(b * ROWS, (b + 1) * ROWS):
            least = np.full(len(key), ~np.uint64(0))
            if len(full):
                least[full] = np.minimum.reduceat((h ^ OFFSETS[i]) * MULTIPLIERS[i], cut[full])
            key = K.mix(key ^ least)
        out[:, b] = key
    return out


def prints(rows: DataFrame) -> DataFrame:
    """(id, same, f0, f1, f2, bands) of every (id, text): ``same`` tells equal texts."""

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in K.slices(batch.column(2)):
                found = [K.simhash(*shingle_hashes(buf, offs, FINGERPRINT_SHINGLE))]
                low = K.lower_ascii(buf)
                starts, ends, cut = K.word_spans(low, offs)
                h, doc = K.word_hashes(low, starts, ends), K.doc_of(cut, len(starts))
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                h, own = h[new], np.searchsorted(doc[new], np.arange(len(offs)))
                found += [K.simhash(K.mix(h ^ np.uint64(s)), own) for s in SEEDS]
                keys = pa.array(K.signed(bands(*shingle_hashes(buf, offs, SHINGLE)).ravel()))
                keys = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), keys)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], *(pa.array(K.signed(f)) for f in found), keys], ["id", "same", "f0", "f1", "f2", "bands"])

    return rows.select("id", F.xxhash64("text").alias("same"), "text").mapInArrow(run, "id long, same long, f0 long, f1 long, f2 long, bands array<long>")


def _linked(batches):
    """Links (a, b) of a partition sorted by slot: a forest over the texts that are near by some key."""
    names = ["slot", "fp", "node"]

    def solve(slot, fp, node):
        key, probe = slot >> 1, (slot & 1).astype(bool)
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(head, len(key)))
        tables = np.add.reduceat(~probe, head)  # table rows come first in a run
        probes = size - tables
        a_out, b_out = [], []
        work = np.flatnonzero((tables > 0) & (probes > 0))
        pairs = tables[work] * probes[work]
        at = 0
        while at < len(work):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(pairs[at:]), PAIRS, "right")) + at)
            w, n = work[at:upto], pairs[at:upto]
            at = upto
            step = max(1, PAIRS // int(tables[w].max())) if len(w) == 1 else None
            for lo in range(0, int(probes[w[0]]), step) if step else (None,):
                if step:
                    j = np.arange(lo, min(lo + step, int(probes[w[0]])))
                    i0, j0 = np.repeat(head[w[0]] + np.arange(tables[w[0]]), len(j)), np.tile(head[w[0]] + tables[w[0]] + j, int(tables[w[0]]))
                else:
                    k = K.ragged(np.zeros_like(n), n)
                    run = np.repeat(w, n)
                    i0, j0 = head[run] + k // probes[run], head[run] + tables[run] + k % probes[run]
                hit = (np.bitwise_count(fp[i0] ^ fp[j0]) <= RADIUS) & (node[i0] != node[j0])
                a_out.append(node[i0[hit]])
                b_out.append(node[j0[hit]])
        if not a_out:
            return None
        a, b = np.concatenate(a_out), np.concatenate(b_out)
        if not len(a):
            return None
        nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
        a, b = flat[: len(a)], flat[len(a) :]
        label = np.arange(len(nodes))
        while True:
            before = label.copy()
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
            label = label[label]
            if (label == before).all():
                break
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["a", "b"])

    held = None
    for batch in batches:
        new = [batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in names]
        new[1] = new[1].astype(np.int64).view(np.uint64)
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if len(held[0]) < 200_000:
            continue
        last = np.flatnonzero(held[0] >> 1 != held[0][-1] >> 1)
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            if (out := solve(*(x[:cut] for x in held))) is not None:
                yield out
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]) and (out := solve(*held)) is not None:
        yield out
    K.trimmed()


def near_prints(nodes: DataFrame) -> DataFrame:
    """(a, b): links that connect all texts whose fingerprints are near.

    A slot is the fingerprint's number, segment and key, and in the last bit whether the row asks or is asked.  Slots
    that differ in the key's lowest ``LOW`` bits alone meet in one place, so what a text asks is dealt out by the
    other bits, and told apart by the lowest only there.
    """
    radius, rows = RADIUS // SEGMENTS, []
    for f in range(3):
        for s in range(SEGMENTS):
            bits = BOUNDS[s + 1] - BOUNDS[s]
            key = F.shiftrightunsigned(f"f{f}", BOUNDS[s]).bitwiseAND(F.lit((1 << bits) - 1))
            slot = F.shiftleft(key.bitwiseOR(F.lit((f * SEGMENTS + s) << 32)), 1)
            for m in _ball(bits - LOW, radius):
                rows.append(F.struct(slot.bitwiseXOR(F.lit(m << LOW + 1)).alias("slot"), F.col(f"f{f}").alias("fp"), F.lit(m.bit_count()).cast("byte").alias("bits")))
    # so many places that a task sorts some ROWS_SORTED rows, whatever is sent: Spark would put places together by the bytes sent
    places = nodes.count() * sum(1 + len(_ball(BOUNDS[s + 1] - BOUNDS[s], radius)) for s in range(SEGMENTS)) * 3 // ROWS_SORTED
    rows = nodes.select("node", F.inline(F.array(*rows))).repartition(1 + min(places, 1535), F.shiftright("slot", LOW + 1))
    asks = [[m << 1 | 1 for m in _ball(LOW, radius - k)] for k in range(radius + 1)]
    masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in ([0] if k == 0 else []) + own]) for k, own in enumerate(asks)])
    rows = rows.select("slot", "fp", "node", F.explode(F.get(masks, "bits")).alias("mask"))
    return rows.select(F.col("slot").bitwiseXOR(F.col("mask")).alias("slot"), "fp", "node").sortWithinPartitions("slot").mapInArrow(_linked, LINKS)


LINKS = "a long, b long"


def shingle_set(text: str) -> np.ndarray:
    """The sorted hashes of a text's shingles."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.unique(shingle_hashes(raw, np.array([0, len(raw)]), SHINGLE)[0])


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets are similar; two empty ones are."""
    if min(len(a), len(b)) < SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILAR * (len(a) + len(b) - both)


def _distinct(buf: np.ndarray, offs: np.ndarray):
    """The different shingles of each text, sorted, and the texts' numbers."""
    h, cut = shingle_hashes(buf, offs, SHINGLE)
    doc = K.doc_of(cut, len(h))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def celled(texts: DataFrame) -> DataFrame:
    """(node, text, cells) of every (node, text)."""

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in K.slices(batch.column(1)):
                h, doc = _distinct(buf, offs)
                n = b - a
                cells = np.bincount(doc * CELLS + (h % np.uint64(CELLS)).astype(np.int64), minlength=n * CELLS).reshape(n, CELLS)
                size = np.bincount(doc, minlength=n).astype("<u4").view(np.uint8).reshape(n, 4)
                raw = np.hstack([size, np.minimum(cells, 255).astype(np.uint8)])
                at = np.arange(n + 1, dtype=np.int32) * raw.shape[1]
                cells = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], cells], ["node", "text", "cells"])

    return texts.select("node", "text").mapInArrow(run, "node long, text string, cells binary")


def possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the texts of two rows of cells can be alike, row by row; never false of two that are."""
    n, m = (np.ascontiguousarray(x[:, :4]).view("<u4")[:, 0].astype(np.int64) for x in (a, b))
    least = np.minimum(a[:, 4:], b[:, 4:])
    most = np.where((least == 255).any(axis=1), np.minimum(n, m), np.minimum(least.sum(axis=1, dtype=np.int64), np.minimum(n, m)))
    return most >= SIMILAR * (n + m - most)


def _cells(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist() if isinstance(column, pa.Array) else column), np.uint8).reshape(len(column), 4 + CELLS)


def _sent(rows: DataFrame) -> DataFrame:
    """A written table of ids: sent to all executors if it has ``MOST_SENT`` rows at most, so that what it is joined with stays where it is."""
    return F.broadcast(rows) if rows.count() <= MOST_SENT else rows


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the different pairs (a, b), those that are alike; written.

    Only the cells of pairs travel, and of those that can be alike the texts, once for each pair, to a place that the pair decides, so no text is a hot key.
    """

    def near(batches):
        held = None
        for batch in batches:
            new = [*(batch.column(i).to_numpy() for i in range(3)), _cells(batch.column(3))]
            a, b, node, cells = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            both = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (node[1:] == b[1:]) & (node[:-1] == a[:-1]))
            both = both[possible(cells[both], cells[both + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(a[both]), pa.array(b[both])], ["a", "b"])
            held = [x[-1:] for x in (a, b, node, cells)]

    def run(batches):
        before = None, None
        for batch in batches:
            keep = []
            for a, b, node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                own = shingle_set(text.as_py())
                keep.append(before[0] == (a, b) and node == b and alike(before[1], own))  # a's row comes just before b's
                before = (a, b), own
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    pairs = written(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "asked")
    done = [pairs]
    for column, told, name in (("cells", near, "likely"), ("text", run, "links")):
        sides = written(pairs.select(F.explode(F.array("a", "b")).alias("node"), "a", "b"), "sides")
        both = texts.select("node", column).join(_sent(sides), "node").select("a", "b", "node", column)
        pairs = written(both.repartition("a", "b").sortWithinPartitions("a", "b", "node").mapInArrow(told, LINKS), name)
        done += [sides, pairs]
    removed(texts.sparkSession, *done[:-1])
    return pairs


def _grouped(group: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that connect the alike texts of a few, which are in several parts already."""
    nodes, parts, sets = group["node"].tolist(), group["part"].tolist(), [shingle_set(t) for t in group["text"]]
    out = []
    for i in range(1, len(nodes)):
        for j in range(i):
            if parts[i] != parts[j] and alike(sets[i], sets[j]):
                out.append((nodes[i], nodes[j]))
                old, new = parts[i], parts[j]
                parts = [new if p == old else p for p in parts]
    return pd.DataFrame({"a": pd.Series([a for a, _ in out], dtype="int64"), "b": pd.Series([b for _, b in out], dtype="int64")})


def _meeting(group: pd.DataFrame) -> pd.DataFrame:
    """(key, node, part) of those of a few that can be alike to one of another part."""
    part, cells = group["part"].to_numpy(), _cells(group["cells"])
    stays = np.zeros(len(part), bool)
    for i in range(1, len(part)):
        j = np.flatnonzero(part[:i] != part[i])
        j = j[possible(cells[j], np.broadcast_to(cells[i], (len(j), cells.shape[1])))]
        stays[j] = True
        stays[i] |= len(j) > 0
    return group.loc[stays, ["key", "node", "part"]]


def _compared(members: pd.DataFrame, heads: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) of a block of members with the heads they are like, one for each part of the heads."""
    a, b = [], []
    known = [*zip(heads["head"], heads["of"], map(shingle_set, heads["other"]))]
    for node, part, own in zip(members["node"], members["part"], map(shingle_set, members["text"])):
        met = {part}
        for head, of, other in known:
            if of not in met and head != node and alike(own, other):
                met.add(of)
                a.append(node)
                b.append(head)
    return pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})


def _buckets(members: DataFrame) -> DataFrame:
    """(key, first, n) of the buckets of (key, node) with more than one text; written."""
    return written(members.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1"), "buckets")


def _across(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The different pairs (a, b) of two parts."""
    part = lambda side: parts.select(F.col("node").alias(side), F.col("label").alias(f"part_{side}"))
    both = pairs.distinct().join(part("a"), "a", "left").join(part("b"), "b", "left")
    return both.where(F.coalesce("part_a", "a") != F.coalesce("part_b", "b")).select("a", "b")


def _mixed(shared: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, n, node, part) of the buckets of three or more texts that are in several parts; written.

    ``shared``: (key, node, first, n) of the buckets with more than one text.
    """
    own = shared.where("n > 2").join(parts, "node", "left").select("key", "n", "node", F.coalesce("label", "node").alias("part"))
    open_ = own.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    return written(own.join(open_, "key"), "mixed")


def _settled(mixed: DataFrame, texts: DataFrame) -> DataFrame:
    """The links between the parts of small buckets; written."""
    few = written(mixed.where(F.col("n") <= SMALL).select("key", "node", "part"), "few")
    rows = texts.select("node", "cells").join(_sent(few), "node").select("key", "node", "part", "cells")
    meet = written(rows.groupBy("key").applyInPandas(_meeting, "key long, node long, part long"), "meet")
    rows = texts.select("node", "text").join(_sent(meet), "node").select("key", "node", "part", "text")
    out = written(rows.groupBy("key").applyInPandas(_grouped, LINKS), "links")
    removed(texts.sparkSession, few, meet)
    return out


def rarest(texts: DataFrame) -> DataFrame:
    """(key, node): the rarest shingles of each text, one more than it can do without and still be similar; those of one text only left out.

    Any order that is the same for all texts will do, so shingles are counted by
    cells, whose number is fixed: no shingle travels, and none is joined.
    """
    shift = np.uint64(64 - ORDER_BITS)

    def counted(batches):
        often = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for _, _, buf, offs in K.slices(batch.column(0)):
                np.add.at(often, (_distinct(buf, offs)[0] >> shift).astype(np.int64), 1)
        cell = np.flatnonzero(often)
        for i in range(0, len(cell), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + (1 << 16)]) for x in (cell, often[cell])], ["cell", "n"])

    found = texts.select("text").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << ORDER_BITS, np.int32)
    often[found.column("cell").to_numpy()] = np.minimum(found.column("n").to_numpy(), 2**31 - 1)
    sent = texts.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        for batch in batches:
            for a, b, buf, offs in K.slices(batch.column(1)):
                h, doc = _distinct(buf, offs)
                times = sent.value[(h >> shift).astype(np.int64)]
                order = np.lexsort((h, times, doc))
                h, doc, times = h[order], doc[order], times[order]
                n = np.bincount(doc, minlength=b - a)
                spare = n - np.ceil(n * SIMILAR - 1e-9).astype(np.int64) + 1
                place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
                own = (place < spare[doc]) & (times > 1)
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(h[own])), batch.column(0).take(pa.array(doc[own] + a))], ["key", "node"])

    return texts.select("node", "text").mapInArrow(run, "key long, node long")


def _by_rounds(mixed: DataFrame, texts: DataFrame) -> list[DataFrame]:
    """Links between the parts of large buckets, ``HEADS`` texts a round against all; heads come from outside the largest part."""
    spark, found, same = texts.sparkSession, [], ["key", "node"]
    active = written(mixed.where(F.col("n") > SMALL).select(*same, "part"), "active")
    while True:
        parts = active.groupBy("key", "part").agg(F.count("*").alias("n"))
        sizes = parts.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max_by("part", F.struct("n", -F.col("part"))).alias("most"))
        open_ = written(sizes.where("parts > 1").drop("parts"), "open")
        within = active.join(open_, "key")
        found.append(_settled(within.select("key", "n", "node", "part"), texts))
        large = open_.where(F.col("n") > SMALL).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        if large.isEmpty():
            removed(spark, active, open_)
            return found
        within = written(active.join(large, "key"), "within")
        rank = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        heads = written(within.where("part <> most").withColumn("r", rank).where(F.col("r") <= HEADS).select(*same, "part", "blocks"), "heads")
        spread = texts.join(_sent(heads), "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(F.col("key").alias("k"), "block", F.col("node").alias("head"), F.col("part").alias("of"), F.col("text").alias("other"))
        blocks = within.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        blocks = texts.join(_sent(blocks), "node").select("key", "block", "node", "part", "text")
        found.append(written(blocks.groupBy("key", "block").cogroup(spread.groupBy("k", "block")).applyInPandas(_compared, LINKS), "links"))
        # the heads are done with; the others are known by the parts that the links so far make
        both = active.select(F.col("node").alias("a"), F.col("part").alias("b")).where("a <> b").union(found[-1])
        rest = within.select(*same, "part").join(heads.select(*same), same, "left_anti").join(components(both), "node", "left")
        after = written(rest.select(*same, F.coalesce("label", "part").alias("part")), "active")
        removed(spark, active, open_, within, heads)
        active = after


def _texts(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text, cells) of the written table of nodes; written."""
    own = rows.select(F.col("id").alias("node"), F.coalesce("text", F.lit("")).alias("text")).join(_sent(nodes), "node")
    return written(celled(own.groupBy("node").agg(F.first("text").alias("text"))), "texts")


def repeats(rows: DataFrame) -> DataFrame:
    """(id): of all (id, text), the ids of texts that equal or similar ones link, over any number of texts, to a smaller id."""
    spark = rows.sparkSession
    marked = written(prints(rows), "prints")
    one = ["same", "f0", "f1", "f2"]
    nodes = written(marked.groupBy(*one).agg(F.min("id").alias("node"), F.first("bands").alias("bands")), "nodes")
    equal = written(marked.join(nodes.select(*one, "node"), one).where("id <> node").select("id"), "equal")
    # most texts are linked by the first bands alone, to the one that they share most keys with
    members = nodes.select("node", F.explode(F.slice("bands", 1, FIRST)).alias("key"))
    buckets = _buckets(members)
    met = members.join(_sent(buckets), "key").where("node <> first").groupBy(F.col("node").alias("a"), F.col("first").alias("b")).agg(F.count("*").alias("keys"))
    near = near_prints(nodes).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.lit(0).alias("keys"))
    pairs = written(met.union(near), "pairs")
    asked = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "asked")
    texts = _texts(rows, asked)
    links = [verified(pairs.groupBy("a").agg(F.max_by("b", F.struct("keys", -F.col("b"))).alias("b")), texts)]
    parts = written(components(links[0]), "parts")
    # of all bands, only buckets that are in several parts by then are opened
    members = nodes.join(parts, "node", "left").select("node", F.coalesce("label", "node").alias("part"), F.explode("bands").alias("key"))
    several = members.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
    several = written(several.where("low < high").select("key", "first", "n"), "several")
    shared = written(members.drop("part").join(_sent(several), "key"), "shared")
    more = written(shared.select("node").distinct().join(asked, "node", "left_anti"), "more")
    late = _texts(rows, more)
    done = [marked, nodes, buckets, pairs, asked, texts, parts, several, shared, more, late]
    texts = texts.union(late)
    met = shared.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    links.append(verified(_across(pairs.select("a", "b").union(met), parts), texts))
    parts = written(components(links[0].union(links[1])), "parts")
    mixed = _mixed(shared, parts)
    links.append(_settled(mixed, texts))
    done += [parts, mixed]
    if not (hot := mixed.where(F.col("n") > SMALL)).isEmpty():
        crowd = written(hot.select("node").distinct(), "crowd")
        own = written(rarest(texts.join(_sent(crowd), "node", "left_semi")), "rarest")
        known = own.join(parts, "node", "left").select("key", "node", F.coalesce("label", "node").alias("part"))
        again = known.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
        again = written(again.where("low < high").select("key", "first", "n"), "buckets")
        met = written(own.join(again, "key"), "again")
        pairs = met.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
        links.append(verified(_across(pairs, parts), texts))
        every = links[0].union(links[1]).union(links[2]).union(links[3])
        open_ = _mixed(met, components(every))
        links.append(_settled(open_, texts))
        links += _by_rounds(open_, texts)
        done += [crowd, own, again, met, open_]
    every = links[0]
    for part in links[1:]:
        every = every.union(part)
    out = written(equal.union(components(every).where("node <> label").select("node")).distinct().toDF("id"), "repeats")
    removed(spark, *done, equal, *links)
    return out
