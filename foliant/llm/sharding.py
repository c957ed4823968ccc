"""Histogram sort of documents into shards of near-equal bytes.

Law: ``bytes``.  The sort key is (hash of the text, id), so equal texts lie
together.  Splitters are found by probing: each round counts, over all
partitions, the exact bytes below every candidate boundary, and narrows each
splitter's bracket, until its count is within ``TOLERANCE`` of a shard of its
target.  A splitter stands at the edge of a group of equal texts if an edge lies
within ``GROUP_TOLERANCE`` of a shard; only a larger group is cut, by id.

Shards are cut further into buckets by the same probes, so that one exchange by
bucket and a sort inside it give every row its slot: rows below the bucket are
known from the last counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

SHARDS = 8
TOLERANCE, GROUP_TOLERANCE = 0.001, 0.02
BUCKET_BYTES, MOST_BUCKETS = 128 << 20, 4096
PROBES = 16
ID_BITS = 64
LOW = -(2**63)


def keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, crc, h, i): size in bytes plus one, CRC-32 of the text, and the sort key (h, i); then ``carry``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.xxhash64(text).alias("h"), *[F.col(c).alias(f"k_{c}") for c in carry])
    return out.withColumn("i", F.coalesce("id", F.lit(LOW)))


def place(h: np.ndarray, i: np.ndarray, bounds_h: np.ndarray, bounds_i: np.ndarray) -> np.ndarray:
    """How many bounds are at or below each key."""
    out = np.searchsorted(bounds_h, h, "left")
    upto = np.searchsorted(bounds_h, h, "right")
    tied = np.flatnonzero(out < upto)
    for value in np.unique(h[tied]):
        own = tied[h[tied] == value]
        a, b = out[own[0]], upto[own[0]]
        out[own] = a + np.searchsorted(bounds_i[a:b], i[own], "right")
    return out


def _arrays(bounds: list[int]):
    """Bounds as (h, i) arrays; a bound is (h + 2**63) << 64 | (i + 2**63)."""
    return np.array([(b >> ID_BITS) + LOW for b in bounds], np.int64), np.array([(b & (2**64 - 1)) + LOW for b in bounds], np.int64)


def counted(table: DataFrame, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each bound, and in all."""
    bh, bi = _arrays(bounds)

    def run(batches):
        total = np.zeros((2, len(bh) + 1), np.int64)
        for batch in batches:
            h, i, size = (batch.column(k).to_numpy() for k in range(3))
            at = place(h, i, bh, bi)
            np.add.at(total[0], at, size)
            np.add.at(total[1], at, 1)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], ["b", "bytes", "rows"])

    sums = table.select("h", "i", "size").mapInArrow(run, "b long, bytes long, rows long").groupBy("b").agg(F.sum("bytes"), F.sum("rows"))
    out = np.zeros((2, len(bounds) + 1), np.int64)
    for b, x, y in sums.collect():
        out[:, b] = x, y
    return np.cumsum(out[0]), np.cumsum(out[1])


def splitters(table: DataFrame, shards: int) -> tuple[list[int], list[bool]]:
    """Sorted bounds of all buckets, and which of them part shards."""
    row = table.agg(F.sum("size"), F.min("id"), F.max("id")).first()
    total = row[0] or 0
    if not total:
        return [], []
    low_id, high_id = (row[1] or 0) + 2**63, (row[2] or 0) + 2**63 + 1
    per = min(MOST_BUCKETS, max(4, -(-total // (shards * BUCKET_BYTES))))
    share = total / shards
    targets = {k: k * share / per for k in range(1, shards * per)}
    brackets = {k: (0, 0, 1 << 128, total) for k in targets}  # bound, bytes below it; twice
    chosen: dict[int, int] = {}
    while brackets:
        asked: dict[int, list[int]] = {}
        for k, (a, _, b, _) in brackets.items():
            ha, hb = a >> ID_BITS, b >> ID_BITS
            if hb - ha > 1:
                steps = {(ha + (hb - ha) * s // (PROBES + 1)) << ID_BITS for s in range(1, PROBES + 1)}
                steps |= {(ha + 1) << ID_BITS} if hb - ha < 2**20 else set()
            else:
                lo = max(a, (ha << ID_BITS) + low_id)
                hi = min(b, (ha << ID_BITS) + high_id)
                steps = {lo + (hi - lo) * s // (PROBES + 1) for s in range(1, PROBES + 1)} | {lo, hi}
            asked[k] = [s for s in steps if a < s < b]
        probes = sorted({s for own in asked.values() for s in own})
        below = dict(zip(probes, counted(table, probes)[0].tolist())) if probes else {}
        for k, own in asked.items():
            a, x, b, y = brackets[k]
            part = k % per == 0
            fine = TOLERANCE * share if part else 0.25 * share / per
            target = targets[k]
            for s in sorted(own):
                if below[s] <= target:
                    a, x = s, below[s]
                else:
                    b, y = s, below[s]
                    break
            near, off = min(((a, target - x), (b, y - target)), key=lambda t: t[1])
            one_text = (b >> ID_BITS) - (a >> ID_BITS) <= 1
            edges = [(e, d) for e, d in ((a, target - x), (b, y - target)) if e & (2**64 - 1) == 0 and one_text]
            if off <= fine and (near & (2**64 - 1) == 0 or not edges):
                chosen[k] = near
            elif edges and min(edges, key=lambda t: t[1])[1] <= GROUP_TOLERANCE * share:
                chosen[k] = min(edges, key=lambda t: t[1])[0]
            elif not own or b - a <= 1:
                chosen[k] = near
            else:
                brackets[k] = a, x, b, y
                continue
            del brackets[k]
    bounds, parts = [], []
    for k in sorted(chosen):
        bounds.append(min(chosen[k], (1 << 128) - 1))
        parts.append(k % per == 0)
    order = sorted(range(len(bounds)), key=lambda j: (bounds[j], j))
    return [bounds[j] for j in order], [parts[j] for j in order]


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, crc, shard, slot) of every row, and the columns named in ``carry``, as k_<name>.

    Null texts are empty, null ids sort first; repeated rows keep places of
    their own.  An empty table gives no row.
    """
    table = written(keys(docs, id_col, text_col), "keys")
    bounds, parts = splitters(table, shards)
    bh, bi = _arrays(bounds)
    rows_below = np.concatenate([[0], counted(table, bounds)[1]])[:-1] if bounds else np.zeros(1, np.int64)
    shard_of = np.concatenate([[0], np.cumsum(parts)]).astype(np.int32)
    first = np.array([int(rows_below[np.searchsorted(shard_of, s)]) for s in shard_of], np.int64)
    base = rows_below - first
    if carry:
        table = keys(docs, id_col, text_col, carry)

    def run(batches):
        for batch in batches:
            at = place(batch.column("h").to_numpy(), batch.column("i").to_numpy(), bh, bi)
            new = [pa.array(at.astype(np.int32)), pa.array(shard_of[at]), pa.array(base[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "bucket", "shard", "base"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
    marked = table.mapInArrow(run, types + ", bucket int, shard int, base long")
    slot = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "i"))
    return marked.withColumn("slot", F.col("base") + slot - 1).select("id", "size", "crc", "shard", "slot", *[f"k_{c}" for c in carry])
