"""Near duplicates by SimHash fingerprints and multi-index hashing.

A document's shingles (``SHINGLE`` lower-cased words, repeats included) vote on
64 bits.  Fingerprints at most ``RADIUS`` bits apart link.  The index cuts a
fingerprint into ``SEGMENTS`` parts: of two linked fingerprints at least one
part differs in at most ``RADIUS // SEGMENTS`` bits, so every fingerprint
enumerates that small Hamming ball in each part, fetches the table rows with
such a part, and verifies the complete distance.

Equal fingerprints are collapsed before the index is built, so a group of
copies of any size is one index row; no pairs inside it are ever made.

All joins are ``merge`` joins: Spark's size check sees the few bytes of a Parquet
file, not the rows that come of it, and would gather an index on the driver.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .shared import written

SHINGLE, RADIUS, SEGMENTS = 3, 3, 2


def shingle_hashes(buf, offs, shingle: int):
    """XXH64 (seed 42) of every shingle of the lower-cased texts, and offsets per document."""
    buf = K.lower_ascii(buf)
    starts, ends, words = K.word_spans(buf, offs)
    joined, at, to = K.join_words(buf, starts, ends)
    n = np.diff(words)
    counts = np.where(n >= shingle, n - shingle + 1, (n > 0).astype(np.int64))
    first = K.ragged(words[:-1], counts)
    last = np.minimum(first + shingle - 1, np.repeat(words[1:], counts) - 1)
    raw, h = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((h(raw[p:q], 42) for p, q in zip(at[first].tolist(), to[last].tolist())), np.uint64, len(first))
    return hashes, np.concatenate([[0], np.cumsum(counts)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) of every row.  Null or wordless text: zero."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, buf, offs in K.slices(batch.column(1)):
                fps = K.simhash(*shingle_hashes(buf, offs, shingle))
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(K.signed(fps))], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def _ball(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]


def links(nodes: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b), a > b: all links between the distinct fingerprints ``fp`` of ``nodes``."""
    bits = 64 // segments
    part = lambda i: F.shiftrightunsigned("fp", bits * i).bitwiseAND(F.lit((1 << bits) - 1))
    tables = F.array(*[F.struct(F.lit(i).alias("seg"), part(i).alias("key")) for i in range(segments)])
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(bits, radius // segments)])
    table = nodes.select("fp", F.inline(tables))
    probes = nodes.select(F.col("fp").alias("q"), F.inline(tables)).select("q", "seg", "key", F.explode(masks).alias("mask"))
    probes = probes.select("q", "seg", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
    near = probes.join(table.hint("merge"), ["seg", "key"]).where((F.col("q") > F.col("fp")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius))
    return near.select(F.col("q").alias("a"), F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component): component is the least id that links reach, the row's own included.

    Null ids are carried but never name a component unless a component has no
    other (then null).  Repeated rows come back as often as they came.  An empty
    table gives an empty result.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    labels = components(links(nodes, radius))
    named = nodes.join(labels.hint("merge"), nodes.fp == labels.node, "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component"))
    members = written(named.join(least.hint("merge"), "label").select(F.col("fp").alias("member"), "component"), "members")
    return marked.join(members.hint("merge"), marked.fp == members.member).select("id", "fp", "component")
