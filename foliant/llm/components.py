"""Connected components of an edge table by alternating large-star and small-star.

Both star steps are joins and aggregations over edges; no component and no
neighbour list is ever gathered in one task, nor by a broadcast on the driver.
Each round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import removed, written


#: Edges that one task joins up before the first round.
BLOCK = 200_000


def _joined(batches):
    """Of each partition's edges, the stars that they make: every node with the least node that they reach from it."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    tops = [(x, root(x)) for x in list(parent)]
    tops = np.array([t for t in tops if t[0] != t[1]], np.int64).reshape(-1, 2)
    for i in range(0, len(tops), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(tops[i : i + (1 << 16), k]) for k in (0, 1)], ["a", "b"])


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one other, which points to none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select(F.col("b"), F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out = 1 and into = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node that the links reach.

    ``edges``: columns ``a`` and ``b``, longs, any order and repeats.  Nodes
    without an edge to another node do not appear.  An empty table gives none.
    """
    spark = edges.sparkSession
    schema = "a long, b long"
    both = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    given = written(both, "given")
    now = written(given.coalesce(1 + given.count() // BLOCK).mapInArrow(_joined, schema).distinct(), "edges")
    removed(spark, given)
    while not _stars(now):
        sym = now.union(now.select(F.col("b"), F.col("a")).toDF("a", "b"))
        least = sym.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = sym.join(least.hint("merge"), sym.a == least.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_min = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        paired = large.join(small_min.hint("merge"), large.a == small_min.u)
        small = paired.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small_min.select("u", "m").toDF("a", "b"))
        after = written(small.where("a <> b").distinct(), "edges")
        removed(spark, now)
        now = after
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(now.select(F.col("b"), F.col("b")).distinct().toDF("node", "label")).distinct()
