"""Exact top-k inner products by a Voronoi join.

Rows are grouped by their nearest pivot, and each cell is cut into ``RINGS`` rings
of distance from it.  A ring's summary holds its size, its radius r and its
longest vector.  For a query q and a ring around the pivot c, every score q.v is
at most ``q.c + |q| r``, and at most ``|q|`` times the longest vector.

Each query is first sent to the cells whose pivots promise most, until they hold
``k + 1`` rows or more; its k-th best score there is its floor.  Then it is sent
to those other rings alone whose bound reaches the floor.  Rings solve their part
in blocks; the parts' bests are ranked at the end.

Pivots are the square root of the number of rows, at most ``MOST_PIVOTS``, chosen
by a hash of their ids (they decide the cost, never the result).  Rings of any
size are cut into blocks of ``BLOCK_ROWS`` rows and ``BLOCK_QUERIES`` queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import removed, written

MOST_PIVOTS, RINGS, BLOCK_ROWS, BLOCK_QUERIES = 4096, 4, 8192, 1024
FIRST_CELLS = 2
ASKED = "id long, h long, v array<long>, ring int"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of each component.

    Vectors that are null, empty or hold null or non-finite components take no
    part, nor do rows with a null id.
    """
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = vectors.where(v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)))
    return sound.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.int64)


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; floats carry them exactly below 2**53."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if bound < 2**53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def _celled(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, cell, dist, norm): the nearest pivot, the distance to it and the vector's length, a hair too large."""
    norms = (pivots * pivots).sum(axis=1)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1)).astype(float)
            cell = np.concatenate([(norms - 2 * part @ pivots.T).argmin(axis=1) for part in np.array_split(v, 1 + len(v) * len(norms) // (1 << 20))])
            dist = np.sqrt(((v - pivots[cell]) ** 2).sum(axis=1)) * (1 + 1e-9)
            norm = np.sqrt((v * v).sum(axis=1)) * (1 + 1e-9)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(dist), pa.array(norm)], ["id", "v", "cell", "dist", "norm"])

    return table.mapInArrow(run, "id long, v array<long>, cell int, dist double, norm double")


class Rings:
    """The summaries of all rings, and which of them a query has to ask."""

    def __init__(self, rows, pivots: np.ndarray, k: int):
        rows = sorted(rows)
        self.names = np.array([r[0] for r in rows], np.int64)
        self.cells = self.names // RINGS
        self.size, self.radius, self.norm = (np.array([r[i] for r in rows], float) for i in (1, 2, 3))
        self.pivots, self.k = pivots, k

    def first(self, q: np.ndarray) -> np.ndarray:
        """Whether each query's first turn asks each ring: the most promising cells, ``FIRST_CELLS`` and enough for k rows besides its own."""
        cells, at = np.unique(self.cells, return_inverse=True)
        held = np.bincount(at, self.size)
        order = np.argsort(-(q @ self.pivots[cells].T), axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        wanted = np.zeros(order.shape, bool)
        np.put_along_axis(wanted, order, (before <= self.k) | (np.arange(len(cells)) < FIRST_CELLS), axis=1)
        return wanted[:, at]

    def rest(self, q: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Whether each query's second turn asks each ring."""
        length = np.sqrt((q * q).sum(axis=1))[:, None]
        most = np.minimum(q @ self.pivots[self.cells].T + length * self.radius, length * self.norm)
        slack = 1e-6 * (1 + np.abs(most) + length * self.radius)
        return (most + slack >= floor[:, None]) & ~self.first(q)


def _asked(queries: DataFrame, rings, second: bool) -> DataFrame:
    """(id, h, v, ring): what each query asks in its first or second turn; ``queries``: (id, h, v, floor)."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                q = _matrix(part.column(2)).astype(float)
                wanted = rings.value.rest(q, part.column(3).to_numpy()) if second else rings.value.first(q)
                row, at = np.nonzero(wanted)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(take) for i in range(3)), pa.array(rings.value.names[at].astype(np.int32))], ["id", "h", "v", "ring"])

    return queries.mapInArrow(run, ASKED)


def _solved(rows: DataFrame, wanted: DataFrame, sizes: dict[int, int], k: int) -> DataFrame:
    """(query_id, h, vec_id, score): each query's k best rows of every block of the rings that it asks."""
    spark = rows.sparkSession
    loads = {r["ring"]: r["n"] for r in wanted.groupBy("ring").agg(F.count("*").alias("n")).collect()}
    plan = [(g, -(-sizes[g] // BLOCK_ROWS), -(-n // BLOCK_QUERIES)) for g, n in loads.items()]
    plan = F.broadcast(spark.createDataFrame(plan, "ring int, blocks int, parts int"))  # one row a ring at most
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    data = rows.join(plan, "ring").select("ring", own("blocks").alias("block"), every("parts").alias("part"), "id", "v")
    ask = wanted.join(plan, "ring").select(F.col("ring").alias("r"), every("blocks").alias("b"), own("parts").alias("p"), F.col("id").alias("q"), "h", F.col("v").alias("w"))

    def solve(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 4), np.int64)]
        if len(rows) and len(queries):
            ids = rows["id"].to_numpy()
            scores = _exact(np.stack(queries["w"].to_numpy()), np.stack(rows["v"].to_numpy()))
            for name, h, score in zip(queries["q"], queries["h"], scores):
                ok = np.flatnonzero(ids != name)
                if len(ok) > k:
                    least = np.partition(score[ok], len(ok) - k)[len(ok) - k]
                    ok = ok[score[ok] >= least]
                best = ok[np.lexsort((ids[ok], -score[ok]))][:k]
                out.append(np.stack([np.full(len(best), name), np.full(len(best), h), ids[best], score[best]], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["query_id", "h", "vec_id", "score"])

    return data.groupBy("ring", "block", "part").cogroup(ask.groupBy("r", "b", "p")).applyInPandas(solve, "query_id long, h long, vec_id long, score long")


def _joined(table: DataFrame, k: int, every: int, pivots: int | None, report: dict | None) -> DataFrame:
    """(query_id, rank, vec_id, score) over vectors of one length."""
    spark = table.sparkSession
    n = table.count()
    chosen = table.orderBy(F.xxhash64("id"), "id").limit(pivots or max(1, min(MOST_PIVOTS, round(n**0.5)))).collect()
    centres = np.array([r["v"] for r in chosen], float)
    cells = written(_celled(table, centres), "cells")
    wide = F.broadcast(cells.groupBy("cell").agg(F.max("dist").alias("wide")))  # one row a pivot
    ring = F.col("cell") * RINGS + F.when(F.col("wide") > 0, F.least(F.floor(F.col("dist") / F.col("wide") * RINGS), F.lit(RINGS - 1))).otherwise(0).cast("int")
    rows = written(cells.join(wide, "cell").select("id", "v", "dist", "norm", ring.cast("int").alias("ring")), "rows")
    sums = rows.groupBy("ring").agg(F.count("*"), F.max("dist"), F.max("norm")).collect()
    sizes = {r[0]: r[1] for r in sums}
    rings = spark.sparkContext.broadcast(Rings([tuple(r) for r in sums], centres, k))
    queries = written(rows.where(F.col("id") % every == 0).select("id", F.xxhash64("v").alias("h"), "v").distinct(), "queries")
    best = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    turn = written(_asked(queries.withColumn("floor", F.lit(0.0)), rings, False), "asked")
    near = written(ranked(_solved(rows, turn, sizes, k)).drop("rank"), "near")
    floors = near.groupBy("query_id", "h").agg(F.when(F.count("*") == k, F.min("score")).cast("double").alias("floor")).withColumnRenamed("query_id", "id")
    again = queries.join(floors, ["id", "h"], "left").select("id", "h", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    then = written(_asked(again, rings, True), "asked")
    if report is not None:
        report["pairs"] = report.get("pairs", 0) + queries.count() * len(sizes)
        report["asked"] = report.get("asked", 0) + turn.count() + then.count()
    far = _solved(rows, then, sizes, k)
    out = written(ranked(near.union(far)).select("query_id", "rank", "vec_id", "score"), "best")
    removed(spark, cells, rows, queries, turn, near, then)
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, report: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows, ties to the smaller id; fewer, if there are fewer.

    Queries are the rows whose id is divisible by ``every``.  Repeated rows of
    one id are one query; of one id with different vectors each is a query of
    its own.  A row of the query's own id is no candidate; rows of one id
    otherwise count each.  Only vectors of one length have a score.  ``report``
    gets the number of (query, ring) pairs and of those that were asked.
    """
    table = quantised(vectors, id_col, vector_col)
    lengths = [r[0] for r in table.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    out = None
    for n in lengths:
        own = _joined(table.where(F.size("v") == n), k, every, pivots, report)
        out = own if out is None else out.union(own)
    return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long") if out is None else out
