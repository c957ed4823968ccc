"""An inverted-file vector index: k-means cells, of which a query probes the nearest."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import search

SAMPLE = 100_000


def indexed(vectors: DataFrame, cells: int, vector: str = "embedding", seed: int = 1):
    """(rows with their cell, cell centres).  Centres come from at most some ``SAMPLE`` rows; every row gets a cell."""
    rows = vectors.withColumn("features", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    share = min(1.0, SAMPLE / max(1, vectors.count()))
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(rows.sample(share, seed) if share < 1 else rows)
    return model.transform(rows).withColumnRenamed("prediction", "cell").drop("features"), [c.tolist() for c in model.clusterCenters()]


def probed(index: DataFrame, centres: list[list[float]], query: DataFrame, k: int, probes: int) -> DataFrame:
    """(id, score) of the k best rows in the query's nearest cells."""
    q = query.first()["q"]
    far = sorted((sum((a - b) ** 2 for a, b in zip(c, q)), i) for i, c in enumerate(centres))
    return search.nearest(index.where(F.col("cell").isin([i for _, i in far[:probes]])), query, k)
