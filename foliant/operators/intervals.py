"""Status logs to intervals, pivots and lead times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def status_intervals(log: DataFrame, now: str) -> DataFrame:
    """(key, status, entered, left, days): a status lasts until the next change, the last until ``now``."""
    w = Window.partitionBy("key").orderBy("at", "id")
    end = F.coalesce(F.lead("at").over(w), F.lit(now).cast("timestamp"))
    rows = log.withColumn("left", end).where(F.col("left") >= F.col("at"))
    days = (F.unix_micros("left") - F.unix_micros("at")) / DAY
    return rows.select("key", "status", F.col("at").alias("entered"), "left", F.round(days, 4).alias("days"))


def status_pivot(intervals: DataFrame, statuses: list[str]) -> DataFrame:
    """Days by key and status, zero where a key never had it."""
    p = intervals.groupBy("key").pivot("status", statuses).agg(F.round(F.sum("days"), 4)).na.fill(0.0)
    return p.select("key", *[F.col(s).alias(f"d_{s}") for s in statuses])


def lead_times(keys: DataFrame, log: DataFrame) -> DataFrame:
    """(key, first_at, last_at, days) of every key; null where it has no entry."""
    first = log.groupBy("key").agg(F.min("at").alias("first_at"))
    last = log.groupBy("key").agg(F.max("at").alias("last_at"))
    j = keys.join(first, "key", "left").join(last, "key", "left")
    return j.select("key", "first_at", "last_at", F.round((F.unix_micros("last_at") - F.unix_micros("first_at")) / DAY, 4).alias("days"))
