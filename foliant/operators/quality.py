"""Run records: thresholds, statistics, pass rates, trends, comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import THRESHOLDS


def limits(spark: SparkSession) -> DataFrame:
    """(stage, key, bound): the catalogue of thresholds."""
    return spark.createDataFrame([(s, k, float(v)) for s, own in THRESHOLDS.items() for k, v in own.items()], "stage string, key string, bound double")


def checked(metrics: DataFrame, bounds: DataFrame, literal: bool = False) -> DataFrame:
    """(run, stage, key, bound, value, status): ``missing``, ``violation`` or ``ok`` for each limit of a run's stage.

    ``min_x`` and ``max_x`` bound the metric x, or, with ``literal``, a metric of that very name.
    """
    runs = metrics.select("run", "stage").distinct().join(bounds, "stage")
    name = F.col("key") if literal else F.substring("key", 5, 100)
    j = runs.withColumn("metric", name).join(metrics.select("run", "metric", "value"), ["run", "metric"], "left")
    bad = (F.col("key").startswith("min_") & (F.col("value") < F.col("bound"))) | (F.col("key").startswith("max_") & (F.col("value") > F.col("bound")))
    status = F.when(F.col("value").isNull(), "missing").when(bad, "violation").otherwise("ok")
    return j.select("run", "stage", "key", "bound", "value", status.alias("status"))


def statistics(records: DataFrame) -> DataFrame:
    return records.groupBy("stage", "metric").agg(F.count("value").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"), F.round(F.avg("value"), 6).alias("mean"))


def pass_rates(records: DataFrame) -> DataFrame:
    ok = F.col("passed").cast("int")
    return records.groupBy("stage").agg(F.count("*").alias("total"), F.sum(ok).alias("passed"), F.sum(1 - ok).alias("failed"), F.round(F.avg(ok), 6).alias("pass_rate"))


def trend(records: DataFrame, last: int) -> DataFrame:
    """The last records of each stage, newest first."""
    r = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("ts"), F.desc("run")))
    return records.withColumn("r", r).where(F.col("r") <= last)


def latest(records: DataFrame, asked: DataFrame) -> DataFrame:
    """(source, run, value) of each asked source's newest record; null without any."""
    newest = records.groupBy("source").agg(F.max_by(F.struct("run", "value"), F.struct("ts", "run")).alias("l"))
    return asked.join(newest, "source", "left").select("source", F.col("l.run").alias("run"), F.col("l.value").alias("value"))


def overall(records: DataFrame) -> DataFrame:
    """Counts by stage and, with a null stage, over all."""
    ok = F.col("passed").cast("int")
    return records.rollup("stage").agg(F.count("*").alias("runs"), F.sum(ok).alias("passed"), F.round(F.avg(ok), 6).alias("pass_rate"))


def performance(records: DataFrame) -> DataFrame:
    return records.groupBy("operation").agg(F.count("*").alias("n"), F.round(F.sum("seconds"), 4).alias("total"), F.round(F.avg("seconds"), 6).alias("mean"), F.min("seconds").alias("least"), F.max("seconds").alias("most"))


def errors(records: DataFrame, kinds: list[str]) -> DataFrame:
    return records.groupBy("stage").pivot("kind", kinds).agg(F.count(F.lit(1))).na.fill(0)
