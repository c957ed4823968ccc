"""Run records as a stream: windowed statistics, and a set of what has been seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import fresh


def records(spark: SparkSession, path: str, schema: StructType, files: int = 100) -> DataFrame:
    """New Parquet files of a folder (or of a path with wildcards) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed(stream: DataFrame, every: str = "1 day", late: str = "10 minutes") -> DataFrame:
    """Counts and values by stage and time window; records later than the watermark are left out in append mode."""
    w = F.window("ts", every)
    return stream.withWatermark("ts", late).groupBy(w.alias("w"), "stage").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def first_seen(stream: DataFrame, *keys: str, late: str | None = None) -> DataFrame:
    """Each key once.  With ``late``, state older than that is dropped, so memory is bounded."""
    if late:
        return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))
    return stream.select(*keys).dropDuplicates(list(keys))


def drained(frame: DataFrame, mode: str, timeout: int = 600) -> DataFrame:
    """Runs a stream over what is there now and gives its table; complete mode keeps the last state."""
    spark = frame.sparkSession
    out, state = fresh(spark, "stream"), fresh(spark, "stream-state")
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True)
    if mode == "complete":
        query = writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(out)).start()
    else:
        query = writer.format("parquet").option("path", out).start()
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the stream did not end in time")
    return spark.read.schema(frame.schema).parquet(out)
