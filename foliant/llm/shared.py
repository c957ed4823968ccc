"""Tables written to the folder that driver and executors share.

Lineage is cut only by tables written there (never ``localCheckpoint``), so a
lost executor costs a re-read, not a failed job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.sources.shared import fresh

#: Bytes of one Arrow batch between Spark and a Python worker, at most.
BATCH_BYTES = 8 << 20


def bounded(spark: SparkSession) -> None:
    """Keeps Arrow batches small: a batch is held by the executor and by its worker, for each of its cores."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of the shared folder, read back."""
    spark, path = df.sparkSession, fresh(df.sparkSession, name)
    bounded(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and nothing reads any more."""
    for table in tables:
        for parent in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def kept_types(frame: DataFrame, first: int) -> str:
    """The schema string of a frame's columns from the given one on, with a leading comma each: columns that pass through."""
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in frame.schema.fields[first:])
