"""Incremental forms: insert-if-absent and counts by time window as Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.session import work_dir


def stream_of(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 1) -> DataFrame:
    """A table as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


def tumbling_counts(stream: DataFrame, time: str, group: str, window: str = "1 day", late: str = "30 days") -> DataFrame:
    """window_start, group, n, value: events up to `late` behind the latest count."""
    return stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).groupBy(F.window("__t", window).alias("w"), group).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), group, "n", "value")


def first_of_key(stream: DataFrame, time: str, key: list[str], late: str = "30 days") -> DataFrame:
    """Rows whose key wasn't seen within the watermark: the incremental insert-if-absent."""
    return stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late).dropDuplicatesWithinWatermark(key).drop("__t")


def run_to_end(result: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over what is there and returns what it wrote; offsets and state are in the shared folder."""
    spark = result.sparkSession
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    if mode == "append":
        writer = result.writeStream.format("parquet").option("path", f"{base}/out")
    else:  # complete results replace each other
        writer = result.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{base}/out")).outputMode(mode)
    query = writer.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/out")
