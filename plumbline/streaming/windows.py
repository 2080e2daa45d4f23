"""Event-time streams: windowed sums with a watermark, de-duplication, and sessions; each equals its batch form."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def hourly(events: DataFrame) -> DataFrame:
    """Counts and sums of each hour; an hour is final when the watermark, two hours behind, has passed it."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "2 hours")
    out = timed.groupBy(F.window("at", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "2 hours")
    out = timed.groupBy("user_id", F.session_window("at", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


def distinct_events(events: DataFrame) -> DataFrame:
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "2 hours")
    return timed.dropDuplicatesWithinWatermark(["event_id"]).drop("at")


def run_to_end(spark: SparkSession, stream: DataFrame, mode: str = "complete") -> DataFrame:
    """What a stream has given when all that is there now is read; the result is a table in the session's memory."""
    name = f"stream_{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    at = f"{base.rstrip('/')}/{name}" if base else tempfile.mkdtemp(prefix="plumbline-stream-")
    running = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", at).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.table(name)


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A stream over the files of a table, which is a folder or one file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def hourly_from_files(spark: SparkSession, path: str) -> DataFrame:
    return run_to_end(spark, hourly(stream_of(spark, path)))
