"""Incremental ingest: new files and records, each once, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radspark.operators import catalog
from radspark.sources import dicom


def new_files(spark: SparkSession, root: str, least: int = catalog.MIN_BYTES, per_trigger: int = 10_000) -> DataFrame:
    """A stream of files as they appear below ``root``."""
    s = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
         .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(root))
    return catalog.large_enough(catalog.by_name(s), least)


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str, least: int = catalog.MIN_BYTES) -> None:
    """Catalogue records of files not seen by earlier calls, appended to Parquet; ends when all are in."""
    records = dicom.header_records(new_files(spark, root, least))
    q = records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def dedup_stream(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """First event of each key; keys are forgotten when the watermark has passed them."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_metrics(events: DataFrame, time: str = "ts", name: str = "event_type", value: str = "value", size: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """start, name, count, mean, min, max of metric points by tumbling window; late points are dropped after the watermark."""
    e = events.withColumn(time, F.col(time).cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark(time, late)
    v = F.col(value)
    g = e.groupBy(F.window(time, size).alias("w"), F.col(name).alias("name")).agg(F.count(v).alias("count"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    return g.select(F.col("w.start").alias("start"), "name", "count", "mean", "min", "max")
