"""File-arrival ingestion of deliveries: late rows, repeats and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arrivals(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def without_repeats(stream: DataFrame, key: list[str], time: str, late: str = "2 days") -> DataFrame:
    """Each key once; a repeat is known for as long as the watermark, so the state stays bounded."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window start, key, n) of tumbling windows, emitted when the watermark has passed them."""
    w = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Write to Parquet, all that is there, then stop; a restart goes on where it stopped."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
